"""Joins with code lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.codes import DESTINATIONS, PROJECT_TYPES
from ..sources.tables import scan_folders

DESTINATION_SCHEMA = (
    "DestinationNumeric bigint, DestinationDescription string, DestinationGroup string, "
    "DestinationSuccess string, Subsidy boolean"
)


def destination_map(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The built-in destination list, or the "New Standards" rows of a CSV of the same form."""
    if path is None:
        return spark.createDataFrame(DESTINATIONS, DESTINATION_SCHEMA)
    table = scan_folders(spark, {"map": path})
    subsidy = F.when(F.col("Subsidy") == "Yes", True).when(F.col("Subsidy") == "No", False)
    return table.filter(F.col("Standard") == "New Standards").select(
        F.col("DestinationNumeric").try_cast("double").cast("bigint").alias("DestinationNumeric"),
        "DestinationDescription",
        "DestinationGroup",
        "DestinationSuccess",
        subsidy.alias("Subsidy"),
    )


def merge_destination(
    df: DataFrame, destination_column: str = "destination_value", path: str | None = None
) -> DataFrame:
    """Add description, group, outcome and subsidy of a destination code; drops the code column.

    Codes not in the list give nulls. The list is a fixed code list, so it is broadcast; one
    read from a file is joined as Spark sees fit.
    """
    spark = df.sparkSession
    codes = destination_map(spark, path)
    codes = F.broadcast(codes) if path is None else codes
    on = F.col(f"`{destination_column}`").try_cast("double") == F.col("DestinationNumeric")
    return df.join(codes, on, "left").drop(destination_column)


def name_codes(
    df: DataFrame, column: str, names: Mapping[int, str], code_name: str, text_name: str
) -> DataFrame:
    """Replace a code column by the code (null when unknown) and its name, from a short list."""
    code = F.col(f"`{column}`").try_cast("double")
    table = F.create_map(*[x for k, v in names.items() for x in (F.lit(float(k)), F.lit(v))])
    known = code.isin([float(k) for k in names])
    added = df.withColumns(
        {
            "__code": F.when(known, code.cast("bigint")),
            "__name": F.when(known, F.try_element_at(table, code)),
        }
    ).drop(column)
    return added.withColumnsRenamed({"__code": code_name, "__name": text_name})


def merge_project_type(
    df: DataFrame, column: str, names: Mapping[int, str] = PROJECT_TYPES
) -> DataFrame:
    """Replace a project type code by ``ProjectNumeric`` and ``ProjectType``."""
    return name_codes(df, column, names, "ProjectNumeric", "ProjectType")


def lookup(
    df: DataFrame, table: DataFrame, on: Sequence[tuple[str, str]], drop: Sequence[str] = ()
) -> DataFrame:
    """Left join of any lookup table; Spark broadcasts it only below its size threshold."""
    condition = [F.col(f"a.{a}").eqNullSafe(F.col(f"b.{b}")) for a, b in on]
    return df.alias("a").join(table.alias("b"), condition, "left").drop(*drop)
