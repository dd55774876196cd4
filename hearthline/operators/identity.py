"""Identity preparation before linking: date-of-birth quality and sequential ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import join_values, number_rows

FIRST_YEAR = 1900
LAST_YEAR = 2018


def frequent_or_odd_dates(df: DataFrame, column: str, at_least: int) -> DataFrame:
    """Distinct dates outside the plausible years or occurring ``at_least`` times; no nulls."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("freq"))
    year = F.year(column)
    return counts.filter(
        (year > LAST_YEAR) | (year < FIRST_YEAR) | (F.col("freq") >= at_least)
    ).select(column, "freq")


def grade_dates(df: DataFrame, column: str, bad: DataFrame, quality: str = "dob_dq") -> DataFrame:
    """2 when the date is listed as bad, else 1 (a missing date is 1)."""
    listed = bad.select(F.col(column), F.lit(2).alias(quality))
    joined = join_values(df, listed, [column], "left", null_safe=False)
    return joined.withColumn(quality, F.coalesce(quality, F.lit(1))).select(*df.columns, quality)


def date_parts(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.withColumns(
        {
            f"{prefix}_y": F.year(column),
            f"{prefix}_m": F.month(column),
            f"{prefix}_d": F.dayofmonth(column),
        }
    )


def padded_id(number: Column, prefix: str, width: int = 6) -> Column:
    """``prefix`` and the number, zero-padded but never cut."""
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))
    return F.concat(F.lit(prefix), padded)


def with_sequential_id(
    df: DataFrame, order: Sequence[str], name: str, prefix: str, width: int = 6
) -> DataFrame:
    """Ids ``prefix`` + 000001… in the given total order."""
    numbered = number_rows(df, order, "__number")
    return numbered.withColumn(name, padded_id(F.col("__number"), prefix, width)).drop("__number")
