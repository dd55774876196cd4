"""CSV scans over yearly folders, and sinks."""

from __future__ import annotations

import os
import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import paste
from ..operators.cleaning import coerce_times, drop_columns, null_unknown, strip_bom
from ..operators.dedup import keep_last
from .spec import TableSpec

ORD = "__ord"

# Default folders per county below <data root>/<county>.
COUNTY_FOLDERS = {
    "king": ["2012", "2013", "2014", "2015", "2016"],
    "pierce": ["2012_2016"],
    "snohomish": ["2012_2016"],
}

# Texts that mean a missing value in the yearly extracts.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)


def folder_files(filename: str, data_dir: str, paths: Sequence[str]) -> dict[str, str]:
    """The file of a table in every folder."""
    return {p: os.path.join(data_dir, p, filename) for p in paths}


def resolve_files(
    file_spec: Mapping | str,
    county: str | None = None,
    data_dir: str | None = None,
    paths: Sequence[str] | None = None,
    data_root: str = "data",
) -> dict:
    """Folder-to-file mapping from the arguments of :func:`read_table`."""
    if isinstance(file_spec, Mapping):
        if data_dir is not None or paths is not None:
            raise ValueError("data_dir and paths cannot be given when file_spec is a mapping")
        return dict(file_spec)
    for value, what in ((data_dir, "data_dir"), (paths, "paths")):
        if value is None and county is None:
            raise ValueError(f"a file name needs {what} or county")
        if value is None and not isinstance(county, str):
            raise ValueError("county must be one name")
    data_dir = data_dir if data_dir is not None else os.path.join(data_root, county)
    paths = paths if paths is not None else COUNTY_FOLDERS[county]
    return folder_files(file_spec, data_dir, paths)


def scan_folders(
    spark: SparkSession,
    files: Mapping,
    encoding: str | None = None,
    multi_line: bool = False,
    null_texts: Sequence[str] = NULL_TEXTS,
) -> DataFrame:
    """All folders' rows as text columns plus ``__ord``, a total order by load position.

    The last folder is loaded first, then the others in turn, so that of equal keys the row of
    the last-but-one folder is the last one. Within a folder rows keep file and line order.
    ``multi_line`` is needed when quoted values hold line breaks; such files cannot be split.
    """
    entries = list(files.values())
    frames = []
    for place, path in enumerate(entries[-1:] + entries[:-1]):
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
        # Files of one folder whose headers differ are an error, never read by position.
        reader = reader.option("multiLine", multi_line).option("enforceSchema", False)
        if encoding:
            reader = reader.option("encoding", encoding)
        raw = reader.csv(path)
        if any(c.startswith("﻿") for c in raw.columns):
            raw = strip_bom(raw)
        order = F.struct(
            F.lit(place).alias("folder"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
        columns = [_null_text(c, null_texts) for c in raw.columns]
        frames.append(raw.select(*columns, order.alias(ORD)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _null_text(name: str, null_texts: Sequence[str]) -> Column:
    listed = ", ".join(f"'{t}'" for t in null_texts)
    return F.expr(f"CASE WHEN `{name}` NOT IN ({listed}) THEN `{name}` END").alias(name)


def infer_types(df: DataFrame) -> dict[str, str]:
    """bigint, double, boolean or string for each text column, from one aggregating pass."""
    columns = [c for c in df.columns if c != ORD]
    checks = []
    for i, name in enumerate(columns):
        text = F.col(f"`{name}`")
        for kind in ("bigint", "double"):
            fits = F.bool_and(text.try_cast(kind).isNotNull() | text.isNull())
            checks.append(fits.alias(f"{kind}{i}"))
        checks.append(
            F.bool_and(text.isin("True", "False", "TRUE", "FALSE") | text.isNull()).alias(f"bool{i}")
        )
        checks.append(F.max(text.isNotNull()).alias(f"any{i}"))
    seen = df.agg(*checks).first()
    out = {}
    for i, name in enumerate(columns):
        if not seen[f"any{i}"]:
            out[name] = "double"
        elif seen[f"bigint{i}"]:
            out[name] = "bigint"
        elif seen[f"double{i}"]:
            out[name] = "double"
        else:
            out[name] = "boolean" if seen[f"bool{i}"] else "string"
    return out


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns; a number written as 3.0 still casts to bigint, other misfits give null."""
    casts = {name: _cast(name, kind) for name, kind in types.items() if name in df.columns}
    return df.withColumns(casts) if casts else df


def _cast(name: str, kind: str) -> Column:
    text = F.col(f"`{name}`")
    if kind not in ("bigint", "int"):
        return text.try_cast(kind)
    number = text.try_cast("double")
    exact = F.when(number == F.floor(number), number.try_cast(kind))
    return F.when(text.contains(".") | F.lower(text).contains("e"), exact).otherwise(text.try_cast(kind))


def count_misfits(df: DataFrame, types: Mapping[str, str]) -> dict[str, int]:
    """How many known texts of each typed column do not fit its type and would become null."""
    listed = [n for n in types if n in df.columns]
    if not listed:
        return {}
    misfit = [F.count_if(F.col(f"`{n}`").isNotNull() & _cast(n, types[n]).isNull()).alias(f"m{i}") for i, n in enumerate(listed)]
    row = df.agg(*misfit).first()
    return {n: row[f"m{i}"] for i, n in enumerate(listed)}


def read_spec(
    spark: SparkSession,
    files: Mapping,
    spec: TableSpec,
    multi_line: bool = False,
    null_texts: Sequence[str] = NULL_TEXTS,
) -> DataFrame:
    """Scan, drop, deduplicate, null unknown codes and parse times; keeps ``__ord``."""
    df = scan_folders(spark, files, spec.encoding, multi_line, null_texts)
    df = drop_columns(df, spec.columns_to_drop)
    types = dict(spec.types) if spec.types is not None else infer_types(df.drop(*spec.time_var))
    times = {c: types.pop(c) for c in spec.time_var if types.get(c) in ("date", "timestamp")}
    df = apply_types(df, {k: v for k, v in types.items() if k not in spec.time_var})
    if spec.dedup:
        if spec.duplicate_check_columns is None:
            warnings.warn("no duplicate_check_columns given, so rows are not deduplicated")
        else:
            df = keep_last(df, spec.duplicate_check_columns, [ORD])
    df = null_unknown(df, spec.categorical_var, spec.categorical_unknown)
    for kind in ("date", "timestamp"):
        columns = [c for c in spec.time_var if times.get(c, "timestamp") == kind]
        df = coerce_times(df, columns, kind)
    return df


def read_table(
    spark: SparkSession,
    file_spec: Mapping | str,
    county: str | None = None,
    data_dir: str | None = None,
    paths: Sequence[str] | None = None,
    spec: TableSpec | Mapping | str | None = None,
    data_root: str = "data",
    multi_line: bool = False,
    keep_order: bool = False,
    **options,
) -> DataFrame:
    """One table from several folders, cleaned by its specification.

    ``options`` are the fields of :class:`TableSpec` and may stand in for ``spec``.
    """
    given = TableSpec.of(spec) if spec is not None else TableSpec.from_dict(options)
    files = resolve_files(file_spec, county, data_dir, paths, data_root)
    df = read_spec(spark, files, given, multi_line)
    return df if keep_order else df.drop(ORD)


def read_extract(spark: SparkSession, path: str, id_prefix: str, id_column: str) -> DataFrame:
    """A stage output or agency extract as text columns, with ``pid0`` = prefix + id."""
    df = scan_folders(spark, {"all": path}, null_texts=("", "NA"))
    return df.withColumn("pid0", paste(F.lit(id_prefix), F.col(id_column)))


def write_stage(df: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite") -> None:
    """Write a stage output as parquet (default) or CSV with a header."""
    writer = df.drop(ORD).write.mode(mode)
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown kind {kind!r}, use parquet or csv")
