"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: A word: a run of characters that are neither a space nor one of \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = " \t\n\x0b\x0c\r"
ROWS_PER_SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, batch_rows: int | None = None, compression: str | None = None) -> DataFrame:
    """Written as Parquet to the shared folder and read back: cuts the lineage, survives lost executors.

    ``batch_rows`` holds for the Arrow batches of this one job, where rows are wide.
    """
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path, before = scratch_path(spark, label), spark.conf.get(name)
    try:
        if batch_rows:
            spark.conf.set(name, str(batch_rows))
        df.write.parquet(path, compression=compression)
    finally:
        if batch_rows:
            spark.conf.set(name, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``written`` has written, once all that was made of it is written too."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, rows: int = ROWS_PER_SLICE) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def text_slices(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batches whose texts (or bytes) in ``column`` sum up to ``most`` at most; a larger one comes alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at = 0
        while at < batch.num_rows:
            stop, held = at + 1, sizes[at]
            while stop < batch.num_rows and held + sizes[stop] <= most:
                held += sizes[stop]
                stop += 1
            yield batch.slice(at, stop - at)
            at = stop


def add_columns(df: DataFrame, inputs: list[str], fields: list[T.StructField], fn: Callable, done: Callable | None = None) -> DataFrame:
    """Append what ``fn(*arrow columns)`` returns, a few hundred rows at a time.

    Columns of ``df`` that bear one of the new names give way to the new ones. Each column of ``df``
    goes to the function's process once. ``done`` is called behind a task's last row: the process
    stays for later tasks, and so does what ``fn`` keeps there.
    """
    new = {f.name for f in fields}
    kept = [c for c in df.columns if c not in new]
    extra = [c for c in dict.fromkeys(inputs) if c in new]
    sent = kept + extra
    given = df.select(*(F.col(f"`{c}`") for c in kept), *(F.col(f"`{c}`").alias(f"__arg{i}") for i, c in enumerate(extra)))
    schema = T.StructType([f for f in df.schema.fields if f.name in set(kept)] + fields)
    names = [f.name for f in schema.fields]
    n, at = len(kept), [sent.index(c) for c in inputs]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                columns = part.columns
                yield pa.RecordBatch.from_arrays([*columns[:n], *fn(*(columns[k] for k in at))], names=names)
        if done:
            done()

    return given.mapInArrow(run, schema)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def stripped_length(text: Column) -> Column:
    """Code points that are part of words."""
    return F.length(F.translate(text, BLANK, ""))
