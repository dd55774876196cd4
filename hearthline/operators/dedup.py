"""Deduplication with a defined survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"deduplication columns not in the table: {missing}")
    rank = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    # The aggregate combines before the shuffle, so a key with many copies sends one row per task.
    return df.groupBy(*keys).agg(pick(row, rank).alias("__row")).select("__row.*")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in the given total order (non-null); null keys are equal."""
    return _keep(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given total order (non-null); null keys are equal."""
    return _keep(df, keys, order, F.min_by)
