"""Joins of stage tables with dataframe-merge semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import HotKeys, find_hot_keys, join_values


def merge_on(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left or right join on one key per side, nulls matching nulls.

    Other columns of the same name get ``_x`` and ``_y``. The right key's column is dropped
    when its name differs, so after a right join it is null for rows only the right side has;
    a key of one name keeps its value. ``hot`` are the left side's hot keys, which are salted.

    The left key is joined as it is, so further joins on it need no new shuffle.
    """
    same_key = left_key == right_key
    clash = (set(left.columns) & set(right.columns)) - ({left_key} if same_key else set())
    if hot is None:
        hot = find_hot_keys(left, [left_key])
    key = f"{left_key}_x" if left_key in clash else left_key
    renamed = f"{right_key}_y" if right_key in clash else right_key
    left = left.withColumnsRenamed({c: f"{c}_x" for c in clash})
    right = right.withColumnsRenamed({c: f"{c}_y" for c in clash}).withColumnRenamed(renamed, key)
    hot = hot.on(key)
    rest = [c for c in right.columns if c != key]
    if how == "left":
        return join_values(left, right, [key], "left", hot).select(*left.columns, *rest)
    return _right_join(left, right, key, hot, keep_key=same_key).select(*left.columns, *rest)


def _right_join(
    left: DataFrame, right: DataFrame, key: str, hot: HotKeys, keep_key: bool
) -> DataFrame:
    """All right rows; the key is the right side's with ``keep_key``, else the left side's."""
    others = [c for c in right.columns if c != key]
    if not hot:
        on = F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
        kept = [f"{'r' if keep_key and c == key else 'l'}.{c}" for c in left.columns]
        joined = left.alias("l").join(right.alias("r"), on, "right")
        return joined.select(*kept, *[f"r.{c}" for c in others])
    # The left side's hot rows are dealt over pieces; the right rows without a partner follow.
    matched = join_values(left, right, [key], "inner", hot)
    alone = join_values(right, left.select(key).distinct(), [key], "left_anti")
    if not keep_key:
        alone = alone.drop(key)
    return matched.unionByName(alone, allowMissingColumns=True)
