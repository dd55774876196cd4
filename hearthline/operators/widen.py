"""Rows to columns: entry/exit stages and typed responses."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import keep_first
from .skew import REPEATED, SALT, HotKeys, deal_larger_side, find_hot_keys


def drop_stages(df: DataFrame, stage: str, values: Sequence) -> DataFrame:
    """Drop rows of the given stages; a null stage stays."""
    return df.filter(F.col(stage).isNull() | ~F.col(stage).isin(list(values)))


def _categories(df: DataFrame, category: str, suffixes: Mapping) -> list:
    """The categories that occur; one that has no suffix is an error. One value per suffix."""
    seen = df.select(category).filter(F.col(category).isNotNull()).distinct()
    found = [r[0] for r in seen.limit(len(suffixes) + 1).collect()]
    unknown = [v for v in found if v not in suffixes]
    if unknown or len(found) > len(suffixes):
        raise KeyError(f"no suffix for value {unknown[:3]} of {category}")
    return sorted(found)


def split_rows_to_columns(
    df: DataFrame,
    category: str,
    suffixes: Mapping,
    merge_columns: Sequence[str] | str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """One set of suffixed columns per category, full-outer-joined on the merge columns.

    Rows with a null category vanish; null merge keys match each other; repeated rows of a key
    multiply. Columns appear only for categories that occur. The rows of hot merge keys are dealt
    over pieces; ``hot`` saves the pass that looks for such keys.
    """
    if isinstance(category, (list, tuple)):
        raise TypeError("the category column must be one name, not a container")
    keys = [merge_columns] if isinstance(merge_columns, str) else list(merge_columns)
    measures = [c for c in df.columns if c not in keys and c != category]
    parts = []
    for value in _categories(df, category, suffixes):
        renamed = [F.col(c).alias(c + suffixes[value]) for c in measures]
        parts.append(df.filter(F.col(category) == value).select(*keys, *renamed))
    if not parts:
        return df.filter(F.lit(False)).select(*keys)

    hot = find_hot_keys(df.select(*keys), keys) if hot is None else hot

    def outer(left: DataFrame, right: DataFrame) -> DataFrame:
        on = keys
        if hot:
            left, right = deal_larger_side(left, right, hot)
            on = [*keys, SALT]
        same = reduce(
            lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in on]
        )
        joined = left.alias("l").join(right.alias("r"), same, "full_outer")
        if hot:
            # A repeated row meets its partners in some pieces only; alone in the others it is no result.
            alone = [F.col(f"{x}.{REPEATED}") & F.col(f"{y}.{REPEATED}").isNull() for x, y in ("lr", "rl")]
            joined = joined.filter(~F.coalesce(alone[0] | alone[1], F.lit(False)))
        # A key is null on the side that has no row; where both have one they are equal.
        merged = [F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys]
        rest = [f"l.{c}" for c in left.columns if c not in (*on, REPEATED)]
        rest += [f"r.{c}" for c in right.columns if c not in (*on, REPEATED)]
        return joined.select(*merged, *rest)

    return reduce(outer, parts)


def pivot_unique(
    df: DataFrame, category: str, suffixes: Mapping, merge_columns: Sequence[str] | str
) -> DataFrame:
    """As :func:`split_rows_to_columns` when (merge columns, category) is unique: one shuffle."""
    keys = [merge_columns] if isinstance(merge_columns, str) else list(merge_columns)
    measures = [c for c in df.columns if c not in keys and c != category]
    aggs = [
        F.max(F.when(F.col(category) == v, F.col(c))).alias(c + suffixes[v])
        for v in _categories(df, category, suffixes)
        for c in measures
    ]
    known = df.filter(F.col(category).isNotNull())
    return known.groupBy(*keys).agg(*aggs) if aggs else known.select(*keys)


def widen_typed_responses(
    df: DataFrame,
    person_enrollment: str,
    stage: str,
    stages: Mapping,
    type_column: str,
    response: str,
    types: Mapping[int, str],
    unique: bool = False,
) -> DataFrame:
    """A column per response type and stage, one row per enrolment (more if responses repeat).

    An enrolment stays only when it has a typed row in both stages, because each widening step
    drops the rows that lack its type. ``unique`` promises one row per (enrolment, stage, type)
    and takes the one-shuffle path. Result columns are named ``<type><stage suffix>``.
    """
    pe = person_enrollment
    data = df.select(pe, stage, type_column, response)
    entry, exit_ = list(stages.values())
    suffix = {code: f"_{name}" for code, name in types.items()}
    final = {
        f"{response}{ss}_{name}": f"{name}{ss}" for ss in (entry, exit_) for name in types.values()
    }
    if unique:
        wide = _typed_unique(data, pe, stage, stages, type_column, response, suffix)
    else:
        both = split_rows_to_columns(data, stage, stages, pe)
        for ss in (entry, exit_):
            for c in (type_column, response):
                if c + ss not in both.columns:
                    both = both.withColumn(c + ss, F.lit(None).cast(dict(data.dtypes)[c]))
        first = split_rows_to_columns(
            both, type_column + entry, suffix, [pe, type_column + exit_, response + exit_]
        )
        seen = [c for c in first.columns if c.startswith(response + entry + "_")]
        wide = split_rows_to_columns(first, type_column + exit_, suffix, [pe, *seen])
    return wide.select(*[F.col(c).alias(final.get(c, c)) for c in wide.columns])


def _typed_unique(data, pe, stage, stages, type_column, response, suffix) -> DataFrame:
    (entry_val, entry), (exit_val, exit_) = stages.items()
    codes = _categories(data.filter(F.col(stage).isin(list(stages))), type_column, suffix)
    typed = F.col(type_column).isNotNull()
    aggs = [
        F.count(F.when(typed & (F.col(stage) == entry_val), 1)).alias("__in"),
        F.count(F.when(typed & (F.col(stage) == exit_val), 1)).alias("__out"),
    ]
    for value, ss in stages.items():
        for code in codes:
            here = (F.col(stage) == value) & (F.col(type_column) == code)
            aggs.append(F.max(F.when(here, F.col(response))).alias(response + ss + suffix[code]))
    wide = data.groupBy(pe).agg(*aggs).filter((F.col("__in") > 0) & (F.col("__out") > 0))
    return wide.drop("__in", "__out")


def collapse_stages_to_max(
    df: DataFrame, key: str, stage: str, stages: Mapping, columns: Sequence[str], order: str
) -> DataFrame:
    """One row per key with a set of suffixed columns per stage: maxima of the listed columns, and
    the values of the stage's first row by ``order`` of the others. One aggregation does it.

    The same as widening the stages and collapsing the wide rows, without the product of a key's
    entry and exit rows. Rows of a null key are not combined: each stage's first row is taken whole.
    Rows of other stages vanish; columns appear only for stages that occur.
    """
    measures = [c for c in df.columns if c not in (key, stage, order)]
    for c in measures:
        if c not in columns:
            warnings.warn(f"{c} is neither the key nor a column to take the maximum of; first kept")
    aggs = []
    for value in _categories(df, stage, stages):
        here = F.col(stage) == value
        for c in measures:
            first = F.min_by(F.col(c), F.when(here, F.col(order)))
            most = F.when(F.col(key).isNull(), first).otherwise(F.max(F.when(here, F.col(c))))
            aggs.append((most if c in columns else first).alias(c + stages[value]))
    known = df.filter(F.col(stage).isNotNull())
    return known.groupBy(key).agg(*aggs) if aggs else known.select(key)


def collapse_to_max(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    order: Sequence[str],
    drop_order: bool = True,
    null_keys: bool = True,
) -> DataFrame:
    """One row per key: maxima of the listed columns, the first row's value of the others.

    Rows with a null key are not combined; the first of them is kept as it is. Without such
    rows, ``null_keys=False`` saves a second pass.
    """
    maxed = [c for c in columns if c in df.columns]
    others = [c for c in df.columns if c not in maxed and c != key and c not in order]
    for c in others:
        warnings.warn(f"{c} is neither the key nor a column to take the maximum of; first kept")
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    kept = others if drop_order else others + list(order)
    aggs = [F.max(c).alias(c) for c in maxed] + [F.min_by(c, rank).alias(c) for c in kept]
    known = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    if not null_keys:
        return known
    unknown = keep_first(df.filter(F.col(key).isNull()), [key], list(order))
    return known.unionByName(unknown.select(*known.columns))
