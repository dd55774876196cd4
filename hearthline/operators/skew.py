"""Group-wise work that stays balanced when one key holds a large share of the rows.

Every helper first asks a constant-size frequency sketch which keys are hot. Without hot
keys the plain Spark window or join is used; with hot keys the aggregate is combined map-side
and joined back salted, and ordered groups are cut into ranges. Either way gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

# A key with fewer rows than this never needs splitting, whatever its share; the second
# number is for joins that pair the rows of a key with each other.
MIN_HOT_ROWS = 200_000
MIN_PAIR_ROWS = 2_000
# About so many wide rows a task, where it sorts them several times.
ROWS_PER_TASK = 25_000
SALT = "__salt"
RANGE = "__range"
REPEATED = "__repeated"


def parts_of(df: DataFrame) -> int:
    """Into how many tasks a balanced group-wise job is cut: the shuffle partitions."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the keys that hold more than one task's share of the rows, and their pieces.

    A key gets as many pieces as it holds shares, rounded up to a power of two so that few sizes
    occur. There are at most ``parts`` such keys and four times as many pieces, so tables with one
    row per hot key (or one per hot key and piece) have a proven bound and may be broadcast. A hash
    collision only moves rows to another task; it never changes a result.
    """

    keys: tuple[str, ...]
    parts: int
    hashes: tuple[int, ...] = field(default=())
    pieces: tuple[int, ...] = field(default=())
    rows: int = 0  # counted in the pass that looked for them

    def __bool__(self) -> bool:
        return bool(self.hashes)

    def on(self, *keys: str) -> HotKeys:
        """The same key values under other column names of the same types."""
        return HotKeys(keys, self.parts, self.hashes, self.pieces, self.rows)

    def hash(self) -> Column:
        return F.xxhash64(*[F.col(k) for k in self.keys])

    def holds(self) -> Column:
        return self.hash().isin(list(self.hashes))

    def by_size(self) -> dict[int, list[int]]:
        """The hashes of each number of pieces."""
        sizes: dict[int, list[int]] = {}
        for h, n in zip(self.hashes, self.pieces):
            sizes.setdefault(n, []).append(h)
        return sizes

    def count(self) -> Column:
        """How many pieces the row's key has: one unless it is hot."""
        column = F.lit(1)
        for n, hashes in self.by_size().items():
            column = F.when(self.hash().isin(hashes), F.lit(n)).otherwise(column)
        return column

    def every(self) -> Column:
        """An array of all pieces of the row's key."""
        return F.sequence(F.lit(0), self.count() - 1)

    def one(self, *by: str) -> Column:
        """The piece of the row's key that the hash of the given columns falls to."""
        return F.pmod(F.xxhash64(*[F.col(c) for c in by]), self.count()).cast("int")


def pieces_for(count: int, rows: int, parts: int) -> int:
    """Shares of one task in a key's rows, rounded up to a power of two; two at least."""
    return 1 << max(1, (-(-count * parts // rows) - 1).bit_length())


def dealt_by_size(df: DataFrame, hot: HotKeys) -> DataFrame:
    """Rows dealt by their keys over as many tasks as hold about ``ROWS_PER_TASK`` each.

    For a chain of sorts on the same keys, each of which holds a task's rows: AQE unites partitions by
    their compressed bytes, so that a task's memory would grow with the table. With hot keys nothing is
    done, as their groups are cut into ranges.
    """
    if hot:
        return df
    return df.repartition(-(-hot.rows // ROWS_PER_TASK) or 1, *hot.keys)


def no_hot_keys(df: DataFrame, keys: Sequence[str]) -> HotKeys:
    """For data known to be too small to have hot keys."""
    return HotKeys(tuple(keys), parts_of(df))


def find_hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> HotKeys:
    """One pass over the key columns with a frequent-items sketch; at most one key per part."""
    return find_hot_key_sets(df, [keys], min_rows)[0]


def find_hot_key_sets(
    df: DataFrame, key_sets: Sequence[Sequence[str]], min_rows: int | None = None
) -> list[HotKeys]:
    """The hot keys of several key sets, still in one pass."""
    parts = parts_of(df)
    least = MIN_HOT_ROWS if min_rows is None else min_rows
    tracked = min(1_000_000, 64 * parts)
    hashed = df.select(
        *[F.xxhash64(*[F.col(k) for k in ks]).alias(f"h{i}") for i, ks in enumerate(key_sets)]
    )
    sketches = [
        F.expr(f"approx_top_k(h{i}, {parts}, {tracked})").alias(f"h{i}")
        for i in range(len(key_sets))
    ]
    top = hashed.agg(*sketches, F.count("*").alias("n")).first()
    found = []
    for i, keys in enumerate(key_sets):
        hot = [
            (e["item"], pieces_for(e["count"], top["n"], parts))
            for e in (top[f"h{i}"] or [])
            if e["count"] * parts > top["n"] and e["count"] >= least
        ]
        found.append(
            HotKeys(tuple(keys), parts, tuple(h for h, _ in hot), tuple(n for _, n in hot), top["n"])
        )
    return found


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of columns of one name, as plain column references.

    Without an alias in between, joins in a row on one key keep the rows' partitioning.
    """
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


def repeated(rows: DataFrame, hot: HotKeys) -> DataFrame:
    """Rows repeated for the pieces of their keys, which a join sorts: Spark's estimate of their size
    leaves the repeats out, so that it would broadcast them.
    """
    return rows.hint("merge") if hot else rows


def _row_salt(df: DataFrame, hot: HotKeys) -> Column:
    """A piece number per row that also spreads exact copies: they differ in partition."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), hot.count()).cast("int")


def join_values(
    rows: DataFrame,
    values: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot: HotKeys | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Join ``values`` to ``rows`` on equal key names; hot keys are salted on the rows' side.

    ``values`` repeats each hot key once per piece, so it should hold few rows per key.
    ``how`` is inner, left, left_semi or left_anti.
    """
    keys = list(keys)
    hot = find_hot_keys(rows, keys) if hot is None else hot
    on = keys
    extra: list[str] = []
    if hot:
        rows = rows.withColumn(SALT, _row_salt(rows, hot))
        values = values.withColumn(SALT, F.explode(hot.every()))
        on, extra = keys + [SALT], [SALT]
    if not null_safe:
        return rows.join(values, on, how).drop(*extra)
    kept = [f"r.{c}" for c in rows.columns if c not in extra]
    if how not in ("left_semi", "left_anti"):
        kept += [f"v.{c}" for c in values.columns if c not in on]
    joined = rows.alias("r").join(values.alias("v"), _same("r", "v", on), how)
    return joined.select(*kept)


def deal_larger_side(left: DataFrame, right: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a piece number: rows of a hot key are dealt on the side that has
    more of them and repeated for every piece on the other, where ``REPEATED`` marks them.
    """
    keys = list(hot.keys)
    counted = [
        side.filter(hot.holds()).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, (F.col("__n") * sign).alias("__n"))
        for side, sign in ((left, 1), (right, -1))
    ]
    # At most one row per hot key (or key with a hot one's hash), and the same for both sides.
    more = materialise(
        counted[0].unionByName(counted[1]).groupBy(*keys).agg((F.sum("__n") >= 0).alias("__left"))
    )

    def dealt(side: DataFrame, larger: Column) -> DataFrame:
        placed = join_small(side.withColumn("__piece", _row_salt(side, hot)), more, keys)
        piece, pieces = F.array("__piece"), F.when(larger, F.array("__piece")).otherwise(hot.every())
        placed = placed.withColumn(REPEATED, F.coalesce(~larger, F.lit(False)))
        placed = placed.withColumn(SALT, F.explode(F.when(F.col("__left").isNull(), piece).otherwise(pieces)))
        return placed.drop("__piece", "__left")

    return dealt(left, F.col("__left")), dealt(right, ~F.col("__left"))


def with_group_values(
    df: DataFrame,
    keys: Sequence[str],
    values: dict[str, Column],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add aggregates of each row's group (null keys form a group) to every row."""
    keys = list(keys)
    hot = find_hot_keys(df, keys) if hot is None else hot
    if not hot:
        window = W.partitionBy(*keys)
        return df.withColumns({name: agg.over(window) for name, agg in values.items()})
    # Both the totals and the rows come from the table; fixing it keeps chained steps linear.
    df = materialise(df)
    totals = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in values.items()])
    return join_values(df.drop(*values), totals, keys, "left", hot)


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number that grows with it (days, microseconds or the value)."""
    kind = dict(df.dtypes)[name]
    column = F.col(name)
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind == "timestamp":
        return F.unix_micros(column).cast("double")
    if kind == "timestamp_ntz":
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def _sortable(order: Sequence[str]) -> Column:
    """A struct that sorts like the order columns with nulls last."""
    parts = []
    for i, name in enumerate(order):
        parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*parts)


class OrderedGroups:
    """Rows of each group in ascending order (nulls last), ready for shifts and running values.

    ``order`` must name comparable columns and end in one that makes the order total. When a
    group is hot, its rows are cut into ranges along the order; each range is a window
    partition of its own and the few values that cross a border are brought in from a table
    with one row per hot group and range.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        hot: HotKeys | None = None,
    ):
        self.keys, self.order = list(keys), list(order)
        self.hot = find_hot_keys(df, self.keys) if hot is None else hot
        self.df = self._cut(df) if self.hot else df
        self._by = [F.col(c).asc_nulls_last() for c in self.order]

    def _cut(self, df: DataFrame) -> DataFrame:
        hot = self.hot
        df = materialise(df)  # read for the bounds, the cuts, the borders and the rows
        rows = df.filter(hot.holds())
        first, second = self.order[0], (self.order + self.order)[1]
        bounds = rows.agg(
            F.min(_number(df, second)).alias("lo"), F.max(_number(df, second)).alias("hi")
        ).first()
        low, width = bounds["lo"] or 0.0, (bounds["hi"] or 0.0) - (bounds["lo"] or 0.0)
        # Whole first values split further by where the second value lies; later nulls sort last.
        within = F.coalesce((_number(df, second) - low + 0.5) / (width + 2.0), F.lit(1.0 - 1e-9))
        if len(self.order) == 1:
            within = F.lit(0.0)
        place = F.coalesce(F.floor(_number(df, first)) + within, F.lit(float("inf")))
        if dict(df.dtypes)[first] in ("double", "float") or dict(df.dtypes)[first].startswith("dec"):
            place = F.coalesce(_number(df, first), F.lit(float("inf")))
        each = [
            rows.filter(hot.hash().isin(hashes)).groupBy(*self.keys).agg(
                F.percentile_approx(place, [i / n for i in range(1, n)], 100 * n).alias("__cuts")
            )
            for n, hashes in hot.by_size().items()
        ]
        cuts = reduce(DataFrame.unionByName, each)
        cuts = materialise(cuts)  # at most one row per hot key, and the same in every use
        joined = join_small(df, cuts, self.keys)
        cut = F.size(F.filter(F.coalesce("__cuts", F.array().cast("array<double>")), lambda c: c < place))
        return joined.withColumn(RANGE, cut).drop("__cuts")

    def _window(self):
        keys = self.keys + ([RANGE] if self.hot else [])
        return W.partitionBy(*keys).orderBy(*self._by)

    def _borders(self, **aggs: Column) -> DataFrame:
        """One row per hot key and range."""
        return (
            self.df.filter(self.hot.holds())
            .groupBy(*self.keys, RANGE)
            .agg(*[agg.alias(name) for name, agg in aggs.items()])
        )

    def lead(self, columns: dict[str, str]) -> DataFrame:
        """Add, under each new name, the next row's value of a column."""
        window = self._window()
        if not self.hot:
            return self.df.withColumns(
                {new: F.lead(old).over(window) for new, old in columns.items()}
            )
        fields = F.struct(*[F.col(old).alias(new) for new, old in columns.items()])
        after = self._borders(__first=F.min_by(fields, _sortable(self.order))).withColumn(
            "__next", F.lead("__first").over(W.partitionBy(*self.keys).orderBy(RANGE))
        )
        out = self.df.withColumn("__more", F.lead(F.lit(1)).over(window))
        out = out.withColumns({new: F.lead(old).over(window) for new, old in columns.items()})
        out = join_small(out, after.drop("__first"), self.keys + [RANGE])
        fixed = {
            new: F.when(F.col("__more").isNull(), F.col("__next")[new]).otherwise(F.col(new))
            for new in columns
        }
        return out.withColumns(fixed).drop("__more", "__next", RANGE)

    def max_before(self, columns: dict[str, str]) -> DataFrame:
        """Add the maximum of a column over all earlier rows of the group."""
        window = self._window().rowsBetween(W.unboundedPreceding, -1)
        own = {new: F.max(old).over(window) for new, old in columns.items()}
        if not self.hot:
            return self.df.withColumns(own)
        earlier = W.partitionBy(*self.keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
        borders = self._borders(**{f"__m_{new}": F.max(old) for new, old in columns.items()})
        borders = borders.withColumns(
            {f"__m_{new}": F.max(f"__m_{new}").over(earlier) for new in columns}
        )
        out = join_small(self.df.withColumns(own), borders, self.keys + [RANGE])
        fixed = {new: F.greatest(F.col(new), F.col(f"__m_{new}")) for new in columns}
        return out.withColumns(fixed).drop(RANGE, *[f"__m_{new}" for new in columns])


def join_small(rows: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a table whose row count has a proven bound, so it is broadcast."""
    kept = [f"r.{c}" for c in rows.columns] + [f"v.{c}" for c in small.columns if c not in keys]
    joined = rows.alias("r").join(F.broadcast(small.alias("v")), _same("r", "v", keys), "left")
    return joined.select(*kept)


def number_rows(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Add consecutive numbers in the given total order without a one-task window.

    The range-sorted rows are fixed by a checkpoint; each partition's offset is the number of
    rows before it, from a table with one row per partition.
    """
    placed = materialise(
        df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).withColumns(
            {"__part": F.spark_partition_id(), "__seq": F.monotonically_increasing_id()}
        )
    )
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"), F.min("__seq").alias("__low"))
    before = F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("__part", "__low", F.coalesce(before, F.lit(0)).alias("__before"))
    numbered = join_small(placed, offsets, ["__part"])
    number = (F.col("__seq") - F.col("__low") + F.col("__before") + F.lit(start)).cast("long")
    return numbered.withColumn(name, number).drop("__part", "__seq", "__low", "__before")
