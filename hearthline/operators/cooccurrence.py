"""Who appears together: shared groups, close times, clusters and households."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.closeness import pairs_of_cells
from . import skew
from .components import connected_components
from .skew import SALT, HotKeys, find_hot_keys, join_values, number_rows, parts_of

# Microseconds per time unit.
UNIT_MICROS = {
    "us": 1, "ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000,
    "D": 86_400_000_000, "W": 604_800_000_000,
}


def _micros(delta: float, unit: str) -> int:
    if unit == "ns":
        return int(delta // 1000)
    if unit not in UNIT_MICROS:
        raise ValueError(f"unknown time unit {unit!r}, use ns or one of {sorted(UNIT_MICROS)}")
    return int(delta * UNIT_MICROS[unit])


def _time_number(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    kind = dict(df.dtypes)[name]
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(column.cast("timestamp"))
    return column.cast("bigint")


def _pairs(members: DataFrame, probes: DataFrame, key: str, condition: Column) -> DataFrame:
    """Pairs a < b of ``members`` (a row each) and ``probes`` with equal key.

    The pairs are the result asked for. Rows of a hot key are dealt over pieces on one side
    and repeated on the other, so its pairs are made by many tasks.
    """
    hot = find_hot_keys(members, [key], skew.MIN_PAIR_ROWS)
    if hot:
        members, probes = _deal(members, hot), _repeat(probes, hot)
        on = [key, SALT]
    else:
        on = [key]
    # The keys stay dealt over all parts: AQE would unite partitions by the size of their rows, which
    # says little of their pairs.
    parts = parts_of(members)
    members, probes = members.repartition(parts, *on), probes.repartition(parts, *on).hint("merge")
    same = reduce(lambda x, y: x & y, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on])
    joined = members.alias("l").join(probes.alias("r"), same & condition)
    return joined.select(
        F.least("l.who", "r.who").alias("a"), F.greatest("l.who", "r.who").alias("b")
    )


def _deal(df: DataFrame, hot: HotKeys) -> DataFrame:
    piece = hot.one(*df.columns)
    return df.withColumn(SALT, F.when(hot.holds(), piece).otherwise(F.lit(0)))


def _repeat(df: DataFrame, hot: HotKeys) -> DataFrame:
    pieces = hot.every()
    return df.withColumn(
        SALT, F.explode(F.when(hot.holds(), pieces).otherwise(F.array(F.lit(0))))
    )


def groups_co_occurrence(df: DataFrame, individual: str, group: str) -> DataFrame:
    """Columns a < b and ``n``: the number of groups two individuals share.

    Repeats within a group count once; null groups and individuals never match.
    """
    members = (
        df.select(F.col(individual).alias("who"), F.col(group).alias("grp"))
        .filter("who is not null and grp is not null")
        .distinct()
    )
    pairs = _pairs(members, members, "grp", F.col("l.who") < F.col("r.who"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"))


def time_co_occurrence(
    df: DataFrame,
    individual: str,
    times: Sequence[str],
    time_unit: str = "ns",
    time_delta: float = 0,
) -> DataFrame:
    """Columns a < b and ``n``: in how many of the time columns two individuals come close.

    Close means a gap of at most ``time_delta`` units between any of their rows; each column
    counts once. Null times never match.
    """
    delta = _micros(time_delta, time_unit)
    points = []
    for i, name in enumerate(times):
        rows = df.select(F.col(individual).alias("who"), _time_number(df, name).alias("t")).filter(
            "who is not null and t is not null"
        )
        if delta > 0:
            # Slots are as wide as delta: within one all are close, and between neighbours the
            # later side's first time and the earlier side's last decide. So an individual
            # needs two points per slot, however many times it has there.
            ends = F.array_distinct(F.array(F.min("t"), F.max("t"))).alias("t")
            slot = F.floor(F.col("t") / F.lit(delta)).cast("bigint").alias("slot")
            rows = rows.groupBy("who", slot).agg(ends).select("who", F.explode("t").alias("t"))
        else:
            rows = rows.distinct()
        points.append(rows.withColumn("var", F.lit(i)))
    return _close_pairs(reduce(DataFrame.unionByName, points), delta)


def _close_pairs(points: DataFrame, delta: int) -> DataFrame:
    """Columns a < b and ``n`` of the points ``who``, ``t``, ``var`` at most ``delta`` apart.

    Individuals fall to groups by their hash, and two groups (or one with itself) make a cell. A point is
    sent to every cell of its group, so what is shuffled grows with the points; the pairs of two
    individuals are all found in one cell, so none of them is shuffled.
    """
    parts = parts_of(points)
    groups = math.isqrt(2 * parts - 1) + 1  # about as many cells as parts
    own = F.pmod(F.xxhash64("who"), F.lit(groups)).cast("int")
    sent = points.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    cell = (F.least("own", "met") * groups + F.greatest("own", "met")).alias("cell")
    sent = sent.select(cell, (F.col("own") > F.col("met")).alias("second"), "who", "t", "var")
    kind = points.schema["who"].dataType
    schema = StructType().add("x", kind).add("y", kind).add("n", "long")
    found = (
        sent.repartition(parts, "cell").sortWithinPartitions("cell")
        .mapInArrow(pairs_of_cells(delta, groups), schema)
    )
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "n")


def _group_stars(nodes: DataFrame, key: Column) -> DataFrame:
    """Edges from every member of a group to the group's smallest member."""
    keyed = nodes.withColumn("key", key).filter("key is not null").select("node", "key").distinct()
    centre = keyed.groupBy("key").agg(F.min("node").alias("v"))
    stars = join_values(keyed, centre, ["key"], "left", null_safe=False)
    return stars.select(F.col("node").alias("u"), "v")


def _time_stars(nodes: DataFrame, time: str, delta: int) -> DataFrame:
    """Edges with the same components as all pairs at most ``delta`` apart.

    Members of a slot as wide as delta are all close to each other, so one star joins them;
    neighbouring slots are joined when the gap between their nearest members is small enough.
    """
    if delta == 0:
        return _group_stars(nodes, F.col(time))
    slotted = nodes.filter(F.col(time).isNotNull()).withColumn(
        "slot", F.floor(F.col(time) / F.lit(delta)).cast("bigint")
    )
    slots = slotted.groupBy("slot").agg(
        F.min("node").alias("v"), F.min(time).alias("lo"), F.max(time).alias("hi")
    )
    stars = join_values(
        slotted.select("node", "slot").distinct(), slots.select("slot", "v"), ["slot"],
        "left", null_safe=False,
    )
    ahead = slots.select((F.col("slot") - 1).alias("slot"), F.col("v").alias("u"), F.col("lo").alias("next_lo"))
    bridges = slots.join(ahead, "slot").filter(F.col("next_lo") - F.col("hi") <= delta)
    return stars.select(F.col("node").alias("u"), "v").unionByName(bridges.select("u", "v"))


def cluster(
    df: DataFrame,
    individual: str,
    group: str | None = None,
    times: Sequence[str] | str | None = None,
    time_unit: str = "ns",
    time_delta: float = 0,
    order: str | None = None,
    name: str = "cluster",
) -> DataFrame:
    """Add the number 1..k of each row's cluster of individuals.

    Individuals are linked by sharing a group or by close times; the clusters are the connected
    components, in order of their first row by the unique whole-number column ``order``
    (without it: by the smallest individual). No pairs are made: every group adds one edge per
    member. A row without an individual gets no cluster.
    """
    times = [times] if isinstance(times, str) else list(times or [])
    labels = cluster_labels(df, individual, group, times, time_unit, time_delta, order)
    numbered = number_rows(labels.select("root").distinct(), ["root"], "__k")
    people = join_values(labels, numbered, ["root"], "left", null_safe=False).select(
        F.col("who").alias(individual), F.col("__k").alias(name)
    )
    return join_values(df, people, [individual], "left", null_safe=False).select(
        *df.columns, name
    )


def cluster_labels(
    df: DataFrame,
    individual: str,
    group: str | None = None,
    times: Sequence[str] = (),
    time_unit: str = "ns",
    time_delta: float = 0,
    order: str | None = None,
) -> DataFrame:
    """Columns ``who`` (every individual once) and ``root`` (its component's first node)."""
    rows = df.filter(F.col(individual).isNotNull())
    columns = {f"t{i}": _time_number(df, t) for i, t in enumerate(times)}
    rows = rows.select(
        F.col(individual).alias("who"),
        *([F.col(group).alias("grp")] if group else []),
        *([F.col(order).cast("bigint").alias("pos")] if order else []),
        *[c.alias(t) for t, c in columns.items()],
    )
    if order:
        people = rows.groupBy("who").agg(F.min("pos").alias("node"))
    elif dict(rows.dtypes)["who"] in ("tinyint", "smallint", "int", "bigint"):
        people = rows.select("who", F.col("who").cast("bigint").alias("node")).distinct()
    else:
        people = number_rows(rows.select("who").distinct(), ["who"], "node")
    if order or "node" not in rows.columns:
        nodes = join_values(rows.drop("pos"), people, ["who"], "left", null_safe=False)
    edges = []
    if group:
        edges.append(_group_stars(nodes, F.col("grp")))
    delta = _micros(time_delta, time_unit)
    edges += [_time_stars(nodes, t, delta) for t in columns]
    if not edges:
        return people.withColumn("root", F.col("node")).drop("node")
    linked = connected_components(reduce(lambda a, b: a.unionByName(b), edges))
    roots = people.join(linked, "node", "left")
    return roots.select("who", F.coalesce("root", "node").alias("root"))


def household_clusters(
    df: DataFrame,
    person: str = "linkage_PID",
    household: str = "hh_id",
    name: str = "h_cluster",
) -> DataFrame:
    """One row per person with a household: cluster number and the cluster's number of people."""
    placed = df.select(person, household).filter(
        F.col(person).isNotNull() & F.col(household).isNotNull()
    )
    labels = cluster_labels(placed, person, household)
    sizes = labels.groupBy("root").agg(F.count("*").alias(f"{name}_ct"))
    numbered = number_rows(sizes, ["root"], name)
    return join_values(labels, numbered, ["root"], "left", null_safe=False).select(
        F.col("who").alias(person), name, f"{name}_ct"
    )


def household_edges(
    df: DataFrame, person: str = "linkage_PID", household: str = "hh_id"
) -> DataFrame:
    """Distinct (from, to) of people sharing a household, both ways and with self loops."""
    pairs = groups_co_occurrence(df, person, household).drop("n")
    own = (
        df.filter(F.col(household).isNotNull() & F.col(person).isNotNull())
        .select(F.col(person).alias("from"), F.col(person).alias("to"))
        .distinct()
    )
    there = pairs.select(F.col("a").alias("from"), F.col("b").alias("to"))
    back = pairs.select(F.col("b").alias("from"), F.col("a").alias("to"))
    return own.unionByName(there).unionByName(back)


def add_household_clusters(
    df: DataFrame, person: str = "linkage_PID", household: str = "hh_id"
) -> DataFrame:
    clusters = household_clusters(df, person, household)
    return join_values(df, clusters, [person], "left", null_safe=False)
