"""Connected components of an edge list.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce
and Beyond", 2014) on DataFrames. Each round is checkpointed to the shared folder, so lineage
stays short and a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import skew
from .skew import find_hot_keys, no_hot_keys, with_group_values


def _with_smallest(edges: DataFrame, rows: int) -> DataFrame:
    """Add ``m``, the smallest neighbour of each ``u``; with few edges in all no node is hot."""
    few = rows < skew.MIN_HOT_ROWS
    hot = no_hot_keys(edges, ["u"]) if few else find_hot_keys(edges, ["u"])
    return with_group_values(edges, ["u"], {"m": F.min("v")}, hot)


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every larger neighbour of a node is attached to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _with_smallest(both, 2 * rows)
        .filter("v > u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    )


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Smaller neighbours and the node itself are attached to the smallest of them."""
    ends = F.explode(F.array("u", "v")).alias("u")
    return _with_smallest(edges, rows).select(ends, F.col("m").alias("v")).filter("u != v")


def _print_of(edges: DataFrame) -> tuple:
    """Row count and order-free digest of the edge set."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Columns ``node`` and ``root`` (the component's smallest node) for every node with an edge.

    ``edges`` has two comparable columns ``u`` and ``v`` of one type; self loops are ignored and
    do not make a node appear.
    """
    current = materialise(
        edges.filter("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    seen = _print_of(current)
    for _ in range(max_rounds):
        rows = seen[0]
        current = materialise(_small_star(_large_star(current, rows), rows).distinct())
        now = _print_of(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    # A stable edge list is one star per component: every node points at the smallest.
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
