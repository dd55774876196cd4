"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A flow routes
the patterns' words to the sources' targets; using a pattern's words once more costs one more than
the time before, so repetition is spread before it is piled up. Each pattern's flow becomes whole
repetitions for all its documents plus a seeded selection of documents for the rest.

Only patterns, sources and at most 4,096 partial sums a pattern are gathered anywhere; documents
are decided where they lie.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, written

#: The flow is solved on the driver: more distinct patterns than this are an error, not cut off.
MAX_PATTERNS = 100_000
#: Documents of a pattern that one bucket of the seeded order should hold, and the most buckets.
BUCKET_DOCS, MAX_BUCKETS = 256, 4_096


def capped_shares(total: float, weights: list[float], caps: list[float]) -> list[float]:
    """Shares of a total by weight; none exceeds its cap, the excess is reshared by weight."""
    out = [0.0] * len(weights)
    free, rest = [i for i in range(len(weights)) if weights[i] > 0], float(total)
    while free:
        scale = sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] / scale > caps[i]]
        for i in over or free:
            out[i] = float(caps[i]) if over else rest * weights[i] / scale
        if not over:
            break
        rest -= sum(caps[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


class _Flow:
    """Min-cost maximum flow with whole capacities: potentials, then blocking flows on the cheapest arcs."""

    def __init__(self, n: int):
        self.arcs: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def add(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.arcs[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _distances(self, source: int) -> list[float]:
        far = [float("inf")] * len(self.arcs)
        far[source], queue, queued = 0, deque([source]), {source}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in self.arcs[a]:
                b = self.to[e]
                if self.room[e] and far[a] + self.cost[e] < far[b]:
                    far[b] = far[a] + self.cost[e]
                    if b not in queued:
                        queued.add(b)
                        queue.append(b)
        return far

    def run(self, source: int, sink: int) -> None:
        while (far := self._distances(source))[sink] < float("inf"):
            while True:
                tight = lambda a, e: self.room[e] and far[self.to[e]] == far[a] + self.cost[e]
                level, queue = {source: 0}, deque([source])
                while queue:
                    a = queue.popleft()
                    for e in self.arcs[a]:
                        if tight(a, e) and self.to[e] not in level:
                            level[self.to[e]] = level[a] + 1
                            queue.append(self.to[e])
                if sink not in level:
                    break
                at, path, a = [0] * len(self.arcs), [], source
                while True:
                    if a == sink:
                        push = min(self.room[e] for e in path)
                        for e in path:
                            self.room[e] -= push
                            self.room[e ^ 1] += push
                        path, a = [], source
                    elif at[a] < len(self.arcs[a]):
                        e = self.arcs[a][at[a]]
                        if tight(a, e) and level.get(self.to[e]) == level[a] + 1:
                            path.append(e)
                            a = self.to[e]
                        else:
                            at[a] += 1
                    elif path:
                        a = self.to[path.pop() ^ 1]
                        at[a] += 1
                    else:
                        break


def route(words: list[int], members: list[list[int]], quotas: list[int], max_repeat: int) -> list[list[int]]:
    """Words that each source gets of each pattern; the k-th use of a pattern's words costs k - 1 each."""
    n, m = len(words), len(quotas)
    flow, source, sink = _Flow(n + m + 2), n + m, n + m + 1
    for p, w in enumerate(words):
        for k in range(max_repeat):
            flow.add(source, p, w, k)
    arcs = [[(s, flow.add(p, n + s, max_repeat * words[p], 0)) for s in members[p]] for p in range(n)]
    for s, q in enumerate(quotas):
        flow.add(n + s, sink, q, 0)
    flow.run(source, sink)
    out = [[0] * m for _ in range(n)]
    for p in range(n):
        for s, e in arcs[p]:
            out[p][s] = flow.room[e ^ 1]
    return out


@dataclass(frozen=True)
class Mix:
    """``docs`` with ``size`` and ``copies``; ``sources``: name, size, target and routed words of each."""

    docs: DataFrame
    sources: list[tuple[str | None, int, float, int]]


def _pattern(membership: Column, is_array: bool) -> Column:
    """A JSON text, as it can be a key: sorted distinct sources, null among them. No source at all is []."""
    return F.to_json(F.array_sort(F.array_distinct(F.coalesce(membership, F.array())))) if is_array else F.to_json(F.array(membership))


def mix(
    docs: DataFrame, weights, membership: str = "source", text: str = "text", key: str = "doc_id",
    max_repeat: int = 3, total: int | None = None, seed: int = 7, columns: list[str] | None = None,
) -> Mix:
    """Decide how often the mix takes every document.

    ``membership`` is a string column (one source; null is a source of its own) or an array of
    strings. ``weights(names)`` gives the weights of the sources, sorted by code point with null
    last. The sources share ``total`` words (default: all words, each document once); no target
    exceeds ``max_repeat`` times its source's words. Input columns ``size`` and ``copies`` give way.
    A null text has size 0; documents of size 0 count to the mix like others of their pattern but
    add no words. Repeated rows are documents of their own. Equal inputs and seeds give equal
    results. An empty table gives none. ``columns`` (default: all) come back; without the text among
    them the texts are read only once.
    """
    kept = [c for c in columns or docs.columns if c not in ("size", "copies")]
    own = [F.col(f"`{c}`") for c in kept]
    is_array = dict(docs.dtypes)[membership].startswith("array")
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    marks = [
        size.alias("__size"),
        _pattern(F.col(membership), is_array).alias("__pattern"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("__u"),
    ]
    light = text not in kept
    sized = written(docs.select(*(own if light else []), *marks), "mix-sizes")
    stats = sized.groupBy("__pattern").agg(F.sum("__size").alias("w"), F.count("*").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(stats) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    stats = sorted((r["__pattern"], r.w, r.n) for r in stats)
    member = {p: json.loads(p) for p, _, _ in stats}
    names = sorted({s for m in member.values() for s in m}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    held = [0] * len(names)
    for p, w, _ in stats:
        for s in member[p]:
            held[place[s]] += w
    total = sum(w for _, w, _ in stats) if total is None else total
    targets = capped_shares(total, list(weights(names)), [max_repeat * h for h in held])
    routed = route([w for _, w, _ in stats], [[place[s] for s in member[p]] for p, _, _ in stats], [round(t) for t in targets], max_repeat)
    plan = []
    for (p, w, n), parts in zip(stats, routed):
        whole, rest = divmod(sum(parts), w) if w else (0, 0)
        buckets = min(MAX_BUCKETS, 1 << max(0, (n - 1) // BUCKET_DOCS).bit_length())
        plan.append((p, whole, rest, buckets))
    chosen = _choose(sized if light else docs.select(*own, *marks), sized, plan)
    out = chosen.select(*own, F.col("__size").alias("size"), F.col("__copies").alias("copies"))
    return Mix(out, [(s, held[i], targets[i], sum(r[i] for r in routed)) for i, s in enumerate(names)])


def _choose(docs: DataFrame, sized: DataFrame, plan: list) -> DataFrame:
    """Whole repetitions, plus one for the first documents in seeded order while the pattern's rest lasts.

    Partial sums by bucket of the order find the bucket where the rest runs out; only that one
    bucket of a pattern, about 256 documents or a 4,096th of the pattern, is walked in one task,
    taking each document that still fits.
    """
    spark = docs.sparkSession
    bucket = F.pmod(F.shiftright("__u", 20), F.col("__buckets"))
    schema = "__pattern string, __whole long, __rest long, __buckets long"
    parts = F.broadcast(spark.createDataFrame(plan, schema))
    by_bucket = sized.join(parts, "__pattern").groupBy("__pattern", bucket.alias("b")).agg(F.sum("__size").alias("w"))
    upto = F.sum("w").over(W.partitionBy("__pattern").orderBy("b"))
    edges = (
        by_bucket.join(parts, "__pattern").withColumn("upto", upto).filter("upto > __rest").groupBy("__pattern")
        .agg(F.min(F.struct("b", (F.col("__rest") - F.col("upto") + F.col("w")).alias("left"))).alias("e")).collect()
    )
    edge = {r["__pattern"]: (r.e.b, r.e.left) for r in edges}
    rows = [(p, whole, n, *edge.get(p, (n, 0))) for p, whole, _, n in plan]
    full = F.broadcast(spark.createDataFrame(rows, "__pattern string, __whole long, __buckets long, __edge long, __left long"))
    marked = docs.join(full, "__pattern").withColumn("__b", bucket)
    sure = marked.filter("__b <> __edge").withColumn("__copies", F.col("__whole") + (F.col("__b") < F.col("__edge")).cast("long"))
    schema = sure.schema

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["__u", "__size"], kind="stable", ignore_index=True)
        left, copies = int(rows["__left"].iloc[0]) if len(rows) else 0, []
        for size, whole in zip(rows["__size"], rows["__whole"]):
            take = 0 < size <= left
            left -= size * take
            copies.append(whole + take)
        return rows.assign(__copies=copies)[[f.name for f in schema.fields]]

    return sure.unionByName(marked.filter("__b = __edge").groupBy("__pattern").applyInPandas(walk, schema))


def cycling_weights(names: list) -> list[float]:
    return [float(i % 3 + 1) for i in range(len(names))]


def op6_source_mix(spark, sf_dir) -> DataFrame:
    """Mix all ``documents``: sources weigh 1, 2, 3, repeating."""
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = mix(docs, cycling_weights, columns=["doc_id", "source"])
    rows = [(s, h, t) for s, h, t, _ in found.sources]
    schema = "s string, source_size long, target double"
    by_source = F.broadcast(spark.createDataFrame(rows, schema))  # as many rows as sources, bounded by MAX_PATTERNS
    return found.docs.join(by_source, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
