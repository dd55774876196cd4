"""Exact top-k inner products from an impact-ordered index, score at a time.

Vectors and queries meet in blocks. A block's index holds the vectors' components in segments by
descending quantised impact (size of the component). Segments are processed in that order for all
queries of the block that still need them. After each one, the norms of what is still unprocessed
bound every score from both sides; a query stops only when these bounds prove that all but a few
vectors stand outside its k best, and the possible members are then scored exactly in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

#: Lower edges of the impact levels, as parts of the block's largest component; the last holds all the rest.
LEVELS = (0.5, 0.35, 0.2, 0.1, 0.0)
VECTORS, QUERIES = 8_192, 1_024
#: A query goes on to exact scores once so many times k vectors, or fewer, can still be members.
FEW = 8
#: Scaled components are taken as this at most; scores beyond 64 bits as the largest or smallest of them.
LARGEST, LONGEST = 2.0**56, (1 << 63) - 1


class ImpactIndex:
    """Segments of a block of integer vectors by descending impact, and the norms left after each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: tuple[float, ...] = LEVELS):
        order = np.argsort(ids, kind="stable")  # equal scores: the smaller id first
        self.ids, self.vectors = ids[order], vectors[order]
        size = np.abs(self.vectors)
        edges = [np.inf, *(x * size.max(initial=0) for x in levels)]
        self.segments, self.left = [], []
        for upper, lower in zip(edges, edges[1:]):
            inside = (size >= lower) & (size < upper)
            self.segments.append(np.where(inside, self.vectors, 0).astype(np.float64).T.copy())
            rest = np.where(size < lower, self.vectors, 0).astype(np.float64)
            self.left.append(np.sqrt((rest * rest).sum(axis=1)) * (1 + 1e-9))
        whole = self.vectors.astype(np.float64)
        # What the roundings of the scores can come to, besides.
        self.rounding = np.sqrt((whole * whole).sum(axis=1)) * 1e-12 * max(1, vectors.shape[1])

    def scores(self, members: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products; those beyond 64 bits are the largest or smallest number of them."""
        rows = self.vectors[members]
        if np.abs(rows).max(initial=0).astype(float) * np.abs(query).max(initial=0).astype(float) * len(query) < 2.0**62:
            return rows @ query
        return np.clip(rows.astype(object) @ query.astype(object), -LONGEST, LONGEST).astype(np.int64)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, few: int = FEW) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every query: ids and exact scores of its k best, by score and then id; ids equal to ``own`` are left out."""
        n, out = len(self.ids), [None] * len(queries)
        q = queries.astype(np.float64)
        norm = np.sqrt((q * q).sum(axis=1))
        open_, score = np.arange(len(queries)), np.zeros((len(queries), n))
        for level, (segment, left) in enumerate(zip(self.segments, self.left)):
            score += q[open_] @ segment
            slack = norm[open_, None] * (left + self.rounding)[None, :] + 1e-6
            barred = self.ids[None, :] == own[open_, None]
            # A score beyond 64 bits counts as the last number of them, for its bounds too.
            lower = np.where(barred, -np.inf, np.clip(score - slack, -(2.0**63), 2.0**63))
            bar = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_), -np.inf)
            possible = (np.clip(score + slack, -(2.0**63), 2.0**63) >= bar[:, None]) & ~barred
            done = (possible.sum(axis=1) <= few * k) | (level == len(self.segments) - 1)
            for i in np.flatnonzero(done):
                members = np.flatnonzero(possible[i])
                exact = self.scores(members, queries[open_[i]])
                # Members come by id, so a stable sort leaves ties in that order.
                best = np.argsort(-exact, kind="stable")[:k]
                out[open_[i]] = (self.ids[members][best], exact[best])
            open_, score = open_[~done], score[~done]
            if not len(open_):
                break
        return out


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component; null for a vector that is null or holds a null or non-finite one.

    Components of 2^56 and more, after scaling, count as 2^56, those below -2^56 as -2^56.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(LARGEST)), F.lit(-LARGEST)))))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column.to_pylist()):
        out[i, : len(v)] = v
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int, block_vectors: int = VECTORS, block_queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query.

    ``vectors`` has vec_id and v, ``queries`` query_id and v (arrays of long; rows with a null in
    either column take no part). Vectors with the query's own id are no candidates. Ties go to the
    smaller vec_id, and a query with fewer candidates gets all. Of different lengths, the missing
    components count as 0. Repeated rows of an id are candidates each; equal query ids are ranked
    together. A score beyond 64 bits counts as the largest long, or that with a minus. Either table may be empty. ``block_*`` bound what one task holds.
    """
    vectors = vectors.select("vec_id", "v").filter("vec_id is not null and v is not null")
    queries = queries.select("query_id", "v").filter("query_id is not null and v is not null")
    n, m = vectors.count(), queries.count()
    rows, columns = max(1, -(-n // block_vectors)), max(1, -(-m // block_queries))
    left = vectors.withColumn("cb", F.pmod(F.xxhash64("vec_id"), F.lit(rows)))
    left = left.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    right = queries.withColumn("qb", F.pmod(F.xxhash64(F.lit(1), "query_id"), F.lit(columns)).cast("int"))
    right = right.withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rows - 1).cast("long"))))

    def meet(vs: pa.Table, qs: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(qs)
        if len(vs) and len(qs):
            width = max(max(map(len, vs["v"].to_pylist())), max(map(len, qs["v"].to_pylist())), 1)
            index = ImpactIndex(vs["vec_id"].to_numpy(), _matrix(vs["v"], width))
            wanted, own = _matrix(qs["v"], width), qs["query_id"].to_numpy()
            found = [x for at in range(0, len(qs), 128) for x in index.search(wanted[at : at + 128], own[at : at + 128], k)]
        sizes = [len(ids) for ids, _ in found]
        flat = lambda i: np.concatenate([np.zeros(0, np.int64), *(x[i] for x in found)])
        names = np.repeat(qs["query_id"].to_numpy(), sizes) if len(qs) else np.zeros(0, np.int64)
        return pa.table({"query_id": names.astype(np.int64), "vec_id": flat(0), "score": flat(1)})

    best = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(meet, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_exact_topk(spark, sf_dir) -> DataFrame:
    """The 20 nearest of every 20th row of ``embeddings`` among all other rows."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("v"))
    queries = vectors.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return top_k(vectors, queries, 20)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s
)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
"""
