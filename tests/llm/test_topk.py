"""Exact top-k against the full product."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.llm import topk as T


@pytest.mark.parametrize("seed,n,spread", [(0, 300, 20), (1, 40, 2), (2, 5, 30), (3, 200, 0)])
def test_index_equals_full_product(seed, n, spread):
    rng = np.random.default_rng(seed)
    ids, vectors = rng.permutation(10 * n)[:n], rng.integers(-spread, spread + 1, (n, 12))
    queries, own = vectors[: min(n, 20)], ids[: min(n, 20)]
    for (got, score), q, o in zip(T.ImpactIndex(ids, vectors).search(queries, own, 7, few=1), queries, own):
        want = sorted((-int(v @ q), int(i)) for i, v in zip(ids, vectors) if i != o)[:7]
        assert list(zip((-score).tolist(), got.tolist())) == want


def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(0, 0.1, 8).astype(float).tolist()) for i in range(300)]
    rows += [(301, None), (302, [0.1, None]), (303, [float("nan")]), (304, [float("inf")]), (None, [0.1] * 8), (305, []), (306, [0.5, -0.5]), (7, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = df.select("vec_id", T.quantised(F.col("embedding")).alias("v"))
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all():
            whole.setdefault(i, []).append(np.pad(np.floor(64 * np.float32(v).astype(float)).astype(int), (0, 8 - len(v))))
    queries = vectors.filter("vec_id % 10 = 5").withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in T.top_k(vectors, queries, 5, block_vectors=64, block_queries=8).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in [i for i in whole if i % 10 == 5]:
        best = sorted((-int(c @ whole[q][0]), i) for i, cs in whole.items() if i != q for c in cs)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert T.top_k(vectors.limit(0), queries, 5).count() == 0 and T.top_k(vectors, queries.limit(0), 5).count() == 0
    assert T.top_k(vectors.filter("vec_id < 3"), queries, 5).groupBy("query_id").count().filter("count <> 3").count() == 0


def test_large_components(spark):
    values = [1e8, -1e8, 1e30, -1e30, 3.5e7, 1.0, 2.0**40, -(2.0**40) - 0.5, 0.0]
    rng = np.random.default_rng(6)
    rows = [(i, rng.choice(values, 4).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = df.select("vec_id", T.quantised(F.col("embedding")).alias("v"))
    whole = {i: [int(np.clip(np.floor(64 * x), -(2.0**56), 2.0**56)) for x in v] for i, v in rows}
    assert {r.vec_id: r.v for r in vectors.collect()} == whole
    got = {}
    for r in T.top_k(vectors, vectors.filter("vec_id < 9").withColumnRenamed("vec_id", "query_id"), 7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(9):
        best = sorted((-max(min(sum(a * b for a, b in zip(whole[q], v)), 2**63 - 1), 1 - 2**63), i) for i, v in whole.items() if i != q)[:7]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
