"""Targets, flow and selection."""

import itertools
import random

import pytest

from hearthline.llm import mixing as M


def test_capped_shares():
    assert M.capped_shares(60, [1, 2, 3], [100, 100, 100]) == [10, 20, 30]
    got = M.capped_shares(60, [1, 2, 3], [100, 100, 6])
    assert got == [18, 36, 6]
    assert M.capped_shares(60, [1, 1], [10, 20]) == [10, 20]
    assert M.capped_shares(10, [], []) == []


def best_cost(words, members, quotas, most):
    """The cheapest way to route as much as possible, by trying everything."""
    choices = []
    for w, ms in zip(words, members):
        choices.append([c for c in itertools.product(range(most * w + 1), repeat=len(ms)) if sum(c) <= most * w])
    best = (0, 0)
    for pick in itertools.product(*choices):
        into = [0] * len(quotas)
        for ms, c in zip(members, pick):
            for s, x in zip(ms, c):
                into[s] += x
        if any(x > q for x, q in zip(into, quotas)):
            continue
        cost = sum(k // w for w, c in zip(words, pick) for k in range(sum(c)))
        best = min(best, (-sum(into), cost))
    return best


@pytest.mark.parametrize("seed", range(8))
def test_flow_is_cheapest(seed):
    rng = random.Random(seed)
    words = [rng.randint(1, 3) for _ in range(3)]
    members = [sorted(rng.sample(range(2), rng.randint(1, 2))) for _ in words]
    quotas = [rng.randint(0, 6) for _ in range(2)]
    routed = M.route(words, members, quotas, 2)
    assert all(sum(r) <= 2 * w for r, w in zip(routed, words))
    assert all(sum(r[s] for r in routed) <= q for s, q in enumerate(quotas))
    assert all(r[s] == 0 for r, ms in zip(routed, members) for s in range(2) if s not in ms)
    cost = sum(k // w for w, r in zip(words, routed) for k in range(sum(r)))
    assert (-sum(map(sum, routed)), cost) == best_cost(words, members, quotas, 2)


def docs_of(spark, n=3_000):
    rng = random.Random(5)
    names = ["b", "a", None, "é"]
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(names + ["a"] * 4), "clash") for i in range(n)]
    rows += [(None, None, "a", None), (7, rows[7][1], rows[7][2], None), (8, "", "solo", None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_mix(spark):
    rows, docs = docs_of(spark)
    found = M.mix(docs, M.cycling_weights)
    assert [s for s, *_ in found.sources] == ["a", "b", "solo", "é", None]
    out = found.docs.collect()
    assert len(out) == len(rows) and found.docs.columns == ["doc_id", "text", "source", "size", "copies"]
    for name, held, target, routed in found.sources:
        taken = sum(r.size * r.copies for r in out if r.source == name)
        assert held == sum(r.size for r in out if r.source == name) and abs(routed - target) <= 1
        assert abs(taken - target) <= 12
    assert all(0 <= r.copies <= 3 for r in out)
    again = M.mix(docs.repartition(5), M.cycling_weights).docs.collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))
    light = M.mix(docs, M.cycling_weights, columns=["doc_id"]).docs
    assert light.columns == ["doc_id", "size", "copies"]
    assert sorted(repr((r.doc_id, r.copies)) for r in light.collect()) == sorted(repr((r.doc_id, r.copies)) for r in out)
    assert M.mix(docs.filter("false"), M.cycling_weights).docs.count() == 0


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["x"] if i % 3 == 0 else ["y"] if i % 3 == 1 else ["y", "x", "x"]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, member array<string>")
    found = M.mix(docs, lambda names: [1.0, 2.0], membership="member")
    assert [(s, h) for s, h, *_ in found.sources] == [("x", 6_000), ("y", 6_000)]
    assert [r for *_, r in found.sources] == [3_000, 6_000]
    out = found.docs.collect()
    # Nothing need repeat: 9,000 words are wanted and 9,000 are there.
    assert {r.copies for r in out} == {1}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    given = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = M.op6_source_mix(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(given)
    assert all(r.size == len(given[r.doc_id].text.encode().split()) and r.taken in {0, r.size, 2 * r.size, 3 * r.size} for r in rows)
    assert sum(r.size for r in rows) == pytest.approx(sum({given[r.doc_id].source: r.target for r in rows}.values()))
