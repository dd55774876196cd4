import itertools
import random

import pytest
from helpers import moment, rows
from pyspark.sql import functions as F

from hearthline.operators import skew
from hearthline.operators.components import connected_components
from hearthline.operators.cooccurrence import (
    add_household_clusters,
    cluster,
    groups_co_occurrence,
    household_edges,
    time_co_occurrence,
)


def brute_components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("n,m", [(300, 200), (300, 280), (50, 400)])
@pytest.mark.parametrize("hot", [False, True])
def test_components(spark, n, m, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(skew, "MIN_HOT_ROWS", 0)
        monkeypatch.setattr(skew, "MIN_PAIR_ROWS", 0)
    rng = random.Random(n * m)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    got = dict(rows(connected_components(spark.createDataFrame(edges, "u long, v long"))))
    want = brute_components([(a, b) for a, b in edges if a != b])
    assert got == want


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(500)]
    star = [(1000, i) for i in range(1001, 1400)]
    got = dict(rows(connected_components(spark.createDataFrame(path + star, "u long, v long"))))
    assert set(got.values()) == {0, 1000} and len(got) == 901


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0


def visits(seed, n=40):
    """(row, person, group, two times), with nulls and repeats, from few values."""
    rng = random.Random(seed)
    some = lambda xs: None if rng.random() < 0.15 else rng.choice(xs)
    days = [moment(f"2016-08-{d:02d}") for d in range(1, 29)]
    return [(i, rng.randrange(25), some(range(18)), some(days), some(days)) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "ord long, guest long, room long, came timestamp, left timestamp")


def meetings(data, column):
    """Pairs of people with an equal, known value, and how many values they share."""
    shared = {}
    for a, b in itertools.permutations(data, 2):
        if a[1] < b[1] and a[column] is not None and a[column] == b[column]:
            shared.setdefault((a[1], b[1]), set()).add(a[column])
    return {pair: len(values) for pair, values in shared.items()}


def numbered(data, pairs):
    """Components of the people, numbered as their rows appear."""
    root = brute_components([(r[1], r[1]) for r in data] + sorted(pairs))
    number = {}
    return [number.setdefault(root[r[1]], len(number) + 1) for r in data]


def clusters(df, **kw):
    out = cluster(df, "guest", order="ord", **kw)
    return [r["cluster"] for r in out.orderBy("ord").collect()]


def pairs_of(df):
    return {(a, b): n for a, b, n in rows(df)}


@pytest.mark.parametrize("seed", [1, 2])
def test_groups(spark, seed):
    data = visits(seed)
    df = frame(spark, data)
    want = meetings(data, 2)
    assert pairs_of(groups_co_occurrence(df, "guest", "room")) == want
    assert clusters(df, group="room") == numbered(data, want)


@pytest.mark.parametrize("seed", [3, 4])
def test_times(spark, seed):
    data = visits(seed)
    df = frame(spark, data)
    came, left = set(meetings(data, 3)), set(meetings(data, 4))
    assert pairs_of(time_co_occurrence(df, "guest", ["came"])) == dict.fromkeys(came, 1)
    both = {pair: (pair in came) + (pair in left) for pair in came | left}
    assert {p: min(n, 1) for p, n in pairs_of(time_co_occurrence(df, "guest", ["came", "left"])).items()} == dict.fromkeys(both, 1)
    assert clusters(df, times=["came"]) == numbered(data, came)
    assert clusters(df, times=["came", "left"]) == numbered(data, both)


@pytest.mark.parametrize("seed", [5, 6])
def test_groups_and_times_together(spark, seed):
    data = visits(seed, 24)
    want = set(meetings(data, 2)) | set(meetings(data, 3))
    assert clusters(frame(spark, data), group="room", times="came") == numbered(data, want)


@pytest.mark.parametrize("delta", [0, 3, 40])
def test_time_clusters_equal_components_of_pairs(spark, delta):
    rng = random.Random(delta)
    data = [(i, rng.randrange(60), moment("2001-01-01").replace(day=1 + rng.randrange(20), hour=rng.randrange(24)))
            for i in range(90)]
    df = spark.createDataFrame(data, "ord long, p long, t timestamp")
    pairs = {r[:2] for r in rows(time_co_occurrence(df, "p", ["t"], "h", delta))}
    close = {tuple(sorted((a[1], b[1]))) for a, b in itertools.combinations(data, 2)
             if a[1] != b[1] and abs((a[2] - b[2]).total_seconds()) <= delta * 3600}
    assert pairs == close
    want = brute_components([(p, p) for _, p, _ in data] + sorted(close))
    got = {r["p"]: r["cluster"] for r in cluster(df, "p", times="t", time_unit="h", time_delta=delta, order="ord").collect()}
    assert len(set(zip((want[p] for p in got), got.values()))) == len(set(want.values())) == len(set(got.values()))
    firsts = [got[p] for _, p, _ in data]
    assert list(dict.fromkeys(firsts)) == sorted(set(firsts))  # numbered by first appearance


def test_pairs_of_a_hot_group(spark, monkeypatch):
    df = spark.range(120).select(F.col("id").alias("i"), F.expr("if(id % 2 = 0, 0, id % 7)").alias("g"))
    plain = rows(groups_co_occurrence(df, "i", "g"))
    close = rows(time_co_occurrence(df, "i", ["g"], "us", 1))
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 0)
    monkeypatch.setattr(skew, "MIN_PAIR_ROWS", 0)
    assert rows(groups_co_occurrence(df, "i", "g")) == plain
    assert rows(time_co_occurrence(df, "i", ["g"], "us", 1)) == close


def test_cluster_on_text_ids_and_unknown_unit(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), (None, 2)], "p string, g int")
    assert rows(cluster(df, "p", "g"), "p", "cluster") == [(None, None), ("a", 1), ("b", 1), ("c", 2)]
    with pytest.raises(ValueError):
        cluster(df, "p", times="g", time_unit="fortnight", time_delta=1)


def test_households(spark):
    data = [(1, "A"), (1, "A"), (2, "A"), (2, "B"), (3, "B"), (4, "C"), (None, "C"), (5, None)]
    df = spark.createDataFrame(data, "linkage_PID int, hh_id string")
    assert rows(household_edges(df)) == sorted(
        [(1, 1), (2, 2), (3, 3), (4, 4), (1, 2), (2, 1), (2, 3), (3, 2)], key=str)
    got = rows(add_household_clusters(df).distinct(), "linkage_PID", "hh_id", "h_cluster", "h_cluster_ct")
    assert got == [(None, "C", None, None), (1, "A", 1, 3), (2, "A", 1, 3), (2, "B", 1, 3), (3, "B", 1, 3),
                   (4, "C", 2, 1), (5, None, None, None)]


def test_close_times_are_found_without_shuffling_pairs(spark, monkeypatch):
    """Everyone meets everyone at two times: the pairs are many, and none of them is sorted or shuffled."""
    from hearthline.functions import closeness

    monkeypatch.setattr(closeness, "HELD_PAIRS", 50)
    rng = random.Random(9)
    data = [(f"p{i % 40}", rng.randrange(-300, 300), rng.choice([None, 7, 8, 20])) for i in range(160)] + [(None, 1, 1)]
    df = spark.createDataFrame(data, "p string, t long, u long")
    for delta in (0, 3):
        got = time_co_occurrence(df, "p", ["t", "u"], "us", delta)
        want = {}
        for column in (1, 2):
            close = {
                (a[0], b[0]) for a, b in itertools.product(data, data)
                if None not in (a[0], b[0], a[column], b[column]) and a[0] < b[0] and abs(a[column] - b[column]) <= delta
            }
            for pair in close:
                want[pair] = want.get(pair, 0) + 1
        assert pairs_of(got) == want and got.count() == len(want)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[: plan.index("MapInArrow")]


def test_pairs_of_groups_are_made_in_as_many_tasks_as_parts(spark):
    df = spark.range(400).select((F.col("id") % 50).alias("i"), (F.col("id") % 23).alias("g"))
    got = groups_co_occurrence(df, "i", "g")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "Broadcast" not in plan
    data = sorted({(r["i"], r["g"]) for r in df.collect()})
    want = {}
    for (a, g), (b, h) in itertools.product(data, data):
        if a < b and g == h:
            want[a, b] = want.get((a, b), 0) + 1
    assert pairs_of(got) == want
