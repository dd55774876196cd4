"""The plans for hot keys give the same rows as the plain ones."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from hearthline.operators import skew
from hearthline.operators.joins import merge_on
from hearthline.operators.spells import covered_days, spell_history


@pytest.fixture
def tilted(spark):
    """Half of the rows have key 0, with repeated and missing order values."""
    return spark.range(3000).select(
        F.col("id").alias("ord"),
        F.expr("if(pmod(xxhash64(id), 2) = 0, 0, nullif(pmod(xxhash64(id, 1), 50), 7))").cast("int").alias("k"),
        F.expr("date_add(date'2005-01-01', cast(pmod(xxhash64(id, 2), 400) as int))").alias("d"),
        F.expr("nullif(pmod(xxhash64(id, 3), 30), 3)").cast("int").alias("v"),
    ).withColumn("d", F.when(F.col("v") != 5, F.col("d")))


NONE = lambda *keys: skew.HotKeys(tuple(keys), 8)


@pytest.fixture
def low_bar(monkeypatch):
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 0)


def test_hot_keys_are_found(spark, tilted, low_bar):
    hot = skew.find_hot_keys(tilted, ["k"])
    assert len(hot.hashes) == 1
    assert tilted.filter(hot.holds()).select("k").distinct().collect()[0][0] == 0
    assert not skew.find_hot_keys(tilted, ["ord"])


def test_pieces_follow_the_count(spark, low_bar):
    """With many partitions configured, a key of 1/600 of the rows is hot; the pieces are its shares."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2000)
    try:
        df = spark.range(60_000).selectExpr("CASE WHEN id < 100 THEN -1 WHEN id < 20100 THEN -2 ELSE id END AS k")
        hot = skew.find_hot_keys(df, ["k"])
        sizes = {r["k"]: r["n"] for r in df.select("k", hot.count().alias("n")).distinct().collect() if r["k"] < 0}
        assert sizes == {-1: 4, -2: 1024} and len(hot.hashes) == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_keys_need_many_rows(tilted):
    assert not skew.find_hot_keys(tilted, ["k"])


def test_group_values(tilted, low_bar):
    aggs = {"n": F.count("*"), "top": F.max("v")}
    hot = skew.with_group_values(tilted, ["k"], aggs)
    plain = skew.with_group_values(tilted, ["k"], aggs, NONE("k"))
    assert hot.columns == plain.columns and rows(hot) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_join_values(spark, tilted, low_bar, how, null_safe):
    values = spark.createDataFrame([(0, "a"), (0, "b"), (3, "c"), (None, "d")], "k int, t string")
    hot = skew.join_values(tilted, values, ["k"], how, null_safe=null_safe)
    plain = skew.join_values(tilted, values, ["k"], how, NONE("k"), null_safe=null_safe)
    columns = sorted(plain.columns)
    assert sorted(hot.columns) == columns and rows(hot, *columns) == rows(plain, *columns)


@pytest.mark.parametrize("order", [["d", "ord"], ["v", "d", "ord"], ["ord"]])
def test_lead_and_max_before(tilted, low_bar, order):
    hot = skew.OrderedGroups(tilted, ["k"], order)
    assert hot.hot
    plain = skew.OrderedGroups(tilted, ["k"], order, NONE("k"))
    moved = {"next_v": "v", "next_ord": "ord"}
    assert rows(hot.lead(moved)) == rows(plain.lead(moved))
    assert rows(hot.max_before({"m": "d"})) == rows(plain.max_before({"m": "d"}))


def test_ranges_are_balanced(tilted, low_bar):
    cut = skew.OrderedGroups(tilted, ["k"], ["d", "ord"]).df.filter("k = 0")
    sizes = [r["count"] for r in cut.groupBy(skew.RANGE).count().collect()]
    assert len(sizes) >= 7 and max(sizes) < sum(sizes) / 3


@pytest.mark.parametrize("how", ["left", "right"])
def test_merge_on(spark, tilted, low_bar, how):
    right = spark.createDataFrame([(0, 1), (0, 2), (3, 3), (99, 4), (None, 5)], "kk int, v int")
    hot = merge_on(tilted, right, "k", "kk", how)
    plain = merge_on(tilted, right, "k", "kk", how, NONE("k"))
    assert plain.columns == ["ord", "k", "d", "v_x", "v_y"] == hot.columns
    assert rows(hot) == rows(plain)
    same = right.withColumnRenamed("kk", "k")
    assert rows(merge_on(tilted, same, "k", "k", how)) == rows(
        merge_on(tilted, same, "k", "k", how, NONE("k")))


def test_merge_on_right_keeps_clients_without_enrolment(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "p int, x string")
    right = spark.createDataFrame([(2, 20), (3, 30)], "c int, y int")
    assert rows(merge_on(left, right, "p", "c", "right")) == [(None, None, 30), (2, "b", 20)]
    assert rows(merge_on(left, right.withColumnRenamed("c", "p"), "p", "p", "right")) == [
        (2, "b", 20), (3, None, 30)]


def test_number_rows(spark, tilted):
    got = skew.number_rows(tilted, ["k", "d", "ord"], "n", start=5)
    by_hand = sorted(tilted.collect(), key=lambda r: tuple((x is None, x or 0 if not hasattr(x, "year") else x.toordinal()) for x in (r["k"], r["d"], r["ord"])))
    assert [r["ord"] for r in sorted(got.collect(), key=lambda r: r["n"])] == [r["ord"] for r in by_hand]
    assert [r["n"] for r in got.orderBy("n").collect()] == list(range(5, 3005))


def test_spell_history_on_a_hot_person(tilted, monkeypatch):
    spells = tilted.dropna(subset=["d"]).select(
        F.coalesce("k", F.lit(1)).alias("linkage_PID"), F.col("d").alias("entry"),
        F.expr("date_add(d, v - 2)").alias("exit"), "ord",
        F.expr("if(v % 3 = 0, 'HMIS', 'SHA')").alias("agency"),
        F.expr("if(v % 2 = 0, 'Day Shelter', 'Other')").alias("hmis_proj_type"))
    plain = rows(spell_history(spells, "ord"))
    days = rows(covered_days(spells, ["linkage_PID"], "n", "ord", "entry", "exit"))
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 0)
    assert rows(spell_history(spells, "ord")) == plain
    assert rows(covered_days(spells, ["linkage_PID"], "n", "ord", "entry", "exit")) == days


@pytest.mark.parametrize("least", [0, 10**9])
def test_widening_with_a_hot_key(spark, monkeypatch, least):
    from hearthline.operators import skew, widen

    data = [(1, "in", i) for i in range(60)] + [(None, "in", -1), (1, "out", 7), (2, "out", 8), (3, "in", 9), (None, "out", 5), (None, "out", 6), (4, None, 1)]
    df = spark.createDataFrame(data, "k int, s string, m int")
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", least)
    got = widen.split_rows_to_columns(df, "s", {"in": "_in", "out": "_out"}, "k")
    want = [(1, i, 7) for i in range(60)] + [(2, None, 8), (3, 9, None), (None, -1, 5), (None, -1, 6)]
    assert sorted(map(tuple, got.select("k", "m_in", "m_out").collect()), key=repr) == sorted(want, key=repr)
    assert bool(skew.find_hot_keys(df.select("k"), ["k"])) == (least == 0)


def test_collapsing_stages_equals_widening_first(spark):
    from hearthline.operators import widen

    data = [(k, s, o, m, t) for o, (k, s, m, t) in enumerate(
        [(1, "in", 3, "a"), (1, "in", 5, "b"), (1, "out", 2, "c"), (2, "out", 4, None), (2, "out", None, "d"), (None, "in", 1, "e"), (None, "in", 9, "f"),
         (None, "out", 6, None), (None, "out", 8, "g"), (3, None, 1, "h"), (4, "in", None, None)])]
    df = spark.createDataFrame(data, "k int, s string, o int, m int, t string")
    stages = {"in": "_in", "out": "_out"}
    wide = widen.split_rows_to_columns(df, "s", stages, "k")
    from pyspark.sql import functions as F

    place = F.struct(*[x for c in ("o_in", "o_out") for x in (F.col(c).isNull(), F.col(c))])
    wide = wide.withColumn("o", place).drop("o_in", "o_out")
    want = widen.collapse_to_max(wide, "k", ["m_in", "m_out"], ["o"])
    got = widen.collapse_stages_to_max(df, "k", "s", stages, ["m"], "o")
    columns = ["k", "m_in", "m_out", "t_in", "t_out"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(map(tuple, want.select(columns).collect()), key=repr)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1


def test_the_larger_side_of_a_hot_key_is_dealt(spark, monkeypatch):
    """The category that sorts later holds the hot key's rows; they are not repeated for every piece."""
    from hearthline.operators import skew, widen

    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 0)
    few = spark.createDataFrame([(1, -1), (2, -2), (None, -3)], "k int, m int")
    many = spark.createDataFrame([(1, i) for i in range(300)] + [(3, 0), (None, 1)], "k int, n int")
    hot = skew.find_hot_keys(many, ["k"])
    left, right = skew.deal_larger_side(few, many, hot)
    assert right.count() == 302 and left.count() == 2 + max(hot.pieces)
    data = [(k, "a", m) for k, m in map(tuple, few.collect())] + [(k, "b", n) for k, n in map(tuple, many.collect())]
    df = spark.createDataFrame(data, "k int, s string, m int")
    got = widen.split_rows_to_columns(df, "s", {"a": "_a", "b": "_b"}, "k", hot).select("k", "m_a", "m_b")
    want = [(1, -1, i) for i in range(300)] + [(2, -2, None), (3, None, 0), (None, -3, 1)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
