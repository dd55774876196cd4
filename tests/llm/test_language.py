"""Codes, decoding and held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.llm import language as L


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 9, 40])
def test_codewords_differ_in_many_bits(n):
    codes = L.codebook(n)
    assert codes.shape[0] == n and set(np.unique(codes)) <= {-1, 1}
    if n > 1:
        apart = (codes[:, None, :] != codes[None, :, :]).sum(axis=2)
        assert apart[~np.eye(n, dtype=bool)].min() >= max(1, codes.shape[1] // 4)
        assert (np.abs(codes.sum(axis=0)) < n).all()


def test_a_row_does_not_depend_on_its_neighbours():
    rows = [b"ab", b"abc def", b"xyz"]
    together = L.features(rows, 256)
    assert all(np.array_equal(L.features([r], 256)[0], x) for r, x in zip(rows, together))
    assert np.allclose((together**2).sum(axis=1), 1)


def test_decoding_corrects_wrong_bits():
    codes = L.codebook(5)
    model = L.LanguageModel(tuple("abcde"), codes, np.eye(codes.shape[1]), np.zeros(codes.shape[1]), np.full(codes.shape, 1 / codes.shape[1]))
    sent = 3.0 * codes.astype(float)
    for flipped in range(3):
        wrong = sent.copy()
        wrong[:, flipped] *= -1
        best, share, lead = L.decode(model, wrong)
        assert best.tolist() == [0, 1, 2, 3, 4] and (share <= 1).all() and (lead > 0).all()


def test_edge_rows(spark):
    rows = [(i, f"the cat and the dog {i}", "en") for i in range(30)] + [(i, f"der hund und die katze {i}", "de") for i in range(30, 60)]
    rows += [(None, "the dog", None), (61, None, "en"), (62, "", "de"), (63, "12 !!", "en"), (64, "the cat " * 20_000, None), (1, rows[1][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = L.fit(docs)
    got = {r.doc_id: r for r in L.predict(docs, model).collect()}
    assert L.predict(docs, model).count() == len(rows)
    assert all(got[i].lang_pred == "und" and got[i].score == 0.0 and not got[i].ambiguous for i in (61, 62, 63))
    assert got[64].lang_pred == got[None].lang_pred == "en" and got[40].lang_pred == "de"
    assert L.predict(docs.limit(0), model).count() == 0
    none = L.fit(docs.filter("false"))
    assert {r.lang_pred for r in L.predict(docs, none).collect()} == {"und"}
    one = L.fit(docs.filter("lang = 'en'"))
    assert {r.lang_pred for r in L.predict(docs, one).collect()} == {"und", "en"}


def test_the_sample_reaches_the_driver_packed(spark, monkeypatch):
    rows = [(i, f"{'der hund' if i % 2 else 'the cat'} {i} {'und ' * (i % 7)}", "de" if i % 2 else "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sent, collect = [], type(docs).collect

    def spy(df):
        found = collect(df)
        sent.extend(bytes(r.features) for r in found if "features" in df.columns)
        return found

    monkeypatch.setattr(type(docs), "collect", spy)
    model = L.fit(docs, dims=4_096)
    assert len(sent) == 60 and max(map(len, sent)) < 2_048  # 8,192 if every cell came
    plain = sorted((k, L.features([L.folded_bytes(t)], 4_096).astype(np.float16).tobytes()) for _, t, k in rows)
    x = np.frombuffer(b"".join(f for _, f in plain), np.float16).reshape(-1, 4_096).astype(np.float32)
    y = model.codes[[model.languages.index(k) for k, _ in plain]].astype(np.float32)
    w, b = L._logistic(x, y, 1e-4, 300)
    assert np.array_equal(model.weights, w) and np.array_equal(model.bias, b)


@pytest.mark.parametrize("dims", [4, 64, 4_096])
def test_packed_rows_come_back(dims):
    x = np.where(np.random.default_rng(1).random((50, dims)) < 0.2, np.random.default_rng(2).random((50, dims)), 0).astype(np.float16)
    assert np.array_equal(L.unpacked([L.packed(r) for r in x], dims, np.float32), x.astype(np.float32))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = L.op1_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert len(rows) > 250 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_samples_of_nothing_and_repeated_keys(spark):
    schema = "doc_id long, text string, lang string"
    silent = spark.createDataFrame([(i, t, "en") for i, t in enumerate(["", None, "123 !", " "])], schema)
    assert L.fit(silent).languages == ()
    # All rows of a key are drawn or none, so a key may leave the sample empty.
    for key in range(6):
        one = spark.createDataFrame([(key, f"some words {i}", "en") for i in range(50)], schema)
        model = L.fit(one, sample=1)
        assert model.languages in ((), ("en",))
        assert L.predict(one, model).count() == 50
    many = spark.createDataFrame([(i, f"word{i} text", f"l{i % 30:02}") for i in range(300)] + [(400, "more", "l07")], schema)
    assert L.fit(many, sample=100, most_languages=3).languages == ("l00", "l01", "l07")
