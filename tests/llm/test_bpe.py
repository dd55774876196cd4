"""Encoding against the library on whole texts, and the round trip."""

import hashlib

import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from hearthline.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType())]
)
WORDY = "It's the end, isn't it?  Zu und Dieüauß 12345 \n\n\t x'll ÉÀ 漢字かな🙂 "


def texts():
    yield from [None, "", " ", "a", WORDY, "a" * 900, " " * 900, "!" * 333 + " " * 200 + "b" * 500 + WORDY * 9]
    yield from ["漢字" * 400, WORDY * 60, ("word " * 50 + " " * 300) * 6, "'" * 200 + "re" * 99, "\n" * 130 + "x" + WORDY * 20]
    yield from [WORDY * 60, WORDY * 60]


@pytest.mark.parametrize("chunk,overlap", [(64, 40), (200, 64), (100_000, 100)])
def test_ids_equal_those_of_the_whole_text(spark, chunk, overlap):
    rows = [(i, t, "clash") for i, t in enumerate(texts())] + [(None, "no id", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    coded = bpe.decode(bpe.encode(docs, PATH, P.PATTERN, chunk, overlap), PATH)
    checked = bpe.encode(docs, PATH, P.PATTERN, chunk, overlap, check=True)
    assert {r.round_trip for r in checked.collect()} == {True} and checked.columns[-2:] == ["ids", "round_trip"]
    assert coded.columns == ["doc_id", "text", "ids", "decoded"]
    whole = bpe._encoding(PATH, P.PATTERN).encode_ordinary
    got = sorted(((r.doc_id, r.text, r.ids, bytes(r.decoded)) for r in coded.collect()), key=str)
    want = sorted(((i, t, whole(t or ""), (t or "").encode()) for i, t, _ in rows), key=str)
    assert got == want


def test_empty_table_and_bad_overlap(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bpe.encode(docs, PATH, P.PATTERN, 64, 40).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs, PATH, P.PATTERN, 64, 20)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    whole = bpe._encoding(PATH, P.PATTERN).encode_ordinary
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = bpe.op2_byte_bpe(spark, sf).collect()
    assert len(rows) == len(given)
    for r in rows:
        ids = whole(given[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(given[r.doc_id].encode()).hexdigest()


def test_no_vocabulary_stays_behind_a_task(spark):
    def held(batches):
        for _ in batches:
            sizes = [bpe._encoding.cache_info().currsize + bpe._bytes_of.cache_info().currsize]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["n"])

    docs = spark.createDataFrame([(i, WORDY) for i in range(16)], "doc_id long, text string").repartition(8)
    coded = bpe.encode(docs, PATH, P.PATTERN, check=True)
    assert coded.filter("round_trip").count() == 16
    assert {r.n for r in spark.range(64).repartition(64).mapInArrow(held, "n long").collect()} == {0}
