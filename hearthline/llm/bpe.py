"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks that overlap. Each chunk is pre-tokenised on its own, in parallel; a
boundary that two neighbouring chunks both find in their overlap is a place where the later chunk
has resynchronised, so the text can be cut there. The pieces between such cuts are encoded
independently and their ids concatenated. Decoding concatenates the raw bytes of the ids.

A chunk that shares no boundary with its predecessor (one pre-token longer than the overlap, say)
proves nothing about what follows, so the rest of that text stays one piece. Every result equals
that of encoding the whole text at once.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns

#: Code points in a chunk, without its overlap with the next one. A shorter text is one piece.
CHUNK = 32_768
OVERLAP = 1_024
#: No boundary is trusted so close to a chunk's cut-off end: a longer match could begin there.
MARGIN = 16
_ASCII = 1 << 40
IDS = T.ArrayType(T.IntegerType())


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@functools.lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


@functools.lru_cache(maxsize=2)
def _bytes_of(path: str) -> dict[int, bytes]:
    return {i: token for token, i in load_ranks(path).items()}


@functools.lru_cache(maxsize=2)
def _compiled(pattern: str):
    import regex

    return regex.compile(pattern)


def _let_go() -> None:
    """A process between tasks holds no vocabulary; the next task reads it again in a tenth of a second."""
    _encoding.cache_clear()
    _bytes_of.cache_clear()


def _id_lists(texts: list[str | None], path: str, pattern: str, check: bool) -> list[pa.Array]:
    """The texts' ids and, if asked for, whether the bytes of the ids are those of the text."""
    encode = _encoding(path, pattern).encode_ordinary
    each, whole = [], []
    for t in texts:
        ids = encode(t or "")
        each.append(np.array(ids, np.int32))
        if check:
            whole.append(_joined(ids, path) == (t or "").encode())
    offsets = np.zeros(len(each) + 1, np.int32)
    np.cumsum([len(x) for x in each], out=offsets[1:])
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *each])))
    return [ids, pa.array(whole, pa.bool_())] if check else [ids]


def _joined(ids: list[int], path: str) -> bytes:
    return b"".join(map(_bytes_of(path).__getitem__, ids))


def boundaries(chunk: str, is_last: bool, pattern: str) -> list[int]:
    """Ends of the matches in a chunk that a longer text could not change and where it may be cut.

    The pattern looks ahead past white space only, so a cut behind another character alters no match.
    """
    ends = [m.end() for m in _compiled(pattern).finditer(chunk) if not chunk[m.end() - 1].isspace()]
    if is_last:
        return ends
    sure = min(len(chunk) - MARGIN, len(chunk.rstrip()))
    return [e for e in ends if e <= sure]


def _marked(chunk: str, at: int, offset: int) -> int:
    """The boundary's place in the text; between two ASCII characters it ranks higher."""
    return at + offset + _ASCII * (at > 0 and chunk[at - 1 : at + 1].isascii())


def _chunks(long_texts: DataFrame, step: int, overlap: int) -> DataFrame:
    def cut(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = -(-len(text) // step)
                for at in range(0, n, 64):
                    nos = range(at, min(n, at + 64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(nos), pa.string()),
                            pa.array(nos, pa.int32()),
                            pa.array([i == n - 1 for i in nos]),
                            pa.array([text[i * step : (i + 1) * step + overlap] for i in nos], pa.string()),
                        ],
                        names=["key", "no", "last", "chunk"],
                    )

    rows = long_texts.mapInArrow(cut, "key string, no int, last boolean, chunk string")
    return rows.repartition("key", "no")


def _encode_long(long_texts: DataFrame, path: str, pattern: str, step: int, overlap: int, check: bool) -> DataFrame:
    """``key``, ``ids`` and, if asked for, ``round_trip`` of every text of (key, text)."""
    places = T.ArrayType(T.LongType())

    def pretokenise(no, last, chunk):
        heads, tails = [], []
        for i, is_last, text in zip(no.to_pylist(), last.to_pylist(), chunk.to_pylist()):
            ends = boundaries(text, is_last, pattern)
            heads.append([_marked(text, e, i * step) for e in ends if e <= overlap])
            tails.append([_marked(text, e, i * step) for e in ends if e >= step])
        return pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))

    chunks = add_columns(
        _chunks(long_texts, step, overlap),
        ["no", "last", "chunk"],
        [T.StructField("heads", places), T.StructField("tails", places)],
        pretokenise,
    )
    by_key = W.partitionBy("key").orderBy("no")
    # One window over a text's own chunks; a text is bounded by what one row can hold.
    common = F.array_max(F.array_intersect("tails", F.lead("heads").over(by_key))) % F.lit(_ASCII)
    stitched = (
        chunks.withColumn("cut", common)
        .withColumn("broken", F.max(F.col("cut").isNull().cast("int")).over(by_key))
        .withColumn("cut", F.when(F.col("broken") == 0, F.col("cut")))
        .withColumn("start", F.coalesce(F.lag("cut").over(by_key), F.col("no") * F.lit(step)))
        .withColumn("stop", F.coalesce("cut", (F.col("no") + 1) * F.lit(step)))
        .withColumn("piece", F.when(F.col("broken") == 0, F.col("no")).otherwise(-1))
    )
    part = F.expr(f"substring(chunk, int(start - no * {step} + 1), int(stop - start))")
    pieces = (
        stitched.select("key", "piece", "no", part.alias("part"))
        .groupBy("key", "piece")
        .agg(F.min("no").alias("first"), F.array_sort(F.collect_list(F.struct("no", "part"))).alias("parts"))
        .select("key", "first", F.array_join(F.col("parts.part"), "").alias("text"))
    )
    encoded = add_columns(pieces, ["text"], _new(check), lambda t: _id_lists(t.to_pylist(), path, pattern, check), _let_go)
    ids = F.flatten(F.array_sort(F.collect_list(F.struct("first", "ids"))).getField("ids")).alias("ids")
    return encoded.groupBy("key").agg(ids, *([F.bool_and("round_trip").alias("round_trip")] if check else []))


def _new(check: bool) -> list[T.StructField]:
    return [T.StructField("ids", IDS)] + [T.StructField("round_trip", T.BooleanType())] * check


def encode(
    docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, text: str = "text", check: bool = False
) -> DataFrame:
    """Add ``ids`` (array of int), the ids of every whole text; other columns stay.

    With ``check`` the ids are decoded at once, and ``round_trip`` tells whether the text came back.
    Null and empty texts get no ids (an empty array). Repeated rows each get their own result, an
    empty table an empty one, and columns of the input of the new names give way. Texts over
    ``chunk`` code points take the parallel path, each distinct one once.
    """
    if not 2 * MARGIN < overlap <= chunk:
        raise ValueError("the overlap must be longer than twice the margin and no longer than a chunk")
    new = [f.name for f in _new(check)]
    docs = docs.drop(*(c for c in new if c != text))
    is_long = F.coalesce(F.length(text) > chunk, F.lit(False))
    whole = add_columns(docs.filter(~is_long), [text], _new(check), lambda t: _id_lists(t.to_pylist(), path, pattern, check), _let_go)
    key = F.sha2(F.col(text), 256)
    texts = docs.filter(is_long).select(key.alias("key"), F.col(text).alias("text")).dropDuplicates(["key"])
    coded = _encode_long(texts, path, pattern, chunk, overlap, check)
    coded = coded.select(F.col("key").alias("__key"), *(F.col(c).alias(f"__{c}") for c in new))
    long = (
        docs.filter(is_long).withColumn("__key", key).join(coded, "__key", "left")
        .select(*docs.columns, *(F.col(f"__{c}").alias(c) for c in new))
    )
    return whole.unionByName(long)


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (binary), the concatenated bytes of the ids; null ids give null, none give no bytes.

    An id that is not in the vocabulary is an error.
    """

    def join(column):
        rows = (x.as_py() for x in column)
        return [pa.array([None if r is None else _joined(r, path) for r in rows], pa.binary())]

    return add_columns(docs, [ids], [T.StructField(out, T.BinaryType())], join, _let_go)


def op2_byte_bpe(spark, sf_dir) -> DataFrame:
    """Round trip of every whole text of ``documents``; null texts count as empty."""
    import public_tokenizers as P

    from .common import table

    path = P.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode(encode(docs, path, P.PATTERN).drop("text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
