"""Exact duplicates by content-defined chunk recipes.

1. Every text, A-Z lower-cased, is cut where a hash of the last 32 bytes says so, wherever that is in
   the text. Its recipe is the list of its chunks' hashes, in order.
2. Texts of different recipes or lengths differ. Only the chunks of texts whose recipe occurs again
   travel, each distinct one once from a task; equal hashes of different bytes come to light there.
3. A chunk's hash, with a number where hashes clash, is its verified identifier. Texts are equal when
   their ordered lists of identifiers are; the lists, not the texts, are grouped.

Which recipes occur again is told to the tasks by a filter of a fixed number of bits. One that is full
only makes more chunks travel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, text_slices, written

#: Bytes that decide about a cut, the leading bits that must be zero there, and the bounds of a chunk.
WINDOW, ZEROS, LEAST, MOST = 32, 10, 64, 16_384
#: Bits of the filter; bytes of texts cut at once; bytes of chunks that a task remembers.
FILTER_BITS, AT_ONCE, KEPT = 1 << 25, 4_000_000, 48_000_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A fixed random number for every byte.
_GEAR = np.random.default_rng(20_031).integers(0, 1 << 32, 256, dtype=np.uint32)


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(_LOWER)


def cuts(texts: list[bytes]) -> list[list[int]]:
    """Ends of the chunks of every text; they depend on its own bytes only."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    rolled = _GEAR[flat]
    for k in (1, 2, 4, 8, 16):
        before, rolled = rolled, rolled.copy()
        rolled[k:] += before[:-k] << np.uint32(k)
    marks = np.flatnonzero(rolled >> np.uint32(32 - ZEROS) == 0) + 1
    ends = np.cumsum([len(t) for t in texts])
    edges = np.searchsorted(marks, [0, *ends.tolist()], side="right").tolist()
    marks = marks.tolist()
    out = []
    for k, end in enumerate(ends.tolist()):
        start = end - len(texts[k])
        last, own = start, []
        # A chunk has more bytes than the window, so no mark that counts saw the text before.
        for mark in [*marks[edges[k] : edges[k + 1]], end]:
            if mark - last < LEAST and mark < end:
                continue
            while mark - last > MOST:
                last += MOST
                own.append(last - start)
            if mark > last:
                own.append(mark - start)
                last = mark
        out.append(own)
    return out


def _recipes(texts: list[bytes], bits: int) -> Iterator[tuple[np.ndarray, int, list[bytes]]]:
    """(hashes of the chunks, digest of the recipe, chunks) of every text."""
    import xxhash

    mask = (1 << bits) - 1
    for text, ends in zip(texts, cuts(texts)):
        chunks = [text[a:b] for a, b in zip([0, *ends], ends)]
        hashes = np.array([xxhash.xxh3_64_intdigest(c) & mask for c in chunks], np.uint64).astype(np.int64)
        yield hashes, xxhash.xxh3_64_intdigest(hashes.tobytes(), len(text)), chunks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _rows(docs: DataFrame, kept: list[str], text: str, bits: int, told=None) -> DataFrame:
    """The kept columns, and each row's number, bytes, digest, recipe and text hash.

    With ``told`` comes ``__chunks``, the chunks of the texts that the filter lets through.
    """
    more = "__row long, n_bytes long, __digest long, __recipe array<long>, text_sha256 string" + ", __chunks array<binary>" * (told is not None)
    schema = T.StructType([docs.schema[c] for c in kept] + list(T._parse_datatype_string(more).fields))

    def run(batches):
        row = TaskContext.get().partitionId() << 36
        for part in text_slices(batches, len(kept), AT_ONCE):
            texts = [normalised(t) for t in part.column(len(kept)).to_pylist()]
            recipes, digests, chunks = zip(*_recipes(texts, bits))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in recipes])]).astype(np.int32))
            columns = [
                pa.array(row + np.arange(len(texts))), pa.array([len(t) for t in texts], pa.int64()), pa.array(map(_signed, digests), pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(recipes))), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
            ]
            if told is not None:
                columns.append(pa.array([c if _passes(told.value, d) else None for c, d in zip(chunks, digests)], pa.list_(pa.binary())))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *columns], names=[f.name for f in schema.fields])
            row += len(texts)

    return docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)


def _passes(words: np.ndarray, digest: int) -> bool:
    slot = digest % (64 * len(words))  # a power of two, so the sign of the digest does not matter
    return bool(int(words[slot // 64]) >> slot % 64 & 1)


def _filter(rows: DataFrame, bits: int) -> np.ndarray:
    """Words of a filter of the digests that more than one row has; at most bits / 64 words come to the driver."""
    again = rows.groupBy("__digest").agg(F.count("*").alias("n")).filter("n > 1")
    slot = f"pmod(__digest, {bits})"
    found = again.groupBy(F.expr(f"{slot} div 64").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, int({slot} % 64))")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[np.asarray(found.column("word"), np.int64)] = np.asarray(found.column("bits"), np.int64).astype(np.uint64)
    return out


def _chunks(docs: DataFrame, text: str, bits: int, told) -> DataFrame:
    """(hash, content): distinct chunks of the texts that the filter lets through."""

    def run(batches):
        held, size = set(), 0
        for part in text_slices(batches, 0, AT_ONCE):
            texts = [normalised(t) for t in part.column(0).to_pylist()]
            fresh = []
            for hashes, digest, chunks in _recipes(texts, bits):
                if _passes(told.value, digest):
                    for h, c in zip(hashes.tolist(), chunks):
                        if c not in held:
                            held.add(c)
                            size += len(c) + 100
                            fresh.append((h, c))
            if fresh:
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in fresh], pa.int64()), pa.array([c for _, c in fresh], pa.binary())], names=["hash", "content"])
            if size > KEPT:
                held, size = set(), 0

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "hash long, content binary").distinct()


def _numbered(rows: DataFrame, chunks: DataFrame, clashing: DataFrame) -> DataFrame:
    """``rows`` with ``__no``, the numbers of the chunks among the different ones of one hash."""
    each = W.partitionBy("hash").orderBy("content")
    variants = chunks.join(clashing, "hash", "left_semi").withColumn("no", F.row_number().over(each))
    parts = rows.select("__row", F.posexplode(F.arrays_zip(F.col("__recipe").alias("hash"), F.col("__chunks").alias("content"))).alias("at", "x"))
    parts = parts.select("__row", "at", "x.*").join(variants, ["hash", "content"], "left")
    numbers = parts.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("no", F.lit(0)).alias("no")))).alias("l"))
    numbers = numbers.select("__row", F.col("l.no").alias("__no"))
    return rows.drop("__chunks", "__no").join(numbers, "__row", "left").withColumn("__no", F.coalesce("__no", F.expr("array()").cast("array<int>")))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", hash_bits: int = 64, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The columns of ``docs`` but for the text, with ``keep_id``, ``group_size``, ``kept``, ``n_bytes``, ``n_chunks``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and empty texts are
    equal. Of equal texts the row with the largest key stays, a null key counting as smaller than any;
    of rows that share that key one stays. ``keep_id`` is its key. An empty table gives an empty
    result; columns of the input that bear one of the new names give way. ``hash_bits`` narrows the
    chunks' hashes: the result is the same, only clashes have to be resolved.
    """
    new = ["keep_id", "group_size", "kept", "n_bytes", "n_chunks", "text_sha256"]
    kept = [c for c in docs.columns if c == key or c not in {text, *new}]
    rows = written(_rows(docs, kept, text, hash_bits), "recipes-rows")
    told = docs.sparkSession.sparkContext.broadcast(_filter(rows, filter_bits))
    chunks = written(_chunks(docs, text, hash_bits, told), "recipes-chunks")
    clashing = written(chunks.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "recipes-clashes")
    rows = rows.withColumn("__no", F.expr("array()").cast("array<int>"))
    if not clashing.isEmpty():
        again = written(_rows(docs, kept, text, hash_bits, told), "recipes-rows")
        rows = written(_numbered(again, chunks, clashing), "recipes-rows")
    same = ["n_bytes", "__recipe", "__no"]
    last = F.max(F.struct(F.col(f"`{key}`").isNotNull().alias("there"), F.col(f"`{key}`").alias("key"), F.col("__row").alias("row")))
    groups = rows.groupBy(*same).agg(F.count("*").alias("size"), last.alias("last")).filter("size > 1")
    groups = written(groups.select(*same, "size", F.col("last.key").alias("__last"), F.col("last.row").alias("__stays")), "recipes-groups")
    # Groups are one row each, so only the rows can be many on a key; Spark splits such partitions.
    out = rows.join(groups, same, "left")
    alone = F.col("size").isNull()
    return out.select(
        *(F.col(f"`{c}`") for c in kept),
        F.when(alone, F.col(f"`{key}`")).otherwise(F.col("__last")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("__row") == F.col("__stays"))).alias("kept"),
        "n_bytes", F.size("__recipe").cast("long").alias("n_chunks"), "text_sha256",
    )


def op11_exact_dedup(spark, sf_dir) -> DataFrame:
    """Exact duplicates among all ``documents``."""
    found = exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents) AS d
WINDOW same AS (PARTITION BY norm)
"""
