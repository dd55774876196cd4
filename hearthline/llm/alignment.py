"""Alignment of the tokens of two tokenizers, with corpus-wide counts of linked ids.

Tokens of A (byte-level BPE on a space and the text) and of B (a sentence-piece model on the text,
which adds the space itself) are cut into groups at the byte offsets where tokens of both end. Every
token of A in a group is linked with every token of B in it.

1. Texts are encoded once; the ids are kept in the shared folder, so that the later passes need not
   encode again. No token of B crosses a place where a space follows another character, or a line
   feed, so B encodes each distinct segment between such places once in a task.
2. The distinct linked pairs of the corpus get a minimal perfect hash, built in buckets.
3. Every task counts the documents of each pair in a dense vector indexed by that hash; the vectors
   are summed in a tree. Keys are verified in every look-up.
4. The documents are aligned again and look up the counts.

The hash, the keys and the counts are broadcast only up to ``most_pairs`` distinct pairs; beyond it
the counts are grouped and joined.
"""

from __future__ import annotations

import functools
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, text_slices, written
from .mphf import PerfectHash, build
from .pretokens import CachedEncoder, byte_letters

#: Distinct pairs that are held by every task, with about 25 bytes each.
MOST_PAIRS = 4_000_000
#: Distinct segments that a task remembers, characters encoded at once, bytes of ids aligned at once, links listed at once.
KEPT, AT_ONCE, ALIGNED, LINKS = 400_000, 2_000_000, 1_000_000, 2_000_000
#: Counts in a block of a vector, and vectors summed by one task of the tree.
BLOCK, FAN = 1 << 16, 16
SEGMENT = re.compile(r" +[^ \n]*|\n[^ \n]*")
#: Bits of an id of B, and of a pair of ids.
BITS, PAIR_BITS = 18, 36
MARK = "\u2581"


def _gathered(where: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of the ranges [where, where + size) in a row."""
    total = np.cumsum(size)
    return np.repeat(where - (total - size), size) + np.arange(total[-1] if len(total) else 0)


def _counted_runs(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each is there; ``times`` are weights of sorted keys."""
    if times is None:
        keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if times is None:
        return keys[first], np.diff(np.concatenate([first, [len(keys)]]))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def segments(text: str) -> list[str]:
    """The segments of a space and the text, each without its first space; a line feed stays."""
    own = " " + text
    if "  " in own:
        return [x[1:] if x[0] == " " else x for x in SEGMENT.findall(own)]
    return own.replace("\n", " \n").split(" ")[1:]


class PieceEncoder:
    """B: ids of texts by segments, each distinct one encoded once."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes, pieces = piece_bytes(path)
        if any("\n" in p or re.search(rf"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece of B crosses the end of a segment")
        if self.model.encode(" x\n", out_type=str)[0] not in (MARK, MARK * 2) or self.model.encode("\n", out_type=str)[0] != MARK:
            raise ValueError("B must add a space before the text")
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.where, self.size, self.same = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.flat = np.zeros(0, np.int32)

    def _learn(self, new: list[str]) -> None:
        sizes, flat, same = [], [], []
        for at in range(0, len(new), 5_000):
            some = new[at : at + 5_000]
            # B's own space and a line feed, which stands alone, come first and go again.
            some = [x if x[:1] == "\n" else " " + x for x in some]
            for segment, ids in zip(some, self.model.encode(["\n" + x for x in some], num_threads=1)):
                ids = ids[2:]
                sizes.append(len(ids))
                flat += ids
                same.append(b"".join(map(self.bytes.__getitem__, ids)) == segment.encode())
        size = np.array(sizes, np.int64)
        self.where = np.concatenate([self.where, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.same = np.concatenate([self.same, np.array(same, bool)])
        self.flat = np.concatenate([self.flat, np.array(flat, np.int32)])
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of a space and every text, and whether their bytes are those of a space and the text."""
        if len(self.rows) > KEPT:
            self._forget()
        parts = [segments(t) for t in texts]
        flat = list(chain.from_iterable(parts))
        rows = list(map(self.rows.get, flat))
        if None in rows:
            self._learn(list(dict.fromkeys(s for s, r in zip(flat, rows) if r is None)))
            rows = list(map(self.rows.__getitem__, flat))
        row = np.array(rows, np.int64)
        n = np.array([len(p) for p in parts], np.int64)
        ids = self.flat[_gathered(self.where[row], self.size[row])]
        of = np.repeat(np.arange(len(texts)), n)
        whole = np.bincount(of[~self.same[row]], minlength=len(texts)) == 0
        return np.split(ids, np.cumsum(np.bincount(of, self.size[row], len(texts)).astype(np.int64))[:-1]), whole


@functools.lru_cache(maxsize=2)
def piece_bytes(path: str) -> tuple[list[bytes], list[str]]:
    """Bytes and names of the pieces of B by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)], pieces


@functools.lru_cache(maxsize=2)
def letter_bytes(path: str) -> list[bytes]:
    """Bytes of the entries of A by id."""
    from tokenizers import Tokenizer

    raw = {letter: byte for byte, letter in byte_letters().items()}
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
    if set(raw) - set(vocabulary):
        raise ValueError("A lacks some bytes")
    out = [b""] * (max(vocabulary.values()) + 1)
    for word, i in vocabulary.items():
        if all(c in raw for c in word):
            out[i] = bytes(raw[c] for c in word)
    return out


@functools.lru_cache(maxsize=1)
def _encoders(path_a: str, path_b: str) -> tuple[CachedEncoder, PieceEncoder]:
    return CachedEncoder(path_a, kept=KEPT, encode_special_tokens=True), PieceEncoder(path_b)


@functools.lru_cache(maxsize=1)
def _lengths(path_a: str, path_b: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every id of A and B."""
    sizes = [np.array([len(x) for x in words], np.int64) for words in (letter_bytes(path_a), piece_bytes(path_b)[0])]
    if max(map(len, sizes)) > 1 << BITS:
        raise ValueError("a vocabulary is too large for pairs of ids in one number")
    return sizes[0], sizes[1]


def _encoded(docs: DataFrame, text: str, kept: list[str], path_a: str, path_b: str) -> DataFrame:
    """The kept columns, and the ids of A and of B as packed numbers; none for texts without tokens."""
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("__a", T.BinaryType()), T.StructField("__b", T.BinaryType())])
    kind = "<u2" if max(map(len, _lengths(path_a, path_b))) <= 1 << 16 else "<u4"

    def run(batches):
        a, b = _encoders(path_a, path_b)
        for part in text_slices(batches, len(kept), AT_ONCE):
            texts = [t or "" for t in part.column(len(kept)).to_pylist()]
            other, whole = b.encode(texts)
            own = a.encode([" " + t if ok and t else "" for t, ok in zip(texts, whole)])
            good = [bool(t) and ok for t, ok in zip(texts, whole)]
            blobs = [pa.array([x.astype(kind).tobytes() if ok else b"" for x, ok in zip(ids, good)], pa.binary()) for ids in (own, other)]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *blobs], names=[f.name for f in schema.fields])

    given = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias("__text"))
    return written(given.mapInArrow(run, schema), "alignment-ids", compression="zstd")


class _Aligned:
    """The groups of some texts, from their packed ids."""

    def __init__(self, a: pa.Array, b: pa.Array, path_a: str, path_b: str):
        sizes = _lengths(path_a, path_b)
        kind = "<u2" if max(map(len, sizes)) <= 1 << 16 else "<u4"
        self.n = len(a)
        self.ids = max(map(len, sizes))
        ids, doc, ends = [], [], []
        for column, size in zip((a, b), sizes):
            blobs = column.to_pylist()
            own = np.frombuffer(b"".join(blobs), kind).astype(np.int64)
            ids.append(own)
            doc.append(np.repeat(np.arange(self.n), [len(x) // np.dtype(kind).itemsize for x in blobs]))
            ends.append(np.cumsum(size[own]))
        self.a, self.b = ids
        self.doc_a, self.doc_b = doc
        total = int(ends[0][-1]) if len(ends[0]) else 0
        if total != (int(ends[1][-1]) if len(ends[1]) else 0):
            raise RuntimeError("the tokens of A and B cover different bytes")
        mark = np.zeros(total + 1, np.uint8)
        mark[ends[0]] = 1
        last_b = mark[ends[1]] == 1
        mark[ends[1][last_b]] = 2
        # Both tokenizers end at the end of a text, so groups never span texts.
        self.last = [mark[ends[0]] == 2, last_b]
        self.group = [np.cumsum(x) - x for x in self.last]
        self.doc_of_group = doc[0][self.last[0]]
        self.in_group = [np.bincount(g, minlength=len(self.doc_of_group)) for g in self.group]

    def facts(self) -> list[np.ndarray]:
        """Numbers of tokens of A and of B, of groups and of links, by text."""
        links = self.in_group[0] * self.in_group[1]
        total = np.concatenate([[0], np.cumsum(links)])
        edges = np.searchsorted(self.doc_of_group, np.arange(self.n + 1))
        count = lambda x: np.bincount(x, minlength=self.n)
        return [count(self.doc_a), count(self.doc_b), count(self.doc_of_group), total[edges[1:]] - total[edges[:-1]]]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct numbers of text and pair of ids, and how many links each stands for."""
        size = self.in_group[1][self.group[0]]
        first = (np.cumsum(self.in_group[1]) - self.in_group[1])[self.group[0]]
        done = np.concatenate([[0], np.cumsum(size)])
        keys, times, at = [], [], 0
        while at < len(size):
            stop = max(at + 1, int(np.searchsorted(done, done[at] + LINKS, side="right")) - 1)
            own = (self.doc_a[at:stop] << PAIR_BITS) | (self.a[at:stop] << BITS)
            key, n = _counted_runs(np.repeat(own, size[at:stop]) | self.b[_gathered(first[at:stop], size[at:stop])])
            keys.append(key)
            times.append(n)
            at = stop
        if len(keys) < 2:
            return (keys[0], times[0]) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        key, n = np.concatenate(keys), np.concatenate(times)
        order = np.argsort(key, kind="stable")
        return _counted_runs(key[order], n[order])

    def written(self) -> list[str]:
        """The groups of every text as a string."""
        marked = _marked(self.ids)
        size = self.ids
        names = np.zeros(len(self.a) + len(self.b), np.int64)
        before = [np.cumsum(x) for x in self.in_group]
        # Before a token of A stand the groups before its own; before one of B also A's tokens of its group. A comma
        # follows a token; a bar the last one of A in a group, a semicolon the last one of B.
        names[np.arange(len(self.a)) + (before[1] - self.in_group[1])[self.group[0]]] = self.a + size * self.last[0]
        names[np.arange(len(self.b)) + before[0][self.group[1]]] = self.b + 2 * size * self.last[1]
        names = list(map(marked.__getitem__, names.tolist()))
        edges = np.cumsum(np.bincount(np.concatenate([self.doc_a, self.doc_b]), minlength=self.n))
        return ["".join(names[a:b])[:-1] for a, b in zip([0, *edges.tolist()], edges.tolist())]


@functools.lru_cache(maxsize=1)
def _marked(ids: int) -> list[str]:
    """Decimal ids below ``ids``, followed by each of the three marks."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(ids)]


def _runs(path_a: str, path_b: str, batches, column: int):
    """(part of a batch, its aligned texts); the ids of A are in ``column``, those of B in the next one.

    A worker that encoded before still holds both encoders and what they remember, which no later pass needs.
    """
    _encoders.cache_clear()
    for part in text_slices(batches, column, ALIGNED):
        yield part, _Aligned(part.column(column), part.column(column + 1), path_a, path_b)


def _codes(keys: np.ndarray) -> np.ndarray:
    return keys & ((1 << PAIR_BITS) - 1)


def _distinct_pairs(ids: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(code): the distinct linked pairs of all texts."""

    def run(batches):
        held, more = np.zeros(0, np.int64), []
        for _, texts in _runs(path_a, path_b, batches, 0):
            more.append(_counted_runs(_codes(texts.pairs()[0]))[0])
            if sum(map(len, more)) > LINKS:
                held, more = _counted_runs(np.concatenate([held, *more]))[0], []
                if len(held) > LINKS:
                    yield pa.RecordBatch.from_arrays([pa.array(held)], names=["code"])
                    held = np.zeros(0, np.int64)
        held = _counted_runs(np.concatenate([held, *more]))[0]
        yield pa.RecordBatch.from_arrays([pa.array(held)], names=["code"])

    return ids.mapInArrow(run, "code long").distinct()


def _slots(index: PerfectHash, codes: np.ndarray) -> np.ndarray:
    """Verified indexes of codes; each distinct one is looked up once."""
    distinct = _counted_runs(codes)[0]
    slots = index.find(distinct)
    if (slots < 0).any():
        raise RuntimeError("a linked pair is not among the corpus's pairs")
    return slots[np.searchsorted(distinct, codes)]


def _counted(ids: DataFrame, path_a: str, path_b: str, shared, pairs: int) -> np.ndarray:
    """Documents of every pair, by the pair's index: dense vectors of the tasks, summed in a tree."""

    def count(batches):
        index: PerfectHash = shared.value
        counts = np.zeros(pairs, np.int64)
        for _, texts in _runs(path_a, path_b, batches, 0):
            codes, n = _counted_runs(_codes(texts.pairs()[0]))
            counts[_slots(index, codes)] += n
        lot = TaskContext.get().partitionId()
        for k in range(0, pairs, BLOCK):
            if counts[k : k + BLOCK].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k // BLOCK], pa.int32()), pa.array([lot], pa.int32()), pa.array([counts[k : k + BLOCK].tobytes()], pa.binary())],
                    names=["block", "lot", "counts"],
                )

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in group.column("counts"))
        return pa.table({"block": group.column("block")[:1], "lot": group.column("lot")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    kind = "block int, lot int, counts binary"
    sums = written(ids.mapInArrow(count, kind), "alignment-counts")
    while (sums.agg(F.max("lot")).first()[0] or 0) > 0:
        fewer = sums.withColumn("lot", F.expr(f"int(lot div {FAN})"))
        sums = written(fewer.groupBy("block", "lot").applyInArrow(add, kind), "alignment-counts")
    out = np.zeros(pairs, np.int64)
    for block, blob in sums.select("block", "counts").toLocalIterator():
        own = np.frombuffer(blob, np.int64)
        out[block * BLOCK : block * BLOCK + len(own)] = own
    return out


FACTS = [("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long")]
COUNTS = [("n_best", "long"), ("count_sum", "long")]


def _fields(docs: DataFrame, text: str) -> tuple[T.StructType, list[str]]:
    """Columns of the result, and those of them that come from ``docs``."""
    new = [*FACTS, ("groups", "string"), *COUNTS]
    kept = [c for c in docs.columns if c not in {text, *(n for n, _ in new)}]
    extra = T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in new))
    return T.StructType([docs.schema[c] for c in kept] + list(extra.fields)), kept


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", most_pairs: int = MOST_PAIRS) -> DataFrame:
    """The columns of ``docs`` but for the text, with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``n_best``, ``count_sum``.

    ``groups`` lists the ids, A's and B's of a group parted by ``|``, groups by ``;``, ids by commas.
    The count of an id pair is the number of rows that hold it linked; ``count_sum`` adds it up over a
    row's links, ``n_best`` counts the links whose count is the highest of their A id in all rows, ties
    included. Null and empty texts, and texts whose tokens do not give back the bytes of a space and
    the text, have no tokens: zeros and an empty string. Repeated rows count each. An empty table gives
    an empty result; columns of the input that bear one of the new names give way.
    """
    schema, kept = _fields(docs, text)
    stored = _encoded(docs, text, kept, path_a, path_b)
    ids = stored.select("__a", "__b")
    pairs = written(_distinct_pairs(ids, path_a, path_b), "alignment-pairs")
    n = pairs.count()
    if n > most_pairs:
        return _joined(stored, schema, kept, path_a, path_b)
    sc = docs.sparkSession.sparkContext
    index = build(pairs, n)
    shared = sc.broadcast(index)
    counts = _counted(ids, path_a, path_b, shared, n) if n else np.zeros(0, np.int64)
    best = np.zeros(1 << BITS, np.int64)
    np.maximum.at(best, index.keys >> BITS, counts)
    held = sc.broadcast((counts, counts == best[index.keys >> BITS]))

    def run(batches):
        index, (counts, top) = shared.value, held.value
        for part, texts in _runs(path_a, path_b, batches, len(kept)):
            keys, times = texts.pairs()
            slots = _slots(index, _codes(keys)) if n else keys
            edges = np.searchsorted(keys >> PAIR_BITS, np.arange(texts.n + 1))
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in ((times * top[slots], times * counts[slots]) if n else (keys, keys))]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[: len(kept)], *map(pa.array, texts.facts()), pa.array(texts.written(), pa.string()),
                 *(pa.array(x[edges[1:]] - x[edges[:-1]]) for x in sums)],
                names=[f.name for f in schema.fields],
            )

    return stored.mapInArrow(run, schema)


def _joined(stored: DataFrame, schema: T.StructType, kept: list[str], path_a: str, path_b: str) -> DataFrame:
    """``align`` for any number of distinct pairs: a row for every pair of a text, grouped and joined."""
    marked = T.StructType([*schema.fields[: len(kept) + 5], *T._parse_datatype_string("__row long, __codes array<long>, __times array<long>").fields])

    def run(batches):
        row = TaskContext.get().partitionId() << 36
        for part, texts in _runs(path_a, path_b, batches, len(kept)):
            keys, times = texts.pairs()
            offsets = pa.array(np.searchsorted(keys >> PAIR_BITS, np.arange(texts.n + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (_codes(keys), times)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[: len(kept)], *map(pa.array, texts.facts()), pa.array(texts.written(), pa.string()), pa.array(row + np.arange(texts.n)), *lists],
                names=[f.name for f in marked.fields],
            )
            row += texts.n

    rows = written(stored.mapInArrow(run, marked), "alignment-rows")
    links = rows.select("__row", F.explode(F.arrays_zip(F.col("__codes").alias("code"), F.col("__times").alias("times"))).alias("x")).select("__row", "x.*")
    a = F.shiftright("code", BITS).alias("a")
    counts = written(links.groupBy("code").agg(F.count("*").alias("count")), "alignment-counts").select("code", "count", a)
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    counts = counts.join(best, "a").select("code", "count", (F.col("count") == F.col("best")).alias("top"))
    sums = links.join(counts, "code").groupBy("__row").agg(
        F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    )
    out = rows.drop("__codes", "__times").join(sums, "__row", "left").drop("__row")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c, _ in COUNTS}).select(*(f.name for f in schema.fields))


def op13_token_alignment(spark, sf_dir) -> DataFrame:
    """The two tokenizers aligned on every whole text of ``documents``."""
    import public_tokenizers as P

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = align(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return told.select("doc_id", *(c for c, _ in FACTS), *(c for c, _ in COUNTS), digest)
