"""Token ids in fixed-width bit-packed files.

A file holds the ids of many documents, each id in the least number of bits that the vocabulary
needs. Ids are packed in blocks of a fixed number, whose offsets are listed, so that any range of
ids is found, read and unpacked by numpy without touching the rest.

File: magic, bits, ids a block, documents, ids, place of the index (little-endian); the blocks; the
index: block offsets, then every document's id, whether it has one, and the end of its ids.

Files are written below the shared folder under a name of the attempt's own, and only those that
the finished job lists are read, so a lost or repeated task does no harm.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import slices, table, written
from .pretokens import CachedEncoder

MAGIC, HEAD = b"TOKBITS1", struct.Struct("<8sIIQQQ")
BLOCK = 65_536
SCHEMA = "shard int, file string, n_docs long, n_ids long"


def bits_for(vocabulary: int) -> int:
    """Bits that the ids 0 to vocabulary - 1 need; one at least."""
    return max(1, (vocabulary - 1).bit_length())


def _spans(bits: int):
    """(position in eight ids, byte, shift right of the id to that byte)."""
    return [(j, b, 8 * b - j * bits) for j in range(8) for b in range(j * bits // 8, (j * bits + bits - 1) // 8 + 1)]


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Each id's bits, least significant first, behind the last one's; filled up to eight ids."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    eights = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    eights.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(eights), bits), np.uint8)
    for j, b, shift in _spans(bits):
        x = eights[:, j]
        out[:, b] |= (x >> np.uint64(shift) if shift >= 0 else x << np.uint64(-shift)).astype(np.uint8)
    return out.tobytes()


def unpack(packed: bytes, n: int, bits: int) -> np.ndarray:
    rows = np.frombuffer(packed, np.uint8).reshape(-1, bits)
    out = np.zeros((len(rows), 8), np.uint64)
    for j, b, shift in _spans(bits):
        x = rows[:, b].astype(np.uint64)
        out[:, j] |= x << np.uint64(shift) if shift >= 0 else x >> np.uint64(-shift)
    return (out.reshape(-1)[:n] & np.uint64((1 << bits) - 1)).astype(np.uint32)


class Writer:
    """Write a file front to back; at most a block of ids is held."""

    def __init__(self, file, bits: int, block: int = BLOCK):
        if block % 8 or not 1 <= bits <= 32:
            raise ValueError("a block is a multiple of eight ids, of 1 to 32 bits")
        self.file, self.bits, self.block = file, bits, block
        self.offsets, self.names, self.ends, self.n = [], [], [], 0
        self.held = np.zeros(0, np.uint32)
        self.at = HEAD.size
        # The head comes again behind the index: object stores cannot go back to fill it in.
        file.write(HEAD.pack(MAGIC, bits, block, 0, 0, 0))

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.n += len(ids)
        self.names.append(name)
        self.ends.append(self.n)
        self.held = np.concatenate([self.held, ids])
        full = len(self.held) // self.block * self.block
        for at in range(0, full, self.block):
            self._put(self.held[at : at + self.block])
        self.held = self.held[full:]

    def _put(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.file.write(data)
        self.at += len(data)

    def finish(self) -> None:
        if len(self.held):
            self._put(self.held)
        names = np.array([x or 0 for x in self.names], np.int64)
        known = np.array([x is not None for x in self.names], np.uint8)
        for part in (np.array(self.offsets, np.uint64), names, known, np.array(self.ends, np.uint64)):
            self.file.write(part.tobytes())
        self.file.write(HEAD.pack(MAGIC, self.bits, self.block, len(names), self.n, self.at))


class Reader:
    """Random access to a file: ``ids(a, b)`` reads only the blocks that hold the range."""

    def __init__(self, file, size: int):
        self.file = file
        file.seek(size - HEAD.size)
        magic, self.bits, self.block, self.n_docs, self.n, at = HEAD.unpack(file.read(HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        blocks = -(-self.n // self.block)
        file.seek(at)
        index = file.read(size - HEAD.size - at)
        take = lambda kind, n, o: np.frombuffer(index, kind, n, o)
        self.offsets = take(np.uint64, blocks, 0)
        self.names = take(np.int64, self.n_docs, 8 * blocks)
        self.known = take(np.uint8, self.n_docs, 8 * (blocks + self.n_docs)).astype(bool)
        self.ends = np.frombuffer(index[8 * blocks + 9 * self.n_docs :], np.uint64).astype(np.int64)

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.zeros(0, np.uint32)
        first, last = a // self.block, (b - 1) // self.block
        parts = []
        for k in range(first, last + 1):
            n = min(self.block, self.n - k * self.block)
            self.file.seek(int(self.offsets[k]))
            parts.append(unpack(self.file.read(-(-n // 8) * self.bits), n, self.bits))
        return np.concatenate(parts)[a - first * self.block : b - first * self.block]


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> CachedEncoder:
    return CachedEncoder(path, encode_special_tokens=False)


def write_files(docs: DataFrame, tokenizer: str, bits: int, end_id: int | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and write the ids in ascending order of the key; returns the list of files.

    (shard, file, n_docs, n_ids), shards in order of their keys. Null keys come first; equal keys are
    ordered by their texts' hashes. Literals of added tokens get those tokens' ids, as the library does by
    default. Null and empty texts have no ids but ``end_id`` (none if null).
    An empty table gives no files.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("key"), F.col("th")]
    given = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    ranged = given.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "text")
    end = np.zeros(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)

    def write(batches):
        writer = store = None
        for batch in batches:
            for part in slices(batch):
                if writer is None:
                    place, at = pyarrow.fs.FileSystem.from_uri(folder)
                    place.create_dir(at, recursive=True)
                    shard = TaskContext.get().partitionId()
                    name = f"part-{shard:06d}-{uuid.uuid4().hex}.tokbits"
                    store = place.open_output_stream(f"{at}/{name}")
                    writer = Writer(store, bits)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for name_, ids in zip(part.column(0).to_pylist(), _encoder(tokenizer).encode(texts)):
                    writer.add(name_, np.concatenate([ids, end]))
        if writer is not None:
            writer.finish()
            store.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([len(writer.names)]), pa.array([writer.n])],
                names=["shard", "file", "n_docs", "n_ids"],
            )

    return written(ranged.mapInArrow(write, SCHEMA), "token-file-list")


def read_files(files: DataFrame, ids_per_read: int = 1 << 20) -> DataFrame:
    """(key, start, n_tokens, ids): every document of the files with the ids before it and its own, read back."""
    return _read(files, "key long, start long, n_tokens long, ids array<long>", lambda ids: ids.astype(np.int64), ids_per_read)


def read_checksums(files: DataFrame, ids_per_read: int = 1 << 20) -> DataFrame:
    """(key, start, n_tokens, crc32): like ``read_files``, with the ids' checksum in their place."""
    return _read(files, "key long, start long, n_tokens long, crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), ids_per_read)


def _read(files: DataFrame, schema: str, digest, ids_per_read: int) -> DataFrame:
    spark = files.sparkSession
    listed = sorted(files.collect(), key=lambda r: r.shard)  # a row for each file
    starts = np.concatenate([[0], np.cumsum([r.n_ids for r in listed])]).astype(int).tolist()
    rows = [(r.file, s) for r, s in zip(listed, starts)]
    names = [x.split()[0] for x in schema.split(", ")]
    last = pa.int64() if not schema.endswith(">") else pa.list_(pa.int64())

    def read(batches):
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place, at = pyarrow.fs.FileSystem.from_uri(file)
                with place.open_input_file(at) as source:
                    reader = Reader(source, source.size())
                    ends = reader.ends
                    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                    a = 0
                    while a < reader.n_docs:
                        b = max(a + 1, int(np.searchsorted(ends, begins[a] + ids_per_read, "right")))
                        ids = reader.ids(int(begins[a]), int(ends[b - 1]))
                        each = [digest(ids[begins[i] - begins[a] : ends[i] - begins[a]]) for i in range(a, b)]
                        keys = pa.array(reader.names[a:b], mask=~reader.known[a:b])
                        yield pa.RecordBatch.from_arrays(
                            [keys, pa.array(begins[a:b] + start), pa.array(ends[a:b] - begins[a:b]), pa.array(each, last)], names=names
                        )
                        a = b

    given = spark.createDataFrame(rows, "file string, start long")
    return given.repartition(max(1, len(rows))).mapInArrow(read, schema)


def op9_token_files(spark, sf_dir) -> DataFrame:
    """Encode all ``documents``, write them as packed files and read the files back."""
    import public_tokenizers as P

    path, vocabulary = P.path("byte_bpe_50k.json"), 50_257
    files = write_files(table(spark, sf_dir, "documents").select("doc_id", "text"), path, bits_for(vocabulary), 2)
    return read_checksums(files).withColumnsRenamed({"key": "doc_id", "crc32": "ids_crc32"})
