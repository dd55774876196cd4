"""Packing, random access, and the files against the library."""

import io
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from hearthline.llm import tokenfile as TF
from hearthline.llm.pretokens import CachedEncoder

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_packing(bits):
    for n in (0, 1, 7, 8, 1_003):
        ids = np.random.default_rng(n).integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        packed = TF.pack(ids, bits)
        assert len(packed) == -(-n // 8) * bits and np.array_equal(TF.unpack(packed, n, bits), ids)
    if bits < 32:
        with pytest.raises(ValueError):
            TF.pack(np.array([1 << bits], np.uint32), bits)


def test_bits_for():
    assert [TF.bits_for(v) for v in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_random_access():
    rng = np.random.default_rng(1)
    docs = [(i if i % 3 else None, rng.integers(0, 1 << 17, rng.integers(0, 90), dtype=np.uint32)) for i in range(60)]
    file = io.BytesIO()
    writer = TF.Writer(file, 17, block=64)
    for name, ids in docs:
        writer.add(name, ids)
    writer.finish()
    reader = TF.Reader(file, len(file.getvalue()))
    whole = np.concatenate([ids for _, ids in docs])
    assert reader.n == len(whole) and [k if z else None for k, z in zip(reader.names.tolist(), reader.known)] == [n for n, _ in docs]
    for a, b in [(0, len(whole)), (0, 0), (63, 65), (64, 128), (len(whole) - 1, len(whole))] + [tuple(sorted(rng.integers(0, len(whole), 2))) for _ in range(50)]:
        assert np.array_equal(reader.ids(int(a), int(b)), whole[a:b])
    assert np.diff(np.concatenate([[0], reader.ends])).tolist() == [len(ids) for _, ids in docs]


def test_cached_encoder_equals_the_library(library):
    rng = random.Random(1)
    letters = [*"ab's'trevll  \n\t!1é漢² ́🙂<|> \x1c", "'s", "'re", "  ", "\n\n", "<|endoftext|>"]
    encoder = CachedEncoder(PATH, kept=50)  # forgets again and again
    for _ in range(150):
        texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(20)]
        assert [x.tolist() for x in encoder.encode(texts)] == library(texts)


def test_files(spark, library):
    rows = [(i * 7 % 101, f"doc {i} it's\n\n word" * (i % 5), "clash") for i in range(101)]
    rows += [(None, "no id", "x"), (3, None, "x"), (4, "", "x"), (5, rows[0][1], "x"), (5, rows[0][1], "x"), (1_000, "very long " * 60_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    files = TF.write_files(docs, PATH, 16, 2)
    got = sorted(TF.read_files(files, ids_per_read=500).collect(), key=lambda r: r.start)
    assert [r.key for r in got] == sorted((k for k, *_ in rows), key=lambda k: (k is not None, k or 0))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        at += r.n_tokens
    want = sorted(((k, ids + [2]) for (k, *_), ids in zip(rows, library([t or "" for _, t, _ in rows]))), key=repr)
    assert sorted(((r.key, r.ids) for r in got), key=repr) == want
    sums = {(r.key, r.start): r.crc32 for r in TF.read_checksums(files).collect()}
    assert all(sums[r.key, r.start] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    assert TF.read_files(TF.write_files(docs.limit(0), PATH, 16, 2)).count() == 0


def test_added_tokens_as_the_library_at_its_default(spark):
    default = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    letters = [*"ab's <|> \n", "<|endoftext|>", "<|endoftext", " it's"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", *("".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(200))]
    want = [x.ids for x in default.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 220, 50256, 275]
    assert [x.tolist() for x in CachedEncoder(PATH, encode_special_tokens=False).encode(texts)] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.key: r for r in TF.read_files(TF.write_files(docs, PATH, 16, 2)).collect()}
    assert [got[i].ids for i in range(len(texts))] == [x + [2] for x in want]


def test_words_that_polynomial_hashes_mix_up(library, monkeypatch):
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    texts = [word, other, f"{other} {word}"]
    assert [x.tolist() for x in CachedEncoder(PATH).encode(texts)] == library(texts)
    # Every pre-token of one hash: still told apart, in a batch and in the memory.
    monkeypatch.setattr(CachedEncoder, "_hashes", lambda self, codes, start, stop: np.zeros(len(start), np.uint64))
    encoder = CachedEncoder(PATH)
    for some in (["same same same"], ["one two", "", "one"], [" same"], ["x"]):
        assert [x.tolist() for x in encoder.encode(some)] == library(some)
