"""Exact duplicates by chunk recipes against grouping the texts themselves."""

import hashlib

import numpy as np
import pytest

from hearthline.llm import recipes


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(lower(text), []).append(key)
    return [(key, max((k for k in groups[lower(t)] if k is not None), default=None), len(groups[lower(t)])) for key, t in rows]


def some_texts():
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdeÉ "), 9))
    long = " ".join(word() for _ in range(3000))
    one = " ".join(word() for _ in range(300))
    return [
        long, long.upper().replace("É", "É"), long + ".", "x" + long, one, one, one[:-1], one + long, "", None, "  ", "A", "a", "É", "é", "a" * 50_000, "A" * 50_000,
        "a" * 49_999, "ab" * 40_000, *[f"short {k % 7}" for k in range(30)], *[one] * 20,
    ]


@pytest.mark.parametrize("hash_bits, filter_bits", [(64, 1 << 20), (64, 64), (3, 1 << 20), (0, 64)])
def test_equals_grouping_texts(spark, hash_bits, filter_bits):
    rows = [(k if k % 11 else None, t) for k, t in enumerate(some_texts())]
    docs = spark.createDataFrame([(*r, k, "c") for k, r in enumerate(rows)], "doc_id long, text string, place long, kept string").repartition(4)
    out = recipes.exact_groups(docs, hash_bits=hash_bits, filter_bits=filter_bits)
    assert out.columns == ["doc_id", "place", "keep_id", "group_size", "kept", "n_bytes", "n_chunks", "text_sha256"]
    found = sorted(out.collect(), key=lambda r: r.place)
    assert [(r.doc_id, r.keep_id, r.group_size) for r in found] == plain(rows)
    by_text = {}
    for r, (_, text) in zip(found, rows):
        assert r.text_sha256 == hashlib.sha256(lower(text).encode()).hexdigest()
        assert r.n_bytes == len(lower(text).encode())
        by_text.setdefault(r.text_sha256, []).append(r)
    for same in by_text.values():
        (stays,) = [r for r in same if r.kept]
        assert stays.doc_id == same[0].keep_id


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(5, "Same"), (5, "same"), (5, "same"), (None, None), (None, "")], "doc_id long, text string")
    found = recipes.exact_groups(docs).collect()
    assert sorted((r.group_size, r.kept) for r in found) == [(2, False), (2, True), (3, False), (3, False), (3, True)]
    assert recipes.exact_groups(docs.limit(0)).collect() == []


def test_cuts_depend_on_the_text_alone():
    rng = np.random.default_rng(2)
    some = [rng.integers(97, 101, n, dtype=np.uint8).tobytes() for n in (0, 1, 63, 64, 5_000, 90_000, 20_000)] + [b"z" * 100_000]
    together, alone = recipes.cuts(some), [recipes.cuts([t])[0] for t in some]
    assert together == alone == [x for t in reversed(some) for x in [recipes.cuts([t, *some])[0]]][::-1]
    for text, ends in zip(some, together):
        sizes = np.diff([0, *ends])
        assert (ends[-1] if ends else 0) == len(text)
        assert (sizes[:-1] >= recipes.LEAST).all() and (sizes <= recipes.MOST).all()
    # An insertion changes the chunks around it only.
    a, b = some[5], some[5][:40_000] + b"inserted" + some[5][40_000:]
    chunks = lambda t: {t[x:y] for x, y in zip([0, *recipes.cuts([t])[0]], recipes.cuts([t])[0])}
    assert len(chunks(a) ^ chunks(b)) <= 6
