"""Alignment of two tokenizers against a plain definition on whole texts; the perfect hash."""

import hashlib
import json

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthline.llm import alignment, mphf
from hearthline.llm.pretokens import byte_letters
from hearthline.llm.queries import QUERIES

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(texts, library):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every text, from whole texts."""
    a, b = library
    raw = {c: i for i, c in byte_letters().items()}
    with open(A, encoding="utf-8") as file:
        names = {i: w for w, i in json.load(file)["model"]["vocab"].items()}
    grouped = []
    for t in texts:
        ids_a = a.encode(" " + (t or ""), add_special_tokens=False).ids
        ids_b = b.encode(t or "")
        own = [bytes(raw[c] for c in names[i]) for i in ids_a]
        other = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not t or b"".join(own) != (" " + t).encode() or b"".join(other) != (" " + t).encode():
            grouped.append([])
            continue
        ends_a, ends_b = (list(np.cumsum([len(x) for x in y])) for y in (own, other))
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, low = [], 0
        for cut in cuts:
            groups.append(([i for i, e in zip(ids_a, ends_a) if low < e <= cut], [i for i, e in zip(ids_b, ends_b) if low < e <= cut]))
            low = cut
        grouped.append(groups)
    count = {}
    for groups in grouped:
        for pair in {(x, y) for own, other in groups for x in own for y in other}:
            count[pair] = count.get(pair, 0) + 1
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for groups in grouped:
        links = [(x, y) for own, other in groups for x in own for y in other]
        text = ";".join(f"{','.join(map(str, own))}|{','.join(map(str, other))}" for own, other in groups)
        out.append(
            (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
             sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), text)
        )
    return out


TEXTS = [
    "the cat sat on the mat", "The cat  sat\n\non  the mat.\n", "", None, " ", "  ", "\n", "\n a", "a\t b", "a\x1c!\x1cb c", "Straße ﬁ ①",
    "日本語のテキスト 日本", "a▁b the cat", "<s> hi </s> <|endoftext|>", "\x00 zero", "the cat sat on the mat", "we're they'll  I'd", "é é​ x", "ab" * 300,
    "a\r\nb\xa0c 　 d", "🙂 🙂🙂", "a \n b\n\n\n  c ", "x" * 5000,
]


def rows_of(df):
    return [
        (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in sorted(df.collect(), key=lambda r: r.key)
    ]


@pytest.mark.parametrize("most", [alignment.MOST_PAIRS, 0])
def test_equals_the_definition(spark, library, most):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "key long, text string").repartition(5)
    assert rows_of(alignment.align(docs, A, B, most_pairs=most)) == plain(TEXTS, library)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\tab'é▁、\r\x1c\x85\xa0.0Tthe"), max_size=40), max_size=4))
def test_ids_equal_the_libraries(library, texts):
    own, other = alignment._encoders(A, B)
    got, whole = other.encode(texts)
    for t, ids, ok in zip(texts, got, whole):
        assert ok == ("▁" not in t)
        if ok and t:
            assert ids.tolist() == library[1].encode(t)
    for t, ids in zip(texts, own.encode([" " + t for t in texts])):
        assert ids.tolist() == library[0].encode(" " + t, add_special_tokens=False).ids


def test_small_memory(spark, library, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "key long, text string").repartition(2)
    monkeypatch.setattr(alignment, "AT_ONCE", 10)
    monkeypatch.setattr(alignment, "LINKS", 3)
    assert rows_of(alignment.align(docs, A, B)) == plain(TEXTS, library)
    _, pieces = alignment._encoders(A, B)
    monkeypatch.setattr(alignment, "KEPT", 2)
    for t in ("the cat", "a b c", "the cat"):
        assert pieces.encode([t])[0][0].tolist() == library[1].encode(t)


def test_empty_table_and_clashing_columns(spark, library):
    none = spark.createDataFrame([], "key long, text string")
    assert alignment.align(none, A, B).collect() == []
    assert alignment.align(none, A, B, most_pairs=-1).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "key long, text string")
    assert rows_of(alignment.align(nothing, A, B)) == [(0, 0, 0, 0, 0, 0, "")] * 2
    docs = spark.createDataFrame([(1, "the cat", 7, "x", 1.5), (2, "the cat", 8, None, None)], "key long, text string, n_a int, groups string, more double")
    for most in (10, 0):
        out = alignment.align(docs, A, B, most_pairs=most)
        assert out.columns == ["key", "more", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
        assert rows_of(out) == plain(["the cat", "the cat"], library)


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    want = plain([r.text for r in rows], library)
    found = sorted(QUERIES["op13_token_alignment"](spark, folder).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in found] == [r.doc_id for r in rows]
    for r, w in zip(found, want):
        digest = hashlib.sha256(w[6].encode()).hexdigest() if w[6] else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (*w[:6], digest)


@pytest.mark.parametrize("count, bucket", [(0, 16), (1, 16), (5_000, 64), (5_000, 4_096)])
def test_perfect_hash(spark, count, bucket):
    keys = np.unique(np.random.default_rng(3).integers(-(1 << 62), 1 << 62, count))
    index = mphf.build(spark.createDataFrame([(int(k),) for k in keys], "k long").repartition(3), len(keys), bucket)
    at = index.find(keys)
    assert sorted(at.tolist()) == list(range(len(keys)))
    assert (index.keys[at] == keys).all()
    assert (index.find(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()


def test_perfect_hash_refuses_repeats(spark):
    with pytest.raises(Exception, match="repeated"):
        mphf.build(spark.createDataFrame([(1,), (1,)], "k long"), 2)


def test_later_passes_hold_no_encoders(library):
    """What the encoders remember is let go before the ids are aligned, and names are made for known ids only."""
    own, other = alignment._encoders(A, B)
    ids, _ = other.encode(["two words"])
    a = np.concatenate(own.encode([" two words"])).astype("<u2").tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([a]), pa.array([ids[0].astype("<u2").tobytes()])], names=["__a", "__b"])
    texts = [t for _, t in alignment._runs(A, B, [batch], 0)]
    assert texts[0].written()[0] and alignment._encoders.cache_info().currsize == 0
    assert len(alignment._marked(texts[0].ids)) < 3 << alignment.BITS
