"""Groups against brute force on texts made to sit near the limit."""

import os
import random
import re

import pytest
from pyspark import SparkContext

from hearthline.llm import jaccard as J
from hearthline.llm import shingles as S

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def brute(rows, percent):
    """{place: smallest id of the group}"""
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(rows))]


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    return words


def cases(rng):
    texts = [None, "", " \n ", "A b", "a B", "a b c d e", "a b c d e f", "É é", "é é"]
    passage = [f"p{k}" for k in range(60)]
    for _ in range(6):
        base = [f"b{rng.randrange(10**6)}" for _ in range(rng.randint(30, 120))]
        texts += [" ".join(near(rng, base, rng.randint(0, 4))) for _ in range(12)]
    for _ in range(50):  # one passage in many documents, a larger part of some
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.choice([3, 8, 15, 100]))]
        texts.append(" ".join(own + passage))
    for k in range(40):  # a chain: each like the next, the ends unlike
        texts.append(" ".join(f"c{i}" for i in range(2 * k, 2 * k + 60)))
    texts += [texts[20]] * 15 + ["w " * 20_000]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,common,small,percent", [(2, 3, 4, 80), (3, 1, 0, 60)])
def test_groups_equal_brute_force(spark, monkeypatch, seed, common, small, percent):
    monkeypatch.setattr(J, "COMMON", common)
    monkeypatch.setattr(J, "SMALL", small)
    rows = cases(random.Random(seed))
    rows += [(None, rows[5][1]), rows[6]]
    docs = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, node string")
    got = J.similarity_groups(docs, percent=percent).collect()
    want = dict(zip([k for k, _ in rows], brute(rows, percent)))
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want[r.key], rows[r.key] if r.key is not None else None
    sizes = {k: len(shingle_set(t)) for k, t in rows}
    assert all(r.n_shingles == sizes[r.key] for r in got)
    left = J.one_of_each(docs, percent=percent)
    assert left.columns == docs.columns
    grouped = {want[k] for k, t in rows if shingle_set(t) and k is not None}
    kept = [r.doc_id for r in left.collect()]
    assert sorted(k for k in kept if k is not None and sizes[k]) == sorted(grouped)
    assert sorted(k for k in kept if k is not None and not sizes[k]) == sorted(k for k, t in rows if k is not None and not shingle_set(t))


@pytest.mark.parametrize("seed,common,small,percent", [(2, 3, 4, 80), (3, 1, 0, 60)])
def test_every_link_is_counted(spark, monkeypatch, seed, common, small, percent):
    monkeypatch.setattr(J, "COMMON", common)
    monkeypatch.setattr(J, "SMALL", small)
    rng = random.Random(seed)
    rows = cases(rng)
    base = [f"q{k}" for k in range(200)]  # one ball: all near the same text and one another
    rows += [(len(rows) + i, " ".join(near(rng, base, 1))) for i in range(25)]
    sets = [shingle_set(t) for _, t in rows]
    want = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                want[i] += 1
                want[j] += 1
    got = J.similarity_groups(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent, count_links=True).collect()
    assert {r.key: r.n_links for r in got} == dict(zip([k for k, _ in rows], want))
    groups = brute(rows, percent)
    assert all(r.component_id == groups[r.key] for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert J.similarity_groups(docs).count() == 0 and J.one_of_each(docs).count() == 0


def test_null_keys_alone(spark):
    text = " ".join(f"x{i}" for i in range(20))
    docs = spark.createDataFrame([(None, text), (None, text), (None, "y"), (None, None)], "doc_id long, text string")
    assert [r.component_id for r in J.similarity_groups(docs).collect()] == [None] * 4
    assert J.one_of_each(docs).count() == 3


def test_shingle_hashes_follow_the_words():
    rng = random.Random(1)
    for _ in range(200):
        t = "".join(rng.choices("aAbB é\n\t\x0b\x1c", k=rng.randint(0, 60)))
        assert len(S.shingle_set(t)) == len(shingle_set(t))
    a, b = "the Quick brown fox jumps over it", "x y THE quick\tbrown  fox jumps\nover z"
    both = shingle_set(a) & shingle_set(b)
    assert len(set(S.shingle_set(a).tolist()) & set(S.shingle_set(b).tolist())) == len(both) == 2
    assert S.digest(S.shingle_set(a)) == S.digest(S.shingle_set(a.lower() + "\n")) != S.digest(S.shingle_set(b))


def test_words_that_polynomial_hashes_mix_up():
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    for text in (word, other, word * 2):
        assert S.word_hashes(text, 0) != S.word_hashes(text, 1)
    assert len({int(S.word_hashes(t)[0]) for t in (word, other, word * 2, other * 2)}) == 4
    assert S.word_hashes(f"{word} x {word}")[0] == S.word_hashes(f"x {word}")[1]


def test_the_broadcast_of_common_shingles_is_given_up(spark, monkeypatch):
    made, make = [], SparkContext.broadcast

    def kept(sc, value):
        made.append(make(sc, value))
        return made[-1]

    monkeypatch.setattr(SparkContext, "broadcast", kept)
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(i, f"{text} {i % 2}") for i in range(6)], "doc_id long, text string")
    groups = J.similarity_groups(docs, percent=50)
    assert made and not any(os.path.exists(b._path) for b in made)
    assert [r.component_id for r in groups.collect()] == [0] * 6
