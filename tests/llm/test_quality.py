"""Statistics against a plain count, and line frequency."""

import random
import re

import duckdb

from hearthline.llm import quality as Q
from hearthline.llm.sql import QUALITY_SQL


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    inside = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_statistics(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t\n", "a", "a b c d e", "a b c d e a b c d e", "x " * 9, "l1 w\nl1 w\n\nl1 w \nl2", "é# 漢*\x1c$ \x0b<>|&%"]
    texts += [" ".join(rng.choices("abc", k=rng.randint(0, 60))).replace(" a", "\na") for _ in range(60)] + ["long text here " * 9_000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(1, "", "clash")]
    got = Q.text_statistics(spark.createDataFrame(rows, "doc_id long, text string, n_words string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(texts[r.doc_id] or ""), texts[r.doc_id]


def test_line_frequency(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    menu = "Home  About Us and all the other pages of this site"
    rows = [(i, f"{own(i)}\n{menu.upper() if i % 2 else menu}", "h") for i in range(30)]
    rows += [(100, f"{menu}\nshort rest", "h"), (101, f"{own(101)}\n{menu}", "other"), (102, own(102), None), (103, None, "h"), (104, "", None)]
    rows += [(200 + i, own(200) + "\nthe very same text again", "h") for i in range(40)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, kept string")
    got = {r.doc_id: r for r in Q.judge(docs, max_docs=20).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept and got[i].n_left == 12 and got[i].n_words == 23 for i in range(30))
    assert not got[100].kept and not got[100].base_failed and got[100].n_left == 2
    assert got[101].kept and got[101].n_left == 23 and got[102].kept and got[103].base_failed and got[104].base_failed
    assert all(got[200 + i].kept and got[200 + i].n_left == 17 for i in range(40)), "equal texts are one document"
    assert Q.judge(docs.limit(0)).count() == 0


def test_limit_relative_to_the_host(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    rows = [(i, f"{own(i)}\nthe footer of a small host", "small") for i in range(30)]
    rows += [(100 + i, own(100 + i) + ("\na line that few pages share" if i < 8 else ""), "large") for i in range(100)]
    rows += [(300 + i, own(300) + "\nthe very same text again", "copied") for i in range(40)]
    rows += [(400 + i, f"{own(400 + i)}\nthe footer of a tiny host", None) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = lambda **kw: {r.doc_id: r.n_words - r.n_left for r in Q.judge(docs, max_docs=5, **kw).collect()}
    got = left(max_share=20)
    assert len(got) == len(rows)
    assert all(got[i] == 6 for i in range(30)) and all(got[i] == 0 for i in got if i >= 100), "8 of 100 are few, 3 are under the floor"
    assert all(left(max_share=5)[100 + i] == 6 for i in range(8))
    got = left(max_share=20, copies=True)
    assert all(got[300 + i] == 17 for i in range(40)) and all(got[i] == 6 for i in range(30)) and got[100] == 0


def test_query_equals_its_sql_where_lines_go(spark, tmp_path):
    own = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    footer = "Home  About us and all other pages"
    rows = [(i, f"{own(i, 3 + i % 20)}\n{footer.upper() if i % 2 else footer}", "h") for i in range(130)]
    rows += [(200 + i, f"{own(i, 12)}\na line under the limit", None) for i in range(100)] + [(400 + i, rows[0][1], "h") for i in range(3)]
    rows += [(500 + i, f"{own(i, 12)}\nboilerplate of no host at all", None) for i in range(101)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted(tuple(r) for r in Q.op7_quality_rules(spark, str(tmp_path)).select(*Q.COLUMNS).collect())
    assert got == sorted(db.sql(f"SELECT {', '.join(Q.COLUMNS)} FROM ({QUALITY_SQL})").fetchall())
    at = Q.COLUMNS.index("n_left")
    assert sum(r[at] < r[1] for r in got) == 130 + 3 + 101
    assert 0 < sum(not r[6] and not r[7] for r in got), "lines that go cost documents"
