"""Hosts, rules and shrinkage."""

from pyspark.sql import functions as F

from hearthline.llm import urls as U


def test_hosts_paths_and_rules(spark):
    rows = [
        ("http://WWW.Example.COM/en/x?q=/a#b", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("https://example.com/en/", "example.com", "/en/", "example.com/en/", "block"),
        ("https://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("https://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
        ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"), ("http://x.net/es", "x.net", "/es", None, None),
        ("http://com?x", "com", "", None, None), ("http://a.com#/en/", "a.com", "", None, None),
        ("ÄB://É.NET/fr/://", "É.net", "/fr/://", "net/fr/", "block"), ("no scheme", "", "", None, None), (None, "", "", None, None),
        ("", "", "", None, None), ("://", "", "", None, None), ("http://h.org/" + "p" * 50_000, "h.org", "/" + "p" * 50_000, None, None),
    ]
    pages = spark.createDataFrame([(i, r[0], "clash") for i, r in enumerate(rows)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = {r.page_id: r for r in U.judge(pages, none).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(rows):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or "allow")
    assert U.judge(pages.limit(0), none).count() == 0


def test_domains(spark):
    rows = [("a.b.co.uk", "co.uk", "b.co.uk"), ("b.co.uk", "co.uk", "b.co.uk"), ("co.uk", "co.uk", "co.uk"), ("x.y.org", "org", "y.org"),
            ("org", "org", "org"), ("10.0.0.1", "", "10.0.0.1"), ("", "", "")]
    df = spark.createDataFrame([(r[0],) for r in rows], "h string").withColumn("s", U.suffix_of(F.col("h")))
    assert [tuple(r) for r in df.withColumn("d", U.domain_of(F.col("h"), F.col("s"))).collect()] == rows


def test_reputation_shrinks_towards_the_domain(spark):
    """Bad hosts of a bad domain are blocked, a new host there too; a good domain's single bad page is forgiven."""
    labelled = [(f"http://h{k}.bad.org/{i}", i % 20 != 0) for k in range(8) for i in range(60)]
    labelled += [(f"http://h{k}.good.org/{i}", False) for k in range(8) for i in range(60)] + [("http://one.good.org/1", True)]
    labelled += [("http://h1.bad.org/none", None)] * 50
    outcomes = spark.createDataFrame(labelled, "url string, bad boolean")
    pages = [(1, "http://h3.bad.org/z"), (2, "http://new.bad.org/"), (3, "http://one.good.org/2"), (4, "http://h2.good.org/"), (4, "http://h2.good.org/")]
    got = U.judge(spark.createDataFrame(pages, "page_id long, url string"), outcomes).collect()
    assert {(r.page_id, r.verdict) for r in got} == {(1, "block"), (2, "block"), (3, "allow"), (4, "allow")} and len(got) == 5
    hosts = spark.createDataFrame([("h3.bad.org",), ("one.good.org",)], "host string")
    post = {r.host: r for r in U.host_posteriors(hosts, outcomes.select(U.host_and_path(F.col("url"))[0].alias("host"), "bad")).collect()}
    assert post["h3.bad.org"].n == 60 and post["one.good.org"].n == 1
    assert post["one.good.org"].alpha / (post["one.good.org"].alpha + post["one.good.org"].beta) < 0.5
