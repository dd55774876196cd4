"""URL filters: rules first, else empirical-Bayes host reputation.

Labelled page outcomes (good or bad) of a host are shrunk towards those of its registered domain,
the domain's towards its public suffix, the suffix's towards all pages. Each level's prior is a
beta distribution: its mean is the parent's posterior mean, its strength comes from the spread of
the level's rates by the method of moments. A page is blocked when the lower bound of its host's
posterior bad rate exceeds a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written

#: (verdict, host, path) of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Public suffixes of more than one label; every other suffix is the last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "org.au", "co.jp", "com.br", "co.in", "co.nz", "co.za")
LEVELS = ("suffix", "domain", "host")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def suffix_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The public suffix; of an IPv4 address the empty text."""
    two = F.substring_index(host, ".", -2)
    return (
        F.when(host.rlike(r"^[0-9]+(\.[0-9]+){3}$"), F.lit(""))
        .when(two.isin(*suffixes), two)
        .otherwise(F.substring_index(host, ".", -1))
    )


def domain_of(host: Column, suffix: Column) -> Column:
    """The registered domain: the suffix and one label more; an address or a bare suffix is its own."""
    labels = F.size(F.split(suffix, r"\.")) + 1
    return F.when(suffix == "", host).otherwise(F.array_join(F.slice(F.split(host, r"\."), -F.least(labels, F.size(F.split(host, r"\."))), labels), "."))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null without one; the earlier of equally long ones."""
    text = verdict = None
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = (F if text is None else text).when(fits, F.lit(rule_host + rule_path))
        verdict = (F if verdict is None else verdict).when(fits, F.lit(kind))
    return (text, verdict) if text is not None else (F.lit(None).cast("string"),) * 2


def _strength(groups: DataFrame) -> float:
    """Pseudo-count of a level's prior from (n, bad, mean): beta-binomial method of moments over its groups."""
    p, m = F.col("bad") / F.col("n"), F.col("mean")
    r = groups.filter("n > 0").agg(
        F.sum(F.col("n") * (p - m) * (p - m)).alias("s"), F.sum(F.col("n") * m * (1 - m)).alias("v"), F.count("*").alias("k"),
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
    ).first()
    if not r.k or r.k < 2 or not r.v or r.n == r.k:
        return 10.0
    within = r.v / r.n
    rho = (r.s / within - (r.k - 1)) / (r.n - r.nn / r.n - (r.k - 1))
    rho = min(max(rho, 0.001), 0.999)
    return 1 / rho - 1


def host_posteriors(hosts: DataFrame, outcomes: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """``host``, ``alpha``, ``beta`` and ``n`` for every host of ``hosts`` or ``outcomes``.

    ``outcomes`` has ``host`` and ``bad`` (boolean; null is no outcome). Hosts without outcomes get
    what their domain, suffix or all pages tell; with no outcome at all the rate is one half.
    """
    asked = hosts.groupBy("host").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    counts = outcomes.filter("bad is not null").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    level = asked.unionByName(counts).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    level = level.withColumn("suffix", suffix_of(F.col("host"), suffixes)).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    level = written(level, "url-hosts")
    all_pages = level.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((all_pages.bad or 0) + 1) / ((all_pages.n or 0) + 2)
    parents = None
    for name, above in zip(LEVELS, (None, *LEVELS)):
        groups = level.groupBy(*([above] if above else []), name).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        groups = groups.join(parents, above) if above else groups.withColumn("mean", F.lit(mean))
        strength = F.lit(_strength(groups))
        groups = groups.withColumn("alpha", strength * F.col("mean") + F.col("bad")).withColumn(
            "beta", strength * (1 - F.col("mean")) + F.col("n") - F.col("bad")
        )
        parents = groups.select(name, (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("mean"))
    return groups.select("host", "alpha", "beta", "n")


def judge(
    pages: DataFrame, outcomes: DataFrame, rules=RULES, url: str = "url", limit: float = 0.5, z: float = 1.645,
    suffixes: tuple[str, ...] = SUFFIXES,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``bad_bound`` (lower bound of the host's bad rate).

    ``outcomes`` has ``url`` and ``bad``. The bound is the posterior mean less ``z`` standard
    deviations. Pages without a host (null or odd urls) form one group, judged by the outcomes of
    such pages. Repeated rows are judged alike; input columns of the five names give way.
    """
    new = ("host", "path", "rule", "verdict", "bad_bound")
    host, path = host_and_path(F.col(url))
    parted = pages.select(*(F.col(f"`{c}`") for c in pages.columns if c not in new), host.alias("host"), path.alias("path"))
    labelled = outcomes.select(host_and_path(F.col("url"))[0].alias("host"), "bad")
    posterior = host_posteriors(parted.select("host"), labelled, suffixes)
    mean, total = F.col("alpha") / (F.col("alpha") + F.col("beta")), F.col("alpha") + F.col("beta")
    bounds = posterior.select("host", (mean - z * F.sqrt(mean * (1 - mean) / (total + 1))).alias("bad_bound"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("bad_bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    kept = [F.col(f"`{c}`") for c in parted.columns]
    return parted.join(bounds, "host", "left").select(*kept, rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"), "bad_bound")


def op3_url_filter(spark, sf_dir) -> DataFrame:
    """Judge every url of ``pages``. A labelled outcome is a row of ``labels`` with the page's id: bad if
    it is toxic or of no quality."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge(pages, pages.join(labels, "page_id").select("url", "bad")).select("page_id", "host", "path", "rule", "verdict")
