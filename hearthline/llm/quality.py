"""Quality rules: repetition within a text, and line frequency across the documents of a host.

Lines are normalised and hashed, and the distinct documents (texts) of a host that hold a line are
counted. Lines above the limit are boilerplate: they are removed, and a document that keeps too few
of its words is rejected. Everything is built-in expressions; a hot line is counted in parts before
the shuffle, and only lines above the limit are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, table, written

_BLANKS = r"[\x20\x09-\x0D]"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _BLANKS + "+"), lambda w: w != "")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def normalised(line: Column) -> Column:
    """Lower case, white space squeezed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), _BLANKS + "+", " "))


def _repeat_words(windows: Column) -> Column:
    """Words inside windows (hashes by position) that occur twice or more; windows are five words wide."""
    ordered = F.array_sort(F.transform(windows, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    later = F.slice(ordered, 2, F.greatest(F.size(windows), F.lit(1)))
    none = F.array().cast("array<int>")
    twins = F.zip_with(ordered, later, lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])).otherwise(none))
    places = F.array_sort(F.array_distinct(F.flatten(twins)))
    following = F.slice(places, 2, F.greatest(F.size(windows), F.lit(1)))
    widths = F.zip_with(places, following, lambda p, q: F.least(F.coalesce(q - p, F.lit(5)), F.lit(5)))
    return F.aggregate(widths, F.lit(0), lambda total, x: total + x)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``.

    A null text has no words and no lines: all five are 0. Input columns of those names give way.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.col("__lines")
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    at = lambda i, k: F.get(F.col("__words"), i + k)
    windows = F.when(
        F.size("__words") >= 5,
        F.transform(F.sequence(F.lit(0), F.size("__words") - 5), lambda i: F.xxhash64(*(at(i, k) for k in range(5)))),
    ).otherwise(F.array().cast("array<bigint>"))
    split = docs.select(
        *kept, words_of(t).alias("__words"), lines_of(t).alias("__lines"),
        (F.length(t) - F.regexp_count(t, F.lit(_BLANKS))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    ).withColumn("__windows", windows)
    repeats = F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), _repeat_words(F.col("__windows"))).otherwise(0)
    return split.select(
        *kept, F.size("__words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words"),
    )


def removed_words(docs: DataFrame, host: str, text: str, max_docs: int, max_share: float = 0, copies: bool = False) -> DataFrame:
    """(__text, removed): words of every text of a host in lines that too many of its documents hold.

    Too many are over ``max_docs`` and over ``max_share`` per cent of the host's documents. ``__text``
    is the key of a text and its host; equal texts of a host count as one document unless ``copies``
    is set. Texts without such a line are not listed.
    """
    key = _text_key(host, text)
    lines = docs.select(key.alias("__text"), F.col(host).alias("h"), F.explode_outer(F.split(text, "\n")).alias("line"))
    lines = lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(
        "__text",
        F.xxhash64(F.col("h").isNull(), "h", normalised(F.col("line"))).alias("line"),
        F.regexp_count("line", F.lit(WORD)).alias("w"),
    )
    # Equal rows of one text share its key; the mean over them undoes their number.
    held = written(lines.groupBy("__text", "line").agg(F.sum("w").cast("long").alias("w")), "quality-lines")
    if max_share or copies:
        texts = docs.groupBy(key.alias("__text")).agg(
            F.first(F.xxhash64(F.col(host).isNull(), host)).alias("h"), (F.count("*") if copies else F.lit(1)).cast("long").alias("k")
        )
        texts = written(texts, "quality-texts")
        counts = held.join(texts, "__text").groupBy("line").agg(F.first("h").alias("h"), F.sum("k").alias("n"))
        counts = counts.filter(F.col("n") > max_docs).join(texts.groupBy("h").agg(F.sum("k").alias("all")), "h")
        hot = counts.filter(100 * F.col("n") > max_share * F.col("all")).select("line")
    else:
        hot = held.groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") > max_docs).select("line")
    return held.join(hot, "line").groupBy("__text").agg(F.sum("w").alias("removed"))


def _text_key(host: str, text: str) -> Column:
    return F.xxhash64(F.col(host).isNull(), host, text)


def judge(
    docs: DataFrame, host: str = "source", text: str = "text", max_docs: int = 100, min_share: int = 50, min_words: int = 10,
    max_repeat: int = 20, max_share: float = 0, copies: bool = False,
) -> DataFrame:
    """Add the statistics, ``base_failed``, ``n_left`` (words outside boilerplate lines) and ``kept``.

    ``base_failed``: under ``min_words`` words, or over ``max_repeat`` per cent of them in repeated
    windows. A document is depleted, and not kept, if lines that over ``max_docs`` distinct texts of
    its host hold leave it under ``min_words`` words or under ``min_share`` per cent. With
    ``max_share`` they must also be over that percentage of the host's texts, so that ``max_docs``
    can be a small floor for hosts of any size; with ``copies`` every document counts, equal texts
    too. Null hosts form one host. Null and empty texts fail the base. Repeated rows are judged alike.
    """
    stats = text_statistics(docs.withColumn("__text", _text_key(host, text)), text)
    rows = stats.groupBy("__text").agg(F.count("*").alias("__copies"))
    removed = removed_words(docs, host, text, max_docs, max_share, copies).join(rows, "__text")
    removed = removed.select("__text", (F.col("removed") / F.col("__copies")).cast("long").alias("__removed"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("__removed", F.lit(0))
    whole = (F.col("n_left") >= min_words) & (100 * F.col("n_left") >= min_share * F.col("n_words"))
    return (
        stats.join(removed, "__text", "left").drop("__text").withColumn("base_failed", failed).withColumn("n_left", left)
        .drop("__removed").withColumn("kept", ~F.col("base_failed") & whole)
    )


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_left")


def op7_quality_rules(spark, sf_dir) -> DataFrame:
    """Judge every whole text of ``documents``; the host is the source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge(docs).select(*COLUMNS)
