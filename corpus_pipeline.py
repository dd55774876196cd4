"""The corpus pipeline: from raw documents to encoded ones, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame; it is written as Parquet to the shared folder and read back before the next one. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm import bpe, jaccard, language, mixing, secrets
from hearthline.llm.common import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language, or of an ambiguous one, go.

    The model is learned from the labelled documents that are not held out; the column ``lang``
    stays as it was given. With no labelled document nothing can be told and nothing is rejected
    but texts without a letter.
    """
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    marked = language.predict(docs, model)
    told = (F.col("lang_pred") != language.UNDETERMINED) & ~F.col("ambiguous")
    if not model.languages:
        told = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return marked.filter(told).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return jaccard.one_of_each(docs).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; all documents stay."""
    scanned = secrets.scan(docs)
    return scanned.select("doc_id", F.col("redacted").alias("text"), "lang", "source", F.length("redacted").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document appears as often as the mix takes it: sources weigh 1, 2, 3, repeating."""
    mixed = mixing.mix(docs, mixing.cycling_weights).docs
    times = F.expr("CASE WHEN copies > 0 THEN sequence(1L, copies) END")
    return mixed.withColumn("__copy", F.explode_outer(times)).filter("__copy is not null").select(*COLUMNS)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``documents``, the token ids, and whether decoding them gives the text again."""
    import public_tokenizers as P

    coded = bpe.encode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, check=True)
    return coded.select(*COLUMNS, F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_bytes),
]
#: Learned models, seeded choices and token ids have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
