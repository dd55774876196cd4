"""License scans: MinHash bands over overlapping windows, then exact shingle containment.

Templates are cut into segments of at most ``SEGMENT`` words, and texts into windows of twice that
width that overlap by half, so every segment of a verbatim copy lies whole in some window. A window
retrieves a template when one of its bands (one MinHash value each) equals the segment's. The number
of bands follows from the smallest Jaccard similarity of a segment to a window that holds it and the
accepted chance to miss. What is retrieved counts only if the words around the window hold enough of
the template's shingles, which is computed exactly.

Only built-in expressions run. Documents and windows without any shingle of a template can collide
with none, so they leave before the MinHash values are computed; nothing else is left out.
"""

from __future__ import annotations

import json
import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

SHINGLE, SEGMENT = 3, 8
#: Chance that a window holding a whole segment does not retrieve its template.
MISS = 1e-4
_NOT_WORD = r"[^\p{L}\p{N}]+"

# Public notices (short lines, and the grants that head the licenses' texts), and those of the data file:
# standard headers, passages that tell a license's own text, names of the Creative Commons licenses, SPDX lines.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0-notice", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction"),
) + tuple(map(tuple, json.loads(Path(__file__).with_name("license_notices.json").read_text(encoding="utf-8"))))


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), _NOT_WORD), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Hashes of the runs of three words, by position; fewer words have none."""
    at = lambda i, k: F.get(words, i + k)
    each = F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(*(at(i, k) for k in range(SHINGLE))))
    return F.when(F.size(words) >= SHINGLE, each).otherwise(F.array().cast("array<bigint>"))


def _segments(words: list[str]) -> list[list[str]]:
    """Parts of at most SEGMENT words that share enough words to keep all shingles; none is shorter than a shingle."""
    step = SEGMENT - SHINGLE + 1
    return [words[at : at + SEGMENT] for at in range(0, max(1, len(words) - SHINGLE + 1), step)]


def bands_needed(least_shingles: int, window_shingles: int, miss: float = MISS) -> int:
    """Bands of one value so that the chance to share none, (1 - J) ** bands, is at most ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - least_shingles / window_shingles)) if least_shingles < window_shingles else 1


def scan(docs: DataFrame, templates=TEMPLATES, text: str = "text", least: float = 0.8, miss: float = MISS) -> DataFrame:
    """Add ``licenses``: array of (license, containment), sorted, of the templates found in each whole text.

    ``templates`` are (id, text) pairs on the driver: their number is the caller's bound. Each needs
    three words. A null, empty or short text has none (an empty array). Equal texts get equal
    results; an input column ``licenses`` gives way.
    """
    spark = docs.sparkSession
    listed = [(k, re.sub(r"[^\w]+|_+", " ", t.lower()).split()) for k, t in templates]
    if any(len(w) < SHINGLE for _, w in listed):
        raise ValueError("a template needs three words")
    longest = max((len(w) for _, w in listed), default=SHINGLE)
    width = 2 * SEGMENT - SHINGLE + 1
    parts = [(k, s) for k, w in listed for s in _segments(w) if len(s) >= SHINGLE]
    bands = bands_needed(min((len(s) - SHINGLE + 1 for _, s in parts), default=1), width, miss)
    minhash = lambda xs: F.transform(
        F.sequence(F.lit(1), F.lit(bands)), lambda b: F.struct(b.alias("b"), F.array_min(F.transform(xs, lambda x: F.xxhash64(x, b))).alias("v"))
    )
    known = spark.createDataFrame(listed, "license string, words array<string>").select("license", shingles_of(F.col("words")).alias("template"))
    all_shingles = known.select(F.explode("template").alias("s")).distinct().collect()  # bounded by the templates
    any_of = F.array(*(F.lit(r.s) for r in all_shingles)).cast("array<bigint>")
    index = (
        spark.createDataFrame(parts, "license string, words array<string>")
        .select("license", F.explode(minhash(shingles_of(F.col("words")))).alias("band")).select("license", "band.*").distinct()
    )
    key = F.xxhash64(F.col(text))
    # Arrays that cannot be null and outer generators: otherwise the optimizer infers filters on them and computes the
    # words again for every shingle.
    shingled = docs.select(key.alias("__text"), words_of(F.coalesce(F.col(text), F.lit(""))).alias("w")).select("__text", shingles_of(F.col("w")).alias("s"))
    starts = F.when(F.arrays_overlap("s", any_of), F.sequence(F.lit(0), F.size("s") - 1, F.lit(SEGMENT)))
    windows = (
        shingled.select("__text", "s", F.explode_outer(starts).alias("at")).filter("at is not null")
        .select(
            "__text", F.slice("s", F.col("at") + 1, width).alias("window"),
            F.slice("s", F.greatest(F.col("at") + 1 - longest, F.lit(1)), width + 2 * longest).alias("around"),
        ).filter(F.arrays_overlap("window", any_of))
    )
    hits = (
        windows.select("__text", "around", F.explode_outer(minhash(F.col("window"))).alias("band")).select("__text", "around", "band.*")
        .join(F.broadcast(index), ["b", "v"]).join(F.broadcast(known), "license")
    )
    distinct = F.array_distinct("template")
    share = F.size(F.array_intersect(distinct, F.col("around"))) / F.size(distinct)
    best = hits.select("__text", "license", share.alias("c")).filter(F.col("c") >= least).groupBy("__text", "license").agg(F.max("c").alias("c"))
    found = best.groupBy("__text").agg(F.array_sort(F.collect_list(F.struct("license", F.col("c").alias("containment")))).alias("__found"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "licenses"]
    none = F.array().cast(found.schema["__found"].dataType)
    return docs.select(*kept, key.alias("__text")).join(found, "__text", "left").select(*kept, F.coalesce("__found", none).alias("licenses"))


def op8_license_scan(spark, sf_dir) -> DataFrame:
    """Licenses named in every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("licenses.license", ",").alias("licenses"),
        F.array_join(F.transform("licenses", lambda x: F.round(x["containment"], 4).cast("string")), ",").alias("containments"),
    )
