"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits. One binary classifier per bit, a logistic regression
over hashed letter n-grams, predicts that bit of the text's language. Decoding adds up, for each
codeword, the logistic loss of the predicted margins, weighted by how well each bit was learned for
that language; the language with the least loss wins, and a small lead over the next flags the text
as ambiguous.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns

UNDETERMINED = "und"
_BLANK, _END, _PAD = 0x20, 0x00, b"\0\0\0"
#: ASCII: lower-cased letters stay, all else is a blank. Bytes of other characters stay.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalpha() else _BLANK for b in range(256))


@dataclass(frozen=True)
class LanguageModel:
    """``codes`` (languages x bits), ``weights`` (bits x features), ``bias``, ``trust`` (languages x bits)."""

    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray


def _has_letter(text: str, folded: bytes) -> bool:
    if any(b != _BLANK for b in folded[:64]) and text.isascii():
        return True
    import regex

    return regex.search(r"\p{L}", text) is not None


def folded_bytes(text: str | None) -> bytes | None:
    """Lower-cased UTF-8 with ASCII letters and other scripts only; None if the text has no letter."""
    if not text:
        return None
    folded = text.lower().encode().translate(_TABLE)
    return folded if _has_letter(text, folded) else None


def features(rows: list[bytes], dims: int) -> np.ndarray:
    """Square roots of the shares of the hashed 2- and 3-grams of bytes; rows have length 1."""
    flat = np.frombuffer(b"".join(x for r in rows for x in (b" ", r, b" ", _PAD)), np.uint8)
    row = np.repeat(np.arange(len(rows)), [len(r) + 2 + len(_PAD) for r in rows])
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != _BLANK) | (flat[:-1] != _BLANK)
    flat, row = flat[keep], row[keep]
    a = flat.astype(np.uint32)
    pair = a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA6B)
    triple = pair + a[2:] * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F)
    shift = np.uint32(33 - int(dims).bit_length())
    inside = flat[1:-1] != _END
    cells = row[:-2] * np.int64(dims)
    two = np.bincount((cells + ((pair * np.uint32(0x2C1B3C6D)) >> shift))[inside & (flat[:-2] != _END)], minlength=len(rows) * dims)
    inside &= (flat[2:] != _END) & (flat[:-2] != _END)
    three = np.bincount((cells + ((triple * np.uint32(0x2C1B3C6D)) >> shift))[inside], minlength=len(rows) * dims)
    counts = (two + three).reshape(len(rows), dims).astype(np.float32)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def packed(row: np.ndarray) -> bytes:
    """A bit for every cell, then the values that are not 0."""
    used = row != 0
    return np.packbits(used).tobytes() + row[used].tobytes()


def unpacked(rows: list[bytes], dims: int, kind: type) -> np.ndarray:
    """The float16 rows that were packed, as ``kind``."""
    out, bits = np.zeros((len(rows), dims), kind), -(-dims // 8)
    for to, row in zip(out, rows):
        used = np.unpackbits(np.frombuffer(row, np.uint8, bits), count=dims).view(bool)
        to[used] = np.frombuffer(row[bits:], np.float16)
    return out


def codebook(n: int, seed: int = 7) -> np.ndarray:
    """Codewords for n languages: all splits for up to 6, else random ones with the widest least distance."""
    if n <= 6:
        columns = [(1, *c) for c in itertools.product((1, -1), repeat=max(n - 1, 0)) if -1 in c]
        return np.array(columns, np.int8).T.reshape(n, -1)
    rng, bits = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(n)))
    best, widest = None, -1
    for _ in range(50):
        codes = np.where(rng.random((n, bits)) < 0.5, -1, 1).astype(np.int8)
        apart = bits - np.abs(codes.astype(np.int32) @ codes.T)  # a flipped codeword would be no less close
        least = apart[~np.eye(n, dtype=bool)].min()
        if least > widest and (np.abs(codes.sum(axis=0)) < n).all():
            best, widest = codes, least
    return best


def _logistic(x: np.ndarray, y: np.ndarray, l2: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases for every column of y by accelerated gradient descent; rows of x have length 1."""
    w, b = np.zeros((y.shape[1], x.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    ahead_w, ahead_b = w, b
    rate = 1 / (0.5 + l2)
    for k in range(steps):
        pull = -y / (1 + np.exp(np.clip(y * (x @ ahead_w.T + ahead_b), -30, 30))) / len(x)
        next_w = ahead_w - rate * (pull.T @ x + l2 * ahead_w)
        next_b = ahead_b - rate * pull.sum(axis=0)
        m = k / (k + 3)
        ahead_w, ahead_b = next_w + m * (next_w - w), next_b + m * (next_b - b)
        w, b = next_w, next_b
    return w, b


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    sample: int = 2_000, dims: int = 4_096, l2: float = 1e-4, steps: int = 300, seed: int = 7, most_languages: int = 256,
) -> LanguageModel:
    """Learn from a sample of about ``sample`` labelled rows, evenly over the languages.

    The sample is the documented bound of what reaches the driver (as packed features, not texts): rows
    are drawn by a hash of ``key``, and the first twice ``sample`` of them by that hash and the text
    are taken. Of more than ``most_languages`` languages those with most rows are learned (ties: the
    smaller name). Rows with null language or without a letter teach nothing; if no row of the sample
    has a letter, the model knows no language. ``dims`` must be a power of two.
    """
    labelled = labelled.filter(F.col(lang).isNotNull())
    counts = labelled.groupBy(F.col(lang).alias("__lang")).agg(F.count("*").alias("__n"))
    rates = [(r[0], r[1]) for r in counts.orderBy(F.desc("__n"), "__lang").limit(most_languages).collect()]
    nothing = LanguageModel((), np.zeros((0, 0), np.int8), np.zeros((0, dims)), np.zeros(0), np.zeros((0, 0)))
    if not rates:
        return nothing
    share = max(1, sample // len(rates))
    rate = F.create_map(*(F.lit(x) for k, n in rates for x in (k, min(1.0, share / n))))
    at = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30))
    drawn = F.coalesce(at < F.try_element_at(rate, F.col(lang)) * (1 << 30), F.lit(False))

    def featurise(column):
        folded = [folded_bytes(t) for t in column.to_pylist()]
        known = [f for f in folded if f is not None]
        rows = iter(features(known, dims).astype(np.float16) if known else ())
        return [pa.array([None if f is None else packed(next(rows)) for f in folded], pa.binary())]

    rows = add_columns(
        labelled.filter(drawn).select(F.col(lang).alias("lang"), F.col(text).alias("text"), at.alias("at")),
        ["text"], [T.StructField("features", T.BinaryType())], featurise,
    ).drop("text").filter("features is not null").orderBy("at", "lang", "features").limit(2 * sample).collect()
    languages = tuple(sorted({r.lang for r in rows}))
    if not languages:
        return nothing
    codes = codebook(len(languages))
    if len(languages) < 2:
        return LanguageModel(languages, codes, np.zeros((0, dims)), np.zeros(0), np.ones((len(languages), 0)))
    at = np.array([languages.index(r.lang) for r in rows])
    # By language, then by the bytes of the features: the sums of the regression depend on the order.
    order = np.lexsort((unpacked([r.features for r in rows], dims, np.float16).view(f"S{2 * dims}")[:, 0], at))
    x, at = unpacked([rows[i].features for i in order], dims, np.float32), at[order]
    y = codes[at].astype(np.float32)
    w, b = _logistic(x, y, l2, steps)
    right = (x @ w.T + b) * y > 0
    trust = np.array([right[at == i].mean(axis=0) for i in range(len(languages))]) + 1e-3
    return LanguageModel(languages, codes, w, b, trust / trust.sum(axis=1, keepdims=True))


def decode(model: LanguageModel, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every row: the nearest codeword, its share (0 to 1) of all, and its lead over the next."""
    margins = x @ model.weights.T + model.bias
    loss = np.stack([np.logaddexp(0, -margins * c) @ t for c, t in zip(model.codes.astype(np.float32), model.trust)], axis=1)
    share = np.exp(-margins.shape[1] * (loss - loss.min(axis=1, keepdims=True)))
    share /= share.sum(axis=1, keepdims=True)
    best = loss.argmin(axis=1)
    order = np.sort(share, axis=1)
    return best, order[:, -1], order[:, -1] - order[:, -2]


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", min_lead: float = 0.2) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``ambiguous`` (the lead is under ``min_lead``) for every whole text.

    A null text, or one without a letter, is ``und`` with score 0 and not ambiguous; so is every
    text if the model knows no language. A single known language is predicted with score 1. Rows
    are independent; input columns of the three names give way.
    """
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    dims = model.weights.shape[1]

    def run(column):
        folded = [folded_bytes(t) for t in column.to_pylist()]
        langs, scores, unsure = [UNDETERMINED] * len(folded), [0.0] * len(folded), [False] * len(folded)
        known = [i for i, f in enumerate(folded) if f is not None] if model.languages else []
        for at in range(0, len(known), 64):
            part = known[at : at + 64]
            if len(model.languages) == 1:
                found = zip(np.zeros(len(part), int), np.ones(len(part)), np.ones(len(part)))
            else:
                found = zip(*decode(model, features([folded[i] for i in part], dims)))
            for i, (best, score, lead) in zip(part, found):
                langs[i], scores[i], unsure[i] = model.languages[best], float(min(score, 1.0)), bool(lead < min_lead)
        return pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure)

    return add_columns(docs, [text], fields, run)


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def op1_language_id(spark, sf_dir) -> DataFrame:
    """The language of every whole text of ``documents``, learned from the folds that are not held out."""
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(docs.filter(~F.col("held_out")))
    return predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
