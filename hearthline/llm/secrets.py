"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

A candidate is an unbroken run of the characters that keys are written in. Within it, every maximal
stretch of one class (hexadecimal, alphanumeric, base64) has its windows held against the class's own
entropy limit, so a name or mark in front of a key does not lift the key's limit; one window at or
above it makes the whole stretch a span. Windows across "=" count by the class of the run. The counts
of a window's characters are kept while it slides, so that each step costs two updates. The
allow-list drops candidates and stretches that are known to be harmless.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns

KINDS = ("assign", "access", "hex", "entropy")

# Fixed values of the contract.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16

_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
# A run that is too short hides no longer match of these two, so their least length can stand in the pattern.
_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}")
_HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")

#: Harmless as a whole: UUIDs; numbers and dates; letters alone with joining marks; worded paths with a short number.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"[0-9_+=/-]+",
    r"[A-Za-z_/-]+",
    r"(?:[A-Za-z]+[/_-])+[A-Za-z]*[0-9]{0,4}",
)

#: Maximal stretches by class; "=" joins a name to its value or pads.
STRETCHES = {"hex": re.compile("[0-9a-fA-F]+"), "alnum": re.compile("[A-Za-z0-9]+"), "base64": re.compile("[A-Za-z0-9+/_-]+")}


@dataclass(frozen=True)
class EntropyRule:
    """``limits``: bits a character, by class; ``least_classes``: of lower case, upper case, digit."""

    window: int = 20
    least: int = 20
    limits: dict = field(default_factory=lambda: {"hex": 3.0, "alnum": 3.7, "base64": 3.7})
    least_classes: int = 2
    allowed: tuple = ALLOWED


def class_of(run: str) -> str:
    if re.fullmatch("[0-9a-fA-F]+", run):
        return "hex"
    return "alnum" if run.isalnum() else "base64"


def hot_windows(run: str, window: int, limit: float) -> list[tuple[int, int]]:
    """United ranges of the windows whose Shannon entropy reaches the limit, by incremental counts.

    With counts c of a window of w characters the entropy is log2(w) - sum(c * log2(c)) / w.
    """
    cost = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    most = (math.log2(window) - limit) * window + 1e-9
    counts: dict[str, int] = {}
    total, found = 0.0, []
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        total += cost[c + 1] - cost[c]
        counts[ch] = c + 1
        if i >= window:
            old = run[i - window]
            c = counts[old]
            total += cost[c - 1] - cost[c]
            counts[old] = c - 1
        if i >= window - 1 and total <= most:
            if found and found[-1][1] >= i - window + 1:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((i - window + 1, i + 1))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the three fixed kinds, in code points."""
    spans = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def entropy_spans(text: str, rule: EntropyRule, candidate: re.Pattern, allowed: re.Pattern) -> list[tuple[int, int, int]]:
    def harmless(run):
        has = any(map(str.islower, run)) + any(map(str.isupper, run)) + any(map(str.isdigit, run))
        return has < rule.least_classes or allowed.fullmatch(run)

    spans = []
    for m in candidate.finditer(text):
        run = m[0]
        if harmless(run):
            continue
        hot = [(a, 3, b) for a, b in hot_windows(run, rule.window, rule.limits[class_of(run)])]
        for name, stretch in STRETCHES.items():
            for s in stretch.finditer(run):
                if len(s[0]) >= rule.window and not harmless(s[0]) and hot_windows(s[0], rule.window, rule.limits[name]):
                    hot.append((s.start(), 3, s.end()))
        spans += [(m.start() + a, 3, m.start() + b) for a, b in _united(hot)]
    return spans


def _united(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, _, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def scan(docs: DataFrame, rule: EntropyRule | None = None, mask: str = "[SECRET]", text: str = "text") -> DataFrame:
    """Add ``spans`` (array of kind, start, end; code points, end exclusive) and ``redacted``.

    ``redacted`` is the text with every united span replaced by ``mask``. A null text has no spans
    and stays null; an empty one stays empty. Spans come by start, then in the order of ``KINDS``.
    Input columns of those two names give way. Rows are independent: repeated rows get equal
    results, and any length is scanned whole.
    """
    rule = rule or EntropyRule()
    candidate = re.compile(rf"[A-Za-z0-9+/_=-]{{{max(rule.least, rule.window)},}}")
    allowed = re.compile("|".join(rf"(?:{p})" for p in rule.allowed) or "(?!)")
    span = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
    fields = [T.StructField("spans", T.ArrayType(span)), T.StructField("redacted", T.StringType())]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(column):
        rows, masked = [], []
        for t in column.to_pylist():
            found = sorted(base_spans(t or "") + entropy_spans(t or "", rule, candidate, allowed))
            rows.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found])
            if found:
                at, parts = 0, []
                for a, b in _united(found):
                    parts += [t[at:a], mask]
                    at = b
                t = "".join([*parts, t[at:]])
            masked.append(t)
        return pa.array(rows, pa.list_(kind)), pa.array(masked, pa.string())

    return add_columns(docs, [text], fields, run)


def _joined(spans):
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def op5_secret_scan(spark, sf_dir) -> DataFrame:
    """Secrets of every whole text of ``documents``."""
    from .common import table

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
