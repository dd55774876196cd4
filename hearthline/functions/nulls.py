"""Null-aware expressions: R's NA rules where SQL's differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def if3(cond: Column, yes, no) -> Column:
    """Three-way conditional: a null condition gives null, not the else branch."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond, yes).when(~cond, no)


def paste(*parts: Column, sep: str = "") -> Column:
    """Join the parts as text; a null part becomes the text "NA"."""
    texts = [F.coalesce(p.cast("string"), F.lit("NA")) for p in parts]
    out = [texts[0]]
    for text in texts[1:]:
        out += [F.lit(sep), text] if sep else [text]
    return F.concat(*out)


def strict_count_if(flag: Column) -> list[Column]:
    """Aggregates (rows, known, true) from which :func:`strict_value` builds a strict sum."""
    return [F.count(F.lit(1)), F.count(flag), F.count(F.when(flag, 1))]


def strict_value(rows: Column, known: Column, true: Column) -> Column:
    """The number of true flags, or null as soon as one flag is null."""
    return F.when(rows == known, true)
