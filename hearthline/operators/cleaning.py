"""Row and value clean-up of single tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Codes that mean "unknown" in categorical columns.
UNKNOWN_CODES = (8, 9, 99)

# Parts of a name that mark a record without a usable name.
NAME_EXCLUSION = (
    "consent", "refused", "anonymous", "client", "refsued", "noname", "unknown",
)

# Words in upper-cased names of people who refused to be recorded.
REFUSED_WORDS = ("REFUSED", "ANONYMOUS")


# Tried in turn after ISO texts: month first with and without a time of day, compact, named months,
# and the day first where the month cannot be.
TIME_FORMATS = (
    "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy h:mm a", "M/d/yyyy h:mm:ss a", "M/d/yy",
    "M/d/yy H:mm", "M-d-yyyy", "yyyyMMdd", "yyyy/M/d", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d-MMM-yyyy",
    "d/M/yyyy", "d/M/yyyy H:mm", "d/M/yyyy H:mm:ss", "d-MMM-yy", "MMM d yyyy", "MMMM d yyyy", "M.d.yyyy", "d.M.yyyy",
    "yyyyMMdd H:mm", "yyyyMMdd H:mm:ss", "M/d/yyyy H:mm:ss.SSSSSS", "M/d/yyyy h:mm:ss.SSSSSS a",
)


def strip_bom(df: DataFrame) -> DataFrame:
    """Take one leading zero-width no-break space off every column name."""
    return df.toDF(*[c[1:] if c.startswith("﻿") else c for c in df.columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[c for c in columns if c in df.columns])


def null_unknown(
    df: DataFrame, columns: Sequence[str], codes: Sequence[float] = UNKNOWN_CODES
) -> DataFrame:
    """Null the unknown codes in each listed column; other values stay."""
    _require(df, columns)
    kinds = dict(df.dtypes)
    wanted = [float(c) for c in codes]

    def cleaned(name: str) -> Column:
        column = F.col(f"`{name}`")
        number = column.try_cast("double") if kinds[name] == "string" else column.cast("double")
        return F.when(number.isin(wanted), F.lit(None)).otherwise(column)

    return df.withColumns({c: cleaned(c) for c in columns}) if columns else df


def coerce_times(
    df: DataFrame,
    columns: Sequence[str],
    kind: str = "timestamp",
    formats: Sequence[str] = TIME_FORMATS,
) -> DataFrame:
    """Parse the columns as times; what cannot be parsed becomes null.

    ISO texts are tried first, then ``formats`` in their order, so an ambiguous day and month are
    read month first. A bare year is its first of January; two digits of a year mean 2000 to 2099.
    """
    _require(df, columns)
    kinds = dict(df.dtypes)

    def parsed(name: str) -> Column:
        column = F.col(f"`{name}`")
        if kinds[name] in ("date", "timestamp", "timestamp_ntz"):
            return column.cast(kind)
        text = F.trim(column.cast("string"))
        compact = text.rlike("^[0-9]{5,}$")  # else taken for a year of so many digits
        tries = [F.when(~compact, text.try_cast("timestamp"))]
        tries += [F.try_to_timestamp(text, F.lit(f)) for f in formats]
        return F.coalesce(*tries).cast(kind)

    return df.withColumns({c: parsed(c) for c in columns}) if columns else df


def has_usable_name(
    names: Sequence[Column], exclusion: Sequence[str] = NAME_EXCLUSION
) -> Column:
    """True when every name is present and none is a number, a single letter or a stand-in.

    Names are compared in lower case without dots; a name that holds a digit or any of the
    ``exclusion`` texts is not usable.
    """

    def usable(name: Column) -> Column:
        plain = F.replace(F.lower(name), F.lit("."), F.lit(""))
        stand_in = reduce(lambda a, b: a | b, [plain.contains(w) for w in exclusion])
        bad = stand_in | (F.length(plain) == 1) | plain.rlike("\\p{Nd}")
        return F.coalesce(~bad, F.lit(False))

    return reduce(lambda a, b: a & b, [usable(n) for n in names])


def exclude_names(
    df: DataFrame, columns: Sequence[str], exclusion: Sequence[str] = NAME_EXCLUSION
) -> DataFrame:
    """Keep the rows whose name columns are all usable."""
    _require(df, columns)
    kinds = dict(df.dtypes)
    if any(kinds[c] != "string" for c in columns):
        return df.filter(F.lit(False))  # numbers are never names
    return df.filter(has_usable_name([F.col(f"`{c}`") for c in columns], exclusion))


def exclude_refused(
    df: DataFrame, columns: Sequence[str], words: Sequence[str] = REFUSED_WORDS
) -> DataFrame:
    """Drop rows in which a listed column contains one of the words; nulls stay."""
    hits = [
        F.coalesce(F.col(c).contains(w), F.lit(False)) for c in columns for w in words
    ]
    return df.filter(~reduce(lambda a, b: a | b, hits))


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
