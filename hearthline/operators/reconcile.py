"""One truth per person: conflicting dates, flags, codes and dates of birth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import HotKeys, join_values, with_group_values

MAX_GAP_DAYS = 365
EARLIEST_DOB = "1900-01-01"


def _summaries(columns: Sequence[str]) -> dict[str, Column]:
    out = {"__rows": F.count(F.lit(1))}
    for c in columns:
        out |= {
            f"__n_{c}": F.count(c),
            f"__lo_{c}": F.min(c),
            f"__hi_{c}": F.max(c),
        }
    return out


def _conflict(c: str) -> Column:
    """The person's rows differ; a null beside a value counts as a difference."""
    spread = F.col(f"__lo_{c}") != F.col(f"__hi_{c}")
    return F.coalesce(spread, F.lit(False)) | (F.col(f"__n_{c}") < F.col("__rows"))


def _midpoint(c: str, kind: str) -> Column:
    low, high = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
    if kind == "date":
        gap = F.datediff(high, low)
        middle = F.date_add(low, F.floor(gap / 2).cast("int"))
        return F.when(gap < MAX_GAP_DAYS, middle)
    micros = F.unix_micros(high.cast("timestamp")) - F.unix_micros(low.cast("timestamp"))
    # Whole seconds are halved; the day of the result is kept.
    seconds = F.floor(micros / 1_000_000)
    half = F.make_dt_interval(secs=(seconds / 2).cast("decimal(18,6)"))
    day = F.to_date(low + half).cast(kind)
    return F.when(micros < F.lit(MAX_GAP_DAYS * 86_400_000_000), day)


def _settled(c: str, conflict_value: Column) -> Column:
    """Keep agreed values; spread a single valid one; otherwise the conflict's value."""
    return (
        F.when((F.col("__rows") <= 1) | ~_conflict(c), F.col(c))
        .when(F.col(f"__n_{c}") <= 1, F.col(f"__lo_{c}"))
        .otherwise(conflict_value)
    )


def resolve_person_values(
    df: DataFrame,
    person: str,
    times: Sequence[str] = (),
    flags: Sequence[str] = (),
    codes: Sequence[str] = (),
    hot: HotKeys | None = None,
) -> DataFrame:
    """Make all rows of a person agree.

    Times less than a year apart become their midpoint, others null; flags are true if ever
    true; codes with more than one valid row become null as soon as the rows differ. Rows
    without a person are left as they are.
    """
    columns = list(dict.fromkeys([*times, *flags, *codes]))
    if not columns:
        return df
    kinds = dict(df.dtypes)
    wide = with_group_values(df, [person], _summaries(columns), hot)
    known = F.col(person).isNotNull()
    values = {c: _midpoint(c, kinds[c]) for c in times}
    values |= {c: F.col(f"__hi_{c}") for c in flags}
    values |= {c: F.lit(None).cast(kinds[c]) for c in codes}
    settled = {c: F.when(known, _settled(c, v)).otherwise(F.col(c)) for c, v in values.items()}
    return wide.withColumns(settled).select(*df.columns)


def null_impossible_dob(
    clients: DataFrame,
    person: str,
    dob: str,
    enrollments: DataFrame,
    enrollment_person: str,
    entry: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Null a date of birth after the person's first enrolment or before 1900.

    Without an enrolment only the second test applies. Adds ``__bad_dob`` for counting.
    """
    first = (
        enrollments.filter(F.col(enrollment_person).isNotNull())
        .groupBy(F.col(enrollment_person).alias(person))
        .agg(F.min(entry).alias("__first"))
    )
    joined = join_values(clients, first, [person], "left", hot, null_safe=False)
    late = F.coalesce(F.col(dob) > F.col("__first"), F.lit(False))
    early = F.coalesce(F.col(dob) < F.lit(EARLIEST_DOB).cast("date"), F.lit(False))
    bad = F.col(person).isNotNull() & (late | early)
    return joined.withColumn("__bad_dob", bad).withColumn(
        dob, F.when(~F.col("__bad_dob"), F.col(dob))
    ).select(*clients.columns, "__bad_dob")


def modal_values(
    df: DataFrame,
    person: str,
    value: str,
    source: str,
    preferred: Sequence[str],
    name: str = "h_dob",
) -> DataFrame:
    """Each person's most frequent value, from the preferred sources where they have rows there.

    Ties are all kept and null counts as a value, so a person may have several rows. Counting
    is combined map-side; afterwards a person has one row per distinct value.
    """
    prefer = F.coalesce(F.col(source).isin(list(preferred)), F.lit(False))
    counts = df.groupBy(person, F.col(value).alias(name), prefer.alias("__pref")).agg(
        F.count("*").alias("__n")
    )
    # People without a preferred row use all their rows, which are then all not preferred.
    best = counts.groupBy(person).agg(
        F.max("__pref").alias("__use"),
        F.max(F.struct("__pref", "__n")).alias("__top"),
    )
    keyed = counts.alias("c").join(
        best.alias("b"), F.col(f"c.{person}").eqNullSafe(F.col(f"b.{person}"))
    )
    same = (F.col("__pref") == F.col("__use")) & (F.col("__n") == F.col("__top.__n"))
    return keyed.filter(same).select(f"c.{person}", name, F.col("__n").alias("n"))
