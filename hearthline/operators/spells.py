"""Housing spells: missing exits, covered time, transitions, gaps and overlaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import if3
from .skew import HotKeys, OrderedGroups, dealt_by_size, find_hot_keys, with_group_values

FIRST_ENTRY = "2004-01-01"
CUT_OFF = "2017-12-31"
SHORT_STAY_DAYS = 90

# Short services, whose missing exits are set to 90 days after entry.
SHORT_SERVICES = (
    "Day Shelter",
    "Emergency Shelter",
    "Homelessness Prevention",
    "Other Programs",
    "Services Only",
    "Street Outreach",
)


def usable_spells(df: DataFrame, person: str = "linkage_PID") -> DataFrame:
    """Rows of linked people that start in 2004 or later."""
    return df.filter(F.col(person).isNotNull() & (F.col("entry") >= F.lit(FIRST_ENTRY).cast("date")))


def impute_exits(
    df: DataFrame,
    order: str,
    person: str = "linkage_PID",
    cut_off: str = CUT_OFF,
    short_days: int = SHORT_STAY_DAYS,
    short_services: Sequence[str] = SHORT_SERVICES,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``h_exit``: the exit, or for open HMIS spells one derived from the person's next spell.

    Rows of a person are ordered by entry and then ``order``. Short services end after
    ``short_days`` unless the next spell with a known exit starts earlier; others end when that
    spell starts, or at the cut-off.
    """
    groups = OrderedGroups(df, [person], ["entry", order], hot)
    wide = groups.lead({"__next_entry": "entry", "__next_exit": "exit"})
    hmis = F.col("agency") == "HMIS"
    open_ = F.col("exit").isNull()
    short = F.coalesce(F.col("hmis_proj_type").isin(list(short_services)), F.lit(False))
    followed = F.col("__next_exit").isNotNull()
    after = F.col("__next_entry")
    gap = F.datediff(after, F.col("entry"))
    short_end = F.date_add("entry", short_days)
    value = if3(hmis & short & open_ & ~followed, short_end, F.col("exit"))
    value = if3(hmis & short & open_ & followed & (gap < short_days), after, value)
    value = if3(hmis & short & open_ & followed & (gap >= short_days), short_end, value)
    value = if3(hmis & open_ & ~short & ~followed, F.lit(cut_off).cast("date"), value)
    value = if3(hmis & open_ & ~short & followed, after, value)
    return wide.withColumn("h_exit", value).drop("__next_entry", "__next_exit")


def spell_bounds(df: DataFrame) -> DataFrame:
    """``h_servdays`` (exit minus entry) and ``h_entry`` (the exit for a negative spell)."""
    df = df.withColumn("h_servdays", F.datediff("h_exit", "entry"))
    return df.withColumn(
        "h_entry", if3(F.col("h_servdays") < 0, F.col("exit"), F.col("entry"))
    )


def covered_days(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    order: str,
    start: str = "h_entry",
    end: str = "h_exit",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Days covered by a group's spells [start, end), overlaps counted once, on every row.

    A spell adds what lies beyond the latest end before it; spells without a bound add nothing.
    """
    keys = list(keys)
    hot = find_hot_keys(df, keys) if hot is None else hot
    known = F.col(start).isNotNull() & F.col(end).isNotNull()
    ready = df.withColumn("__end", F.when(known, F.col(end)))
    wide = OrderedGroups(ready, keys, [start, order], hot).max_before({"__seen": "__end"})
    fresh = F.greatest(F.lit(0), F.datediff("__end", F.greatest(F.col(start), F.col("__seen"))))
    wide = wide.withColumn("__fresh", F.when(F.col("__end").isNotNull(), fresh).otherwise(F.lit(0)))
    out = with_group_values(wide, keys, {name: F.sum("__fresh")}, hot)
    return out.drop("__end", "__seen", "__fresh")


def repair_spells(df: DataFrame) -> DataFrame:
    """Null the dates of negative or open spells, count days inclusively, flag with 1."""
    good = F.coalesce(F.col("h_servdays") >= 0, F.lit(False))
    df = df.withColumns(
        {"h_exit": F.when(good, F.col("h_exit")), "h_entry": F.when(good, F.col("entry"))}
    )
    days = F.datediff("h_exit", "h_entry") + 1
    df = df.withColumn("h_servdays", days)
    return df.withColumn("h_time_qual", F.col("h_servdays").isNull().cast("int"))


def distinct_spells(df: DataFrame, order: str) -> DataFrame:
    """Drop exact repeats (all columns but ``order``), keeping the first position."""
    columns = [c for c in df.columns if c != order]
    return df.groupBy(*columns).agg(F.min(order).alias(order))


def spell_transitions(
    df: DataFrame, order: str, person: str = "linkage_PID", hot: HotKeys | None = None
) -> DataFrame:
    """What follows each spell: agency change, days to it, and whether it overlaps or lies within.

    Rows of a person are ordered by ``h_entry``, ``h_exit`` and ``order``, nulls last.
    """
    groups = OrderedGroups(df, [person], ["h_entry", "h_exit", order], hot)
    wide = groups.lead({"__agency": "agency", "__in": "h_entry", "__out": "h_exit"})
    start, end = F.col("h_entry"), F.col("h_exit")
    later_start, later_end = F.col("__in"), F.col("__out")
    change = F.concat_ws(" to ", F.coalesce("agency", F.lit("NA")), F.col("__agency"))
    return wide.withColumns(
        {
            "h_agency_trans": F.when(F.col("__agency").isNull(), F.col("agency")).otherwise(change),
            "h_t2next_prog": F.datediff(later_start, end),
            "h_overlap": (later_start <= end) & (start <= later_end),
            "h_within": (later_start >= start) & (later_end <= end),
        }
    ).drop("__agency", "__in", "__out")


def spell_history(
    df: DataFrame, order: str, person: str = "linkage_PID", cut_off: str = CUT_OFF
) -> DataFrame:
    """All spell columns; needs agency, hmis_proj_type, entry, exit and a unique ``order``."""
    hot = find_hot_keys(df, [person])
    df = dealt_by_size(df, hot)
    df = spell_bounds(impute_exits(df, order, person, cut_off, hot=hot))
    df = covered_days(df, [person, "agency"], "h_agency_time", order)
    df = covered_days(df, [person], "h_tot_time", order, hot=hot)
    df = distinct_spells(repair_spells(df), order)
    return spell_transitions(df, order, person, hot)
