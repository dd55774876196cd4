"""From merged agency rows to the longitudinal housing table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.cooccurrence import add_household_clusters
from ..operators.household import describe_households
from ..operators.reconcile import modal_values
from ..operators.skew import join_values, number_rows
from ..operators.spells import CUT_OFF, spell_history, usable_spells

# Agencies whose dates of birth take precedence.
AUTHORITIES = ("SHA", "KCHA")


def with_modal_dob(df: DataFrame, person: str = "linkage_PID") -> DataFrame:
    """``h_dob``: the person's most frequent date of birth; ties repeat the rows."""
    best = modal_values(df, person, "dob", "agency", AUTHORITIES).drop("n")
    return join_values(df, best, [person], "left")


def housing_table(
    merged: DataFrame, cut_off: str = CUT_OFF, clusters: bool = True, order: str | None = None
) -> DataFrame:
    """The spell table of all linked people from 2004 on.

    ``merged`` comes from :func:`plans.agencies.merge_agencies`. Same-day spells are ordered by
    ``order`` (a unique whole number), or else by all columns.
    """
    df = add_household_clusters(merged) if clusters else merged
    df = usable_spells(with_modal_dob(df))
    # Numbering also fixes the table, which the stages below read several times.
    place = "__place"
    df = number_rows(df, [order, "h_dob"] if order else df.columns, place)
    df = describe_households(df)
    return spell_history(df, place, cut_off=cut_off).drop(place)
