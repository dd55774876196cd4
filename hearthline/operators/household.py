"""Age, family role and household type at entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import if3, strict_count_if, strict_value
from .skew import HotKeys, find_hot_keys, with_group_values

DAYS_PER_YEAR = 365.25
OLDEST = 120
ADULT = 18
ELDER = 62
OLDEST_CHILD = 25

# Relation codes without meaning, and those of a child.
EMPTY_RELATIONS = ("", "99", "D", "M", "N")
CHILD_RELATIONS = ("Y", "F", "2")


def household_size(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """``h_hh_ct``: rows of the household with the same entry date."""
    return with_group_values(df, ["hh_id", "entry"], {"h_hh_ct": F.count(F.lit(1))}, hot)


def age_at_entry(df: DataFrame) -> DataFrame:
    """``h_age`` in years of 365.25 days; implausible ages null both age and ``h_dob``."""
    years = F.datediff("entry", "h_dob") / F.lit(DAYS_PER_YEAR)
    plausible = (years >= 0) & (years <= OLDEST)
    return df.withColumns(
        {"h_age": F.when(plausible, years), "h_dob": F.when(plausible, F.col("h_dob"))}
    )


def clean_relation(relation: Column) -> Column:
    return F.when(~relation.isin(list(EMPTY_RELATIONS)), relation)


def family_role(df: DataFrame) -> DataFrame:
    """``h_relcode``, ``h_child`` (yes, relcode, no or null), corrected ``h_age``, ``h_elder``."""
    df = df.withColumn("h_relcode", clean_relation(F.col("relcode")))
    age, relation = F.col("h_age"), F.col("h_relcode")
    child = if3((age >= ADULT) & (relation == "Y"), "relcode", "no")
    for code in reversed(CHILD_RELATIONS):
        child = if3((age < ADULT) & (relation == code), "yes", child)
    df = df.withColumn("h_child", child)
    is_child = F.col("h_child")
    df = df.withColumn(
        "h_age", if3((is_child != "no") & (age > OLDEST_CHILD), F.lit(None).cast("double"), age)
    )
    elder = if3(
        (is_child == "no") & (F.col("h_age") >= ELDER),
        "yes",
        if3((is_child == "no") & F.col("h_age").isNull(), F.lit(None).cast("string"), "no"),
    )
    return df.withColumn("h_elder", elder)


def household_type(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Children, adults and the two household types per household and entry date.

    The counts are null as soon as one member's child flag is unknown.
    """
    kids = strict_count_if(F.col("h_child") != "no")
    adults = strict_count_if(F.col("h_child") == "no")
    wide = with_group_values(
        df,
        ["hh_id", "entry"],
        {
            "__rows": kids[0],
            "__known": kids[1],
            "__kids": kids[2],
            "__adults": adults[2],
            "__elder": F.bool_or(F.col("h_elder") == "yes"),
            "__disabled": F.bool_or(F.col("disability") == "Disabled"),
        },
        hot,
    )
    n_kids = strict_value(F.col("__rows"), F.col("__known"), F.col("__kids"))
    n_adults = strict_value(F.col("__rows"), F.col("__known"), F.col("__adults"))
    wide = wide.withColumns({"h_hh_kids": n_kids, "h_hh_adults": n_adults})
    k, a = F.col("h_hh_kids"), F.col("h_hh_adults")
    type1 = (
        F.when(F.col("__elder"), "Elderly household")
        .when(F.col("__disabled"), "Non-elderly disabled household")
        .otherwise("Non-elderly non-disabled household")
    )
    type2 = (
        F.when((k > 0) & (a > 1), "multi-adult household with children")
        .when((k > 0) & (a == 1), "single parent household with children")
        .when((k == 0) & (a > 0), "household without children")
    )
    return wide.withColumns({"h_hh_type1": type1, "h_hh_type2": type2}).drop(
        "__rows", "__known", "__kids", "__adults", "__elder", "__disabled"
    )


def describe_households(df: DataFrame) -> DataFrame:
    """Size, age, role and type in one go; needs hh_id, entry, h_dob, relcode and disability."""
    hot = find_hot_keys(df, ["hh_id", "entry"])
    return household_type(family_role(age_at_entry(household_size(df, hot))), hot)
