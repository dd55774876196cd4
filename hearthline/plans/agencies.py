"""Identity preparation, linking and harmonising of the two agencies' extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import (
    gender_from_code,
    gender_from_word,
    race_flag,
    ssn_length_quality,
    ssn_repeat_quality,
    ssn_text,
    upper_or_null,
    usable_ssn,
)
from ..functions.nulls import if3, paste
from ..operators.cleaning import exclude_refused
from ..operators.identity import (
    date_parts,
    frequent_or_odd_dates,
    grade_dates,
    with_sequential_id,
)
from ..operators.joins import merge_on

# How often a date of birth must occur to be a placeholder.
PHA_FREQUENT = 64
HMIS_FREQUENT = 81

# Source column of each identity column.
PHA_IDENTITY = {
    "pid0": "pid0", "ssn": "ssn_id_m6", "lname": "lname_new_m6", "fname": "fname_new_m6",
    "mname": "mname_new_m6", "suf": "lnamesuf_new_m6", "dob": "dob", "gen": "gender2",
}
HMIS_IDENTITY = {
    "pid0": "pid0", "ssn": "SSN", "ssn_dq": "SSNDataQuality", "lname": "LastName",
    "fname": "FirstName", "mname": "MiddleName", "suf": "NameSuffix", "dob": "DOB",
    "gen": "Gender",
}
NAMES = ("lname", "fname", "mname", "suf")


def _identity_rows(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The distinct identity rows with typed dates."""
    picked = df.select(*[F.col(src).alias(new) for new, src in columns.items()]).distinct()
    return picked.withColumn("dob", F.col("dob").try_cast("date"))


def _finish(df: DataFrame, bad: DataFrame, prefix: str) -> DataFrame:
    df = with_sequential_id(date_parts(df, "dob", "dob"), df.columns, "pid1", prefix)
    df = grade_dates(df, "dob", bad)
    blank = [c for c, kind in df.dtypes if kind == "string"]
    upper = {c: upper_or_null(F.col(c)) for c in NAMES}
    rest = {c: F.nullif(F.col(c), F.lit("")) for c in blank if c not in NAMES}
    return df.withColumns(upper | rest)


def prepare_pha(pha: DataFrame, frequent: int = PHA_FREQUENT) -> DataFrame:
    """Identity rows of the housing authorities."""
    dates = pha.select(F.col("dob").try_cast("date").alias("dob"))
    df = _identity_rows(pha, PHA_IDENTITY)
    df = df.withColumns(
        {"gen": gender_from_word(F.col("gen"), 1, 0), "ssn": ssn_text(F.col("ssn").cast("string"))}
    )
    df = df.withColumn("ssn_dq", ssn_length_quality(F.col("ssn")))
    return _finish(df, frequent_or_odd_dates(dates, "dob", frequent), "pha1_")


def prepare_hmis(hmis: DataFrame, frequent: int = HMIS_FREQUENT) -> DataFrame:
    """Identity rows of the homeless-services source."""
    dates = hmis.select(F.col("DOB").try_cast("date").alias("dob"))
    df = _identity_rows(hmis, HMIS_IDENTITY)
    quality = F.col("ssn_dq").try_cast("int")
    df = df.withColumns(
        {
            "ssn": ssn_text(F.col("ssn").cast("string")),
            "ssn_dq": if3(quality > 2, F.lit(3), quality),
            "gen": F.col("gen").try_cast("int"),
        }
    )
    return _finish(df, frequent_or_odd_dates(dates, "dob", frequent), "hmis1_")


def prelink(
    pha: DataFrame,
    hmis: DataFrame,
    pha_frequent: int = PHA_FREQUENT,
    hmis_frequent: int = HMIS_FREQUENT,
    codebook: bool = False,
) -> DataFrame:
    """Both sources' identity rows with quality grades and usable values, ready for linking.

    ``pid2`` numbers the rows, the housing authorities' first. ``codebook`` grades a missing
    number 3 instead of null.
    """
    both = prepare_pha(pha, pha_frequent).unionByName(
        prepare_hmis(hmis, hmis_frequent), allowMissingColumns=True
    )
    both = both.withColumn(
        "ssn_dq", ssn_repeat_quality(F.col("ssn"), F.col("ssn_dq"), codebook)
    )
    both = both.withColumn("__second", F.col("pid1").startswith("hmis"))
    both = both.withColumn("__len", F.length("pid1"))
    both = with_sequential_id(both, ["__second", "__len", "pid1"], "pid2", "pid2_")
    both = both.drop("__second", "__len").withColumns(
        {
            "ssn1": usable_ssn(F.col("ssn"), F.col("ssn_dq")),
            "dob1": if3(F.col("dob_dq") == 1, F.col("dob"), F.lit(None).cast("date")),
        }
    )
    return exclude_refused(date_parts(both, "dob1", "dob1"), ["lname", "fname"])


def harmonise_hmis(hmis: DataFrame) -> DataFrame:
    """The homeless-services rows in the common schema."""
    day = {c: F.col(c).try_cast("date") for c in ("EntryDate", "ExitDate", "DOB")}
    return hmis.select(
        "pid0",
        paste(F.lit("HMIS_"), F.col("HouseholdID")).alias("hh_id"),
        F.col("RelationshipToHoH").cast("string").alias("relcode"),
        F.col("LastName").alias("lname"),
        F.col("FirstName").alias("fname"),
        F.col("MiddleName").alias("mname"),
        gender_from_code(F.col("Gender").try_cast("int")).alias("gender"),
        day["DOB"].alias("dob"),
        *[
            F.col(src).try_cast("int").alias(new)
            for new, src in (
                ("r_aian", "AmIndAKNative"),
                ("r_asian", "Asian"),
                ("r_black", "BlackAfAmerican"),
                ("r_nhpi", "NativeHIOtherPacific"),
                ("r_white", "White"),
                ("r_ethnicity", "Ethnicity"),
            )
        ],
        day["EntryDate"].alias("entry"),
        day["ExitDate"].alias("exit"),
        F.lit("HMIS").alias("agency"),
        F.col("ProjectType").alias("hmis_proj_type"),
        F.col("ProjectName").alias("hmis_proj_name"),
    )


def harmonise_pha(pha: DataFrame) -> DataFrame:
    """The housing authorities' rows in the common schema."""
    race = F.col("race_new")
    flags = [
        race_flag(F.col(f"r_{key}_new").try_cast("int"), race, only).alias(f"r_{key}")
        for key, only in (
            ("aian", "AIAN only"),
            ("asian", "Asian only"),
            ("black", "Black only"),
            ("nhpi", "NHPI only"),
            ("white", "White only"),
        )
    ]
    return pha.select(
        "pid0",
        paste(F.col("agency_new"), F.col("hh_id_new"), sep="_").alias("hh_id"),
        F.col("relcode").cast("string").alias("relcode"),
        F.col("lname_new").alias("lname"),
        F.col("fname_new").alias("fname"),
        F.col("mname_new").alias("mname"),
        gender_from_word(F.col("gender2"), "Fem", "Mal").alias("gender"),
        F.col("dob").try_cast("date").alias("dob"),
        *flags,
        if3(race == "Multiple race", F.lit(1), F.lit(0)).alias("r_multi"),
        F.col("r_hisp_new").try_cast("int").alias("r_ethnicity"),
        F.col("disability2").alias("disability"),
        F.col("startdate").try_cast("date").alias("entry"),
        F.col("enddate").try_cast("date").alias("exit"),
        F.col("agency_new").alias("agency"),
        F.col("major_prog").alias("ha_maj_prog"),
        F.col("prog_type").alias("ha_prog_type"),
        F.col("subsidy_type").alias("ha_sub_type"),
        F.col("vouch_type_final").alias("ha_vouch_type"),
        F.col("operator_type").alias("ha_op_type"),
        F.col("portfolio_final").alias("ha_portfolio"),
    )


def program_categories(df: DataFrame, authorities: Sequence[str] = ("KCHA", "SHA")) -> DataFrame:
    """``ha_prog_cat`` and ``hmis_prog_cat``: comma-joined program texts, missing parts "NA"."""
    ha = paste(
        *[F.col(c) for c in ("agency", "ha_sub_type", "ha_vouch_type", "ha_op_type", "ha_portfolio")],
        sep=",",
    )
    hmis = paste(F.col("agency"), F.col("hmis_proj_type"), F.col("hmis_proj_name"), F.lit(""), sep=",")
    agency = F.col("agency")
    return df.withColumns(
        {
            "ha_prog_cat": F.when(agency.isin(list(authorities)), ha),
            "hmis_prog_cat": F.when(agency == "HMIS", hmis),
        }
    )


def merge_agencies(hmis: DataFrame, pha: DataFrame, links: DataFrame) -> DataFrame:
    """Both sources in one table with the person numbers of the links; repeated links repeat rows."""
    both = harmonise_hmis(hmis).unionByName(harmonise_pha(pha), allowMissingColumns=True)
    keys = links.select("pid0", "pid1", "pid2", "linkage_PID")
    return program_categories(merge_on(both, keys, "pid0", "pid0"))
