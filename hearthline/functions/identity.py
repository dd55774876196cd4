"""Expressions on social security numbers, genders, races and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import if3

# The eight-digit repeats nulled by clean_ssn and the nine-digit repeats
# that mark a number as unusable.
REPEATED_SSN_8 = [11111111 * i for i in range(1, 9)]
REPEATED_SSN_9 = [111111111 * i for i in range(0, 10)]

# Gender codes of the homeless-services source.
GENDER_CODES = {0: "Fem", 1: "Mal", 2: "MTF", 3: "FTM", 4: "GNC"}


def clean_ssn(ssn: Column) -> Column:
    """Null for an eight-digit number of one repeated digit 1-8."""
    return F.when(ssn.isin(REPEATED_SSN_8), F.lit(None)).otherwise(ssn)


def stringify_ssn(ssn: Column) -> Column:
    """Whole-number text of the number; leading zeros are lost, non-numbers are an error."""
    if_number = ssn.cast("double").cast("long")
    return if_number.cast("string")


def ssn_text(ssn: Column) -> Column:
    """The number as text without leading zeros; null when it is not a number."""
    return ssn.try_cast("double").try_cast("long").cast("string")


def ssn_length_quality(ssn_as_text: Column) -> Column:
    """1 for nine digits or more, 2 for fewer, 3 when missing."""
    return (
        F.when(ssn_as_text.isNull(), 3).when(F.length(ssn_as_text) < 9, 2).otherwise(1)
    )


def ssn_repeat_quality(ssn_as_text: Column, quality: Column, codebook: bool = False) -> Column:
    """3 for nine equal digits, else the quality given.

    A missing number makes the quality null; with ``codebook`` it stays 3.
    """
    repeated = ssn_as_text.try_cast("long").isin(REPEATED_SSN_9)
    graded = if3(repeated, F.lit(3), quality)
    return F.coalesce(graded, F.lit(3)) if codebook else graded


def usable_ssn(ssn_as_text: Column, quality: Column) -> Column:
    """The number when its quality is 1 and it has nine digits."""
    return if3((quality == 1) & (F.length(ssn_as_text) == 9), ssn_as_text, F.lit(None))


def gender_from_code(code: Column) -> Column:
    expr = F.lit(None).cast("string")
    for value, name in GENDER_CODES.items():
        expr = F.when(code == value, name).otherwise(expr)
    return expr


def gender_from_word(word: Column, female, male) -> Column:
    """``female``/``male`` for the words Female and Male, else null."""
    return F.when(word == "Female", F.lit(female)).when(word == "Male", F.lit(male))


def race_flag(flag: Column, race: Column, only: str) -> Column:
    """1 when the flag is set or the race text says so, 0 when neither, null when unknown."""
    return if3((flag == 1) | (race == only), F.lit(1), F.lit(0))


def upper_or_null(text: Column) -> Column:
    """Upper case; an empty text becomes null."""
    return F.nullif(F.upper(text), F.lit(""))
