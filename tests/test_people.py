"""Identity preparation, agencies, households and spells."""

import itertools
import random

import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from hearthline.functions.identity import (
    clean_ssn,
    race_flag,
    ssn_length_quality,
    ssn_repeat_quality,
    stringify_ssn,
    usable_ssn,
)
from hearthline.functions.nulls import if3, paste
from hearthline.operators.household import age_at_entry, describe_households, family_role
from hearthline.operators.identity import frequent_or_odd_dates, with_sequential_id
from hearthline.operators.reconcile import modal_values
from hearthline.operators import skew
from hearthline.operators.spells import covered_days, impute_exits, spell_history
from hearthline.plans.agencies import merge_agencies, prelink
from hearthline.plans.housing import housing_table


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_null_rules(spark):
    null = F.lit(None).cast("boolean")
    assert one(spark, if3(null, "a", "b")) is None
    assert one(spark, if3(F.lit(True), "a", "b")) == "a"
    assert one(spark, if3(F.lit(False), "a", "b")) == "b"
    assert one(spark, paste(F.lit("x"), F.lit(None), F.lit(3), sep=",")) == "x,NA,3"
    assert one(spark, race_flag(F.lit(None).cast("int"), F.lit("Asian only"), "Asian only")) == 1
    assert one(spark, race_flag(F.lit(None).cast("int"), F.lit("White only"), "Asian only")) is None
    assert one(spark, race_flag(F.lit(0), F.lit("White only"), "Asian only")) == 0


def test_ssn(spark):
    assert one(spark, clean_ssn(F.lit(11111111))) is None
    assert one(spark, clean_ssn(F.lit(111111111))) == 111111111
    assert one(spark, stringify_ssn(F.lit("012.0"))) == "12"
    assert one(spark, stringify_ssn(F.lit(None).cast("double"))) is None
    with pytest.raises(Exception):
        one(spark, stringify_ssn(F.lit("abc")))
    cases = {None: (3, None, None), "12345678": (2, 2, None), "123456789": (1, 1, "123456789"),
             "444444444": (1, 3, None), "0": (2, 3, None)}
    for text, (length, repeat, usable) in cases.items():
        column = F.lit(text).cast("string")
        quality = ssn_length_quality(column)
        assert one(spark, quality) == length
        graded = ssn_repeat_quality(column, quality)
        assert one(spark, graded) == repeat
        assert one(spark, usable_ssn(column, graded)) == usable
    assert one(spark, ssn_repeat_quality(F.lit(None).cast("string"), F.lit(3), codebook=True)) == 3


def test_frequent_or_odd_dates(spark):
    data = ["1899-12-31", "1900-01-01", "2018-12-31", "2019-01-01"] + ["1990-01-01"] * 3 + ["1991-01-01"] * 2
    df = spark.createDataFrame([(day(d),) for d in data] + [(None,)] * 5, "dob date")
    assert rows(frequent_or_odd_dates(df, "dob", 3), "dob") == [
        (day("1899-12-31"),), (day("1990-01-01"),), (day("2019-01-01"),)]


def test_sequential_ids_are_not_cut(spark):
    df = spark.range(999_998, 1_000_002).withColumn("id", F.col("id"))
    got = with_sequential_id(df, ["id"], "pid", "p_")
    assert [r["pid"] for r in got.orderBy("id").collect()] == ["p_000001", "p_000002", "p_000003", "p_000004"]
    from hearthline.operators.identity import padded_id
    assert one(spark, padded_id(F.lit(12345678), "p_")) == "p_12345678"


PHA_COLUMNS = ["pid0", "ssn_id_m6", "lname_new_m6", "fname_new_m6", "mname_new_m6", "lnamesuf_new_m6", "dob", "gender2",
               "lname_new", "fname_new", "mname_new", "race_new", "r_aian_new", "r_asian_new", "r_black_new",
               "r_nhpi_new", "r_white_new", "r_hisp_new", "agency_new", "hh_id_new", "relcode", "startdate", "enddate",
               "disability2", "major_prog", "prog_type", "subsidy_type", "vouch_type_final", "operator_type",
               "portfolio_final"]
HMIS_COLUMNS = ["pid0", "SSN", "SSNDataQuality", "LastName", "FirstName", "MiddleName", "NameSuffix", "DOB", "Gender",
                "HouseholdID", "RelationshipToHoH", "AmIndAKNative", "Asian", "BlackAfAmerican", "NativeHIOtherPacific",
                "White", "Ethnicity", "EntryDate", "ExitDate", "ProjectType", "ProjectName"]


def extract(spark, columns, *records):
    data = [tuple(r.get(c) for c in columns) for r in records]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))


@pytest.fixture(scope="module")
def agencies(spark):
    pha = extract(
        spark, PHA_COLUMNS,
        {"pid0": "PHA0_1", "ssn_id_m6": "123456789", "lname_new_m6": "smith", "fname_new_m6": "al", "mname_new_m6": "",
         "dob": "1980-05-01", "gender2": "Female", "race_new": "Asian only", "agency_new": "SHA", "hh_id_new": "7",
         "relcode": "H", "startdate": "2005-01-01", "enddate": "2006-01-01", "subsidy_type": "HCV",
         "lname_new": "smith"},
        {"pid0": "PHA0_1", "ssn_id_m6": "123456789", "lname_new_m6": "smith", "fname_new_m6": "al", "mname_new_m6": "",
         "dob": "1980-05-01", "gender2": "Female", "agency_new": "KCHA", "startdate": "2007-01-01", "relcode": "H"},
        {"pid0": "PHA0_2", "lname_new_m6": "refused", "fname_new_m6": "x", "dob": "1890-05-01", "agency_new": "SHA"},
        {"pid0": "PHA0_3", "ssn_id_m6": "012345678", "lname_new_m6": "doe", "fname_new_m6": "jo", "dob": "1890-05-01",
         "gender2": "Other", "agency_new": "SHA"},
    )
    hmis = extract(
        spark, HMIS_COLUMNS,
        {"pid0": "HMIS0_1", "SSN": "123456789", "SSNDataQuality": "1", "LastName": "Smith", "FirstName": "Al",
         "DOB": "1980-05-01", "Gender": "0", "HouseholdID": "3", "RelationshipToHoH": "1", "EntryDate": "2006-03-01",
         "ProjectType": "Emergency Shelter", "ProjectName": "Hope"},
        {"pid0": "HMIS0_2", "SSN": "999999999", "SSNDataQuality": "99", "LastName": "Roe", "FirstName": "Di",
         "DOB": "bad", "Gender": "4", "EntryDate": "2006-03-01"},
    )
    return pha, hmis


def test_prelink(agencies):
    got = prelink(*agencies, pha_frequent=64, hmis_frequent=81)
    table = rows(got, "pid2", "pid0", "pid1", "ssn", "ssn_dq", "ssn1", "lname", "mname", "gen", "dob_dq", "dob1")
    assert table == [
        ("pid2_000001", "PHA0_1", "pha1_000001", "123456789", 1, "123456789", "SMITH", None, 1, 1, day("1980-05-01")),
        ("pid2_000003", "PHA0_3", "pha1_000003", "12345678", 2, None, "DOE", None, None, 2, None),
        ("pid2_000004", "HMIS0_1", "hmis1_000001", "123456789", 1, "123456789", "SMITH", None, 0, 1, day("1980-05-01")),
        ("pid2_000005", "HMIS0_2", "hmis1_000002", "999999999", 3, None, "ROE", None, 4, 1, None),
    ]
    assert rows(got.filter("pid0 = 'PHA0_1'"), "dob_y", "dob_m", "dob1_d") == [(1980, 5, 1)]


def test_merge_agencies_and_housing_table(spark, agencies):
    pha, hmis = agencies
    links = spark.createDataFrame(
        [("PHA0_1", "a", "b", 1), ("HMIS0_1", "c", "d", 1), ("HMIS0_2", "e", "f", 2), ("HMIS0_2", "e", "g", 2)],
        "pid0 string, pid1 string, pid2 string, linkage_PID int")
    merged = merge_agencies(hmis, pha, links)
    assert rows(merged, "pid0", "hh_id", "agency", "gender", "linkage_PID", "ha_prog_cat", "hmis_prog_cat") == sorted([
        ("HMIS0_1", "HMIS_3", "HMIS", "Fem", 1, None, "HMIS,Emergency Shelter,Hope,"),
        ("HMIS0_2", "HMIS_NA", "HMIS", "GNC", 2, None, "HMIS,NA,NA,"),
        ("HMIS0_2", "HMIS_NA", "HMIS", "GNC", 2, None, "HMIS,NA,NA,"),
        ("PHA0_1", "SHA_7", "SHA", "Fem", 1, "SHA,HCV,NA,NA,NA", None),
        ("PHA0_1", "KCHA_NA", "KCHA", "Fem", 1, "KCHA,NA,NA,NA,NA", None),
        ("PHA0_2", "SHA_NA", "SHA", None, None, "SHA,NA,NA,NA,NA", None),
        ("PHA0_3", "SHA_NA", "SHA", None, None, "SHA,NA,NA,NA,NA", None),
    ], key=lambda t: [(x is not None, str(x)) for x in t])
    assert rows(merged.filter("agency = 'SHA'"), "r_asian", "r_white") == [(None, None)] * 2 + [(1, None)]
    table = housing_table(merged)
    assert rows(table, "pid0", "agency", "h_cluster_ct", "h_entry", "h_exit", "h_servdays", "h_agency_trans", "h_tot_time") == [
        ("HMIS0_1", "HMIS", 1, day("2006-03-01"), day("2006-05-30"), 91, "HMIS to KCHA", 455),
        ("HMIS0_2", "HMIS", 1, day("2006-03-01"), day("2017-12-31"), 4324, "HMIS", 4323),
        ("HMIS0_2", "HMIS", 1, day("2006-03-01"), day("2017-12-31"), 4324, "HMIS to HMIS", 4323),
        ("PHA0_1", "KCHA", 1, None, None, None, "KCHA", 455),
        ("PHA0_1", "SHA", 1, day("2005-01-01"), day("2006-01-01"), 366, "SHA to HMIS", 455),
    ]


def test_modal_values_keep_ties_and_prefer_authorities(spark):
    data = [(1, "a", "SHA"), (1, "b", "HMIS"), (1, "b", "HMIS"), (2, "a", "HMIS"), (2, "b", "HMIS"),
            (3, None, "SHA"), (3, None, "KCHA"), (3, "c", "SHA"), (4, "x", None)]
    df = spark.createDataFrame(data, "p int, v string, agency string")
    got = modal_values(df, "p", "v", "agency", ["SHA", "KCHA"])
    assert rows(got) == [(1, "a", 1), (2, "a", 1), (2, "b", 1), (3, None, 2), (4, "x", 1)]


def if_else(cond, a, b):
    return None if cond is None else (a if cond else b)


def both(*conds):
    return False if False in conds else (None if None in conds else True)


def compare(value, test):
    return None if value is None else test(value)


def role_by_hand(age, relation):
    rel = compare(relation, lambda r: r in ("", "99", "D", "M", "N"))
    rel = None if rel or rel is None else relation
    child = if_else(both(compare(age, lambda a: a >= 18), compare(rel, lambda r: r == "Y")), "relcode", "no")
    for code in ("2", "F", "Y"):
        child = if_else(both(compare(age, lambda a: a < 18), compare(rel, lambda r, c=code: r == c)), "yes", child)
    old_child = both(compare(child, lambda c: c != "no"), compare(age, lambda a: a > 25))
    age = if_else(old_child, None, age)
    not_child = compare(child, lambda c: c == "no")
    unknown = if_else(both(not_child, age is None), None, "no")
    elder = if_else(both(not_child, compare(age, lambda a: a >= 62)), "yes", unknown)
    return rel, child, age, elder


def test_family_role_truth_table(spark):
    ages = [None, 10.0, 17.0, 18.0, 25.0, 26.0, 62.0]
    relations = [None, "", "Y", "F", "2", "H", "99"]
    data = [(i, a, r) for i, (a, r) in enumerate(itertools.product(ages, relations))]
    got = family_role(spark.createDataFrame(data, "i int, h_age double, relcode string"))
    by_id = {r["i"]: (r["h_relcode"], r["h_child"], r["h_age"], r["h_elder"]) for r in got.collect()}
    assert by_id == {i: role_by_hand(a, r) for i, a, r in data}


def test_age_limits(spark):
    data = [(day("2000-01-01"), day(d)) for d in ("2000-01-02", "2000-01-01", "1879-01-01", None, "1990-01-01")]
    got = age_at_entry(spark.createDataFrame(data, "entry date, h_dob date"))
    assert rows(got, "h_dob", "h_age") == [
        (None, None)] * 3 + [(day("1990-01-01"), 3652 / 365.25), (day("2000-01-01"), 0.0)]


def test_household_types(spark):
    entry = "2010-01-01"
    members = [  # household, dob, relation, disability
        ("A", "2005-01-01", "Y", None), ("A", "1980-01-01", "H", None),
        ("B", "2005-01-01", "Y", None), ("B", "1980-01-01", "H", "Disabled"), ("B", "1981-01-01", "S", None),
        ("C", "1940-01-01", "H", "Disabled"), ("D", "1980-01-01", "H", None), ("D", None, "H", None),
        ("E", "2005-01-01", "Y", None)]
    df = spark.createDataFrame([(h, day(entry), day(d), r, x) for h, d, r, x in members],
                               "hh_id string, entry date, h_dob date, relcode string, disability string")
    got = describe_households(df).select("hh_id", "h_hh_ct", "h_hh_kids", "h_hh_adults", "h_hh_type1", "h_hh_type2")
    well = "Non-elderly non-disabled household"
    assert rows(got.distinct()) == [
        ("A", 2, 1, 1, well, "single parent household with children"),
        ("B", 3, 1, 2, "Non-elderly disabled household", "multi-adult household with children"),
        ("C", 1, 0, 1, "Elderly household", "household without children"),
        # A member of unknown age who is not coded as a child counts as an adult.
        ("D", 2, 0, 2, well, "household without children"),
        ("E", 1, 1, 0, well, None)]


def test_exit_branches(spark):
    es, th = "Emergency Shelter", "Transitional Housing"
    data = [
        (1, "HMIS", th, "2010-01-01", None), (1, "HMIS", th, "2010-05-01", "2010-06-01"),  # next entry
        (2, "HMIS", th, "2010-01-01", None),  # cut-off
        (3, "HMIS", es, "2010-01-01", None), (3, "SHA", None, "2010-04-01", "2011-01-01"),  # gap of 90
        (4, "HMIS", es, "2010-01-01", None), (4, "SHA", None, "2010-03-31", "2011-01-01"),  # gap of 89
        (5, "HMIS", es, "2010-01-01", None), (5, "HMIS", es, "2010-02-01", None),  # no later exit known
        (6, "SHA", None, "2010-01-01", None), (7, "HMIS", None, "2010-01-01", "2010-02-02")]
    df = spark.createDataFrame([(i, p, a, t, day(e), day(x)) for i, (p, a, t, e, x) in enumerate(data)],
                               "ord int, linkage_PID int, agency string, hmis_proj_type string, entry date, exit date")
    got = [r["h_exit"] for r in impute_exits(df, "ord").orderBy("ord").collect()]
    assert got == [day(d) for d in ("2010-05-01", "2010-06-01", "2017-12-31", "2010-04-01", "2011-01-01", "2010-03-31",
                                    "2011-01-01", "2010-04-01", "2010-05-02", None, "2010-02-02")]


def test_covered_days_by_counting(spark):
    rng = random.Random(4)
    data = []
    for i in range(400):
        start = rng.randrange(120)
        data.append((i, rng.randrange(40), None if rng.random() < 0.1 else start,
                     None if rng.random() < 0.1 else start + rng.randrange(-3, 25)))
    df = spark.createDataFrame(data, "ord int, p int, s int, e int").select(
        "ord", "p", F.date_add(F.lit("2010-01-01").cast("date"), F.col("s")).alias("s"),
        F.date_add(F.lit("2010-01-01").cast("date"), F.col("e")).alias("e"))
    got = dict(rows(covered_days(df, ["p"], "n", "ord", "s", "e").select("p", "n").distinct()))
    want = {}
    for _, p, s, e in data:
        want.setdefault(p, set()).update(range(s, e) if s is not None and e is not None else [])
    assert got == {p: len(days) for p, days in want.items()}


def test_spell_history(spark):
    data = [  # overlap, containment, same-day entries, an exact repeat, a negative spell
        (0, 1, "SHA", "2010-01-01", "2010-12-31"), (1, 1, "HMIS", "2010-03-01", "2010-04-01"),
        (2, 1, "HMIS", "2010-03-01", "2010-04-01"), (3, 1, "KCHA", "2010-04-01", "2011-02-01"),
        (4, 2, "SHA", "2010-05-01", "2010-04-01"), (5, 2, "SHA", "2010-06-01", "2010-06-01")]
    df = spark.createDataFrame([(i, p, a, "x", day(e), day(x)) for i, p, a, e, x in data],
                               "ord int, linkage_PID int, agency string, hmis_proj_type string, entry date, exit date")
    got = spell_history(df, "ord")
    assert rows(got, "linkage_PID", "agency", "h_servdays", "h_time_qual", "h_agency_time", "h_tot_time",
                "h_agency_trans", "h_t2next_prog", "h_overlap", "h_within") == [
        (1, "HMIS", 32, 0, 31, 396, "HMIS to KCHA", 0, True, False),
        (1, "KCHA", 307, 0, 306, 396, "KCHA", None, None, None),
        (1, "SHA", 365, 0, 364, 396, "SHA to HMIS", -305, True, True),
        (2, "SHA", None, 1, 0, 0, "SHA", None, None, None),
        (2, "SHA", 1, 0, 0, 0, "SHA to SHA", None, None, None)]


def test_tasks_of_spells_grow_with_the_rows(spark, monkeypatch):
    """A task sorts about ROWS_PER_TASK rows, however well they compress."""
    df = spark.range(400).select(
        F.col("id").alias("ord"), (F.col("id") % 100).alias("linkage_PID"), F.lit("SHA").alias("agency"),
        F.lit("x").alias("hmis_proj_type"), F.date_add(F.lit("2010-01-01").cast("date"), F.col("id").cast("int")).alias("entry"),
    ).withColumn("exit", F.date_add("entry", 9))
    whole = spell_history(df, "ord")
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 20, raising=False)
    dealt = spell_history(df, "ord")
    assert dealt.rdd.getNumPartitions() == 20 and whole.rdd.getNumPartitions() == 1
    assert dealt.exceptAll(whole).isEmpty() and dealt.count() == 400
