import pytest
from helpers import day, moment, rows
from pyspark.sql import functions as F

from hearthline.operators import skew, widen
from hearthline.operators.lookup import merge_destination, merge_project_type
from hearthline.operators.reconcile import resolve_person_values
from hearthline.plans import enrollment
from hearthline.plans.enrollment import (
    Extracts,
    get_client,
    get_disabilities,
    get_employment_education,
    get_exit,
    get_health_dv,
    get_income,
    get_project,
    merge_tables,
    stage_counts,
)
from hearthline.sources.codes import DESTINATIONS

STAGES = {
    "collection_stage_column": "stage", "entry_stage_val": 0, "exit_stage_val": 1,
    "update_stage_val": 2, "annual_assessment_stage_val": 5, "post_exit_stage_val": 6,
}


def one_table(spark, folders, table, lines, spec):
    root = folders({"2011": {"t.csv": lines}})
    return Extracts(spark, files={table: {"2011": f"{root}/2011/t.csv"}}, specs={table: spec})


@pytest.mark.parametrize(
    "table,read",
    [("employment_education", get_employment_education), ("health_dv", get_health_dv)],
)
def test_entry_exit(spark, folders, table, read):
    spec = dict(STAGES, person_enrollment_ID="id", duplicate_check_columns=["id", "stage", "value"],
                categorical_var=["value"])
    lines = ["id,stage,value", "11,0,0", "11,1,1", "12,0,0", "12,2,1", "12,,1"]
    got = read(one_table(spark, folders, table, lines, spec))
    assert rows(got, "id", "value_entry", "value_exit") == [(11, 0, 1), (12, 0, None)]
    with pytest.raises(ValueError):
        read(one_table(spark, folders, table, lines, {"person_enrollment_ID": "id"}))


def test_split_rows_to_columns(spark):
    data = [(1, "a", 10), (1, "b", 11), (1, "b", 12), (None, "a", 20), (None, "b", 21), (2, None, 5)]
    df = spark.createDataFrame(data, "k int, c string, v int")
    got = widen.split_rows_to_columns(df, "c", {"a": "_a", "b": "_b"}, "k")
    assert rows(got, "k", "v_a", "v_b") == [(None, 20, 21), (1, 10, 11), (1, 10, 12)]
    with pytest.raises(KeyError):
        widen.split_rows_to_columns(df, "c", {"a": "_a"}, "k")
    with pytest.raises(TypeError):
        widen.split_rows_to_columns(df, ["c"], {"a": "_a"}, "k")
    only = df.filter("c = 'a'")
    assert widen.split_rows_to_columns(only, "c", {"a": "_a", "b": "_b"}, "k").columns == ["k", "v_a"]


def test_pivot_equals_joins_when_unique(spark):
    df = spark.range(200).select(
        (F.col("id") / 5).cast("int").alias("k"), (F.col("id") % 3).cast("int").alias("c"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"),
    ).dropDuplicates(["k", "c"])
    suffixes = {0: "_x", 1: "_y", 2: "_z"}
    slow = widen.split_rows_to_columns(df, "c", suffixes, "k")
    fast = widen.pivot_unique(df, "c", suffixes, "k")
    columns = ["k", "v_x", "v_y", "v_z"]
    assert rows(slow, *columns) == rows(fast, *columns)


def test_exit_and_destination(spark, folders):
    spec = {"person_enrollment_ID": "id", "destination_column": "dest",
            "duplicate_check_columns": ["id"], "categorical_var": ["dest"]}
    source = one_table(spark, folders, "exit", ["id,dest", "1,3", "2,12", "3,99", "4,77"], spec)
    got = get_exit(source)
    assert "dest" not in got.columns
    assert rows(got, "id", "DestinationNumeric", "DestinationGroup", "Subsidy") == [
        (1, 3, "Permanent", True), (2, 12, "Temporary", False), (3, None, None, None),
        (4, None, None, None),
    ]
    assert len({d[0] for d in DESTINATIONS}) == len(DESTINATIONS)


def test_destination_file(spark, folders):
    root = folders({"m": {"map.csv": [
        "Standard,DestinationNumeric,DestinationDescription,DestinationGroup,DestinationSuccess,Subsidy",
        "New Standards,1.0,shelter,Temporary,Other Exit,No",
        "New Standards,2.0,rental,Permanent,Successful Exit,Yes",
        "Old Standards,1.0,old,Other,Other Exit,Yes",
    ]}})
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, d int")
    got = merge_destination(df, "d", f"{root}/m/map.csv")
    assert rows(got, "id", "DestinationDescription", "Subsidy") == [
        (1, "shelter", False), (2, "rental", True), (3, None, None)]


def test_project(spark, folders):
    spec = {"program_ID": "pid", "project_type_column": "ProjectType",
            "duplicate_check_columns": ["pid"]}
    source = one_table(spark, folders, "project", ["pid,name,ProjectType", "3,a,1", "4,b,13", "5,c,70"], spec)
    got = get_project(source)
    assert rows(got, "pid", "name", "ProjectNumeric", "ProjectType") == [
        (3, "a", 1, "Emergency Shelter"), (4, "b", 13, "PH - Rapid Re-Housing"), (5, "c", None, None)]
    df = spark.createDataFrame([(None,), (2,)], "t int")
    assert rows(merge_project_type(df, "t")) == [(None, None), (2, "Transitional Housing")]


CLIENT_SPEC = {
    "person_ID": "guest", "duplicate_check_columns": ["guest", "born", "called"],
    "categorical_var": ["insured", "origin"], "time_var": ["born", "noted"],
    "boolean": ["insured"], "numeric_code": ["origin"], "dob_column": "born",
    "name_columns": ["called"],
}

# Per person: the rows of each of two folders (born, noted, insured, origin) and what comes out.
GUESTS = {
    # Two births stay; the notes lie close and meet halfway; a yes outweighs a no; one known code.
    ("31", "Imre"): ([("1971-03-02", "2009-05-10", 1, 9)], [("1971-03-22", "2009-05-14", 0, 4)],
                     {("1971-03-02", "2009-05-12", 1, 4), ("1971-03-22", "2009-05-12", 1, 4)}),
    # The same row twice but for an unknown flag: one row.
    ("32", "Juno"): ([("1988-12-24", "2010-01-05", 8, 2)], [("1988-12-24", "2010-01-05", 0, 2)],
                     {("1988-12-24", "2010-01-05", 0, 2)}),
    # Two different codes tell nothing.
    ("33", "Kosma"): ([("1990-07-07", "2011-07-07", 1, 5)], [("1990-07-07", "2011-07-07", 1, 3)],
                      {("1990-07-07", "2011-07-07", 1, None)}),
    # Only in the second folder.
    ("34", "Livia"): ([], [("2001-10-30", "2012-02-29", 0, 1)], {("2001-10-30", "2012-02-29", 0, 1)}),
    # Notes more than a year apart, and no flag at all.
    ("35", "Mirko"): ([("1963-04-09", "2008-01-20", 99, 6)], [("1964-04-09", "2010-03-20", 9, 6)],
                      {("1963-04-09", None, None, 6), ("1964-04-09", None, None, 6)}),
    # A missing birth and note beside known ones.
    ("36", "Nele"): ([("1955-08-18", "2011-11-11", 0, 8)], [("", "", 0, 9)],
                     {("1955-08-18", "2011-11-11", 0, None), (None, "2011-11-11", 0, None)}),
    # No usable name.
    ("37", "anonymous"): ([("1979-01-31", "2009-09-09", 1, 7)], [], {("1979-01-31", "2009-09-09", 1, 7)}),
}


@pytest.mark.parametrize("name_exclusion", [False, True])
def test_client(spark, folders, name_exclusion):
    header = "guest,called,born,noted,insured,origin"
    lines = lambda k: [header] + [
        ",".join(map(str, (*who, *row))) for who, parts in GUESTS.items() for row in parts[k]]
    root = folders({"east": {"g.csv": lines(0)}, "west": {"g.csv": lines(1)}})
    files = {y: f"{root}/{y}/g.csv" for y in ("east", "west")}
    source = Extracts(spark, files={"client": files}, specs={"client": CLIENT_SPEC})
    got = get_client(source, name_exclusion)
    want = [(int(who[0]), moment(d), moment(t), flag, code)
            for who, parts in GUESTS.items() for d, t, flag, code in parts[2]
            if not (name_exclusion and who[1] == "anonymous")]
    assert set(rows(got, "guest", "born", "noted", "insured", "origin")) == set(want)
    assert got.count() == len(want)


def test_client_needs_a_person(spark, folders):
    spec = {k: v for k, v in CLIENT_SPEC.items() if k != "person_ID"}
    with pytest.raises(ValueError):
        get_client(one_table(spark, folders, "client", ["guest", "31"], spec))


def test_codes_that_agree_beside_a_null_are_still_dropped(spark):
    df = spark.createDataFrame(
        [(1, 5, None), (1, 5, None), (1, None, None), (2, 6, 1), (2, 6, 0), (3, None, 1), (3, 4, None),
         (None, 1, 1), (None, 2, 0)], "p int, code int, flag int")
    got = resolve_person_values(df, "p", flags=["flag"], codes=["code"])
    assert rows(got) == [(None, 1, 1), (None, 2, 0)] + [(1, None, None)] * 3 + [
        (2, 6, 1), (2, 6, 1), (3, 4, 1), (3, 4, 1)]


def test_midpoint_limits(spark):
    df = spark.createDataFrame(
        [(1, day("2001-01-01")), (1, day("2001-12-31")), (2, day("2001-01-01")), (2, day("2002-01-01")),
         (3, day("2001-01-01")), (3, day("2001-01-04")), (3, None)], "p int, t date")
    got = resolve_person_values(df, "p", times=["t"])
    assert sorted(set(rows(got)), key=str) == [
        (1, day("2001-07-02")), (2, None), (3, day("2001-01-02"))]


NEED_SPEC = dict(STAGES, entry_stage_val=3, exit_stage_val=4, update_stage_val=5,
                 type_column="need", response_column="told", person_enrollment_ID="stay",
                 categorical_var=["told"], duplicate_check_columns=["stay", "stage", "need"])


def test_disabilities(spark, folders):
    """Needs 5 and 6 by stay at entry (3) and exit (4); 9 is unknown; stays without both stages vanish."""
    told = {601: {3: (1, 0), 4: (1, 1)}, 602: {3: (9, 1), 4: (0, 0)}, 603: {3: (0, None)}, 604: {4: (None, 1)}}
    lines = ["stay,stage,need,told"] + [
        f"{stay},{stage},{need},{x}" for stay, stages in told.items() for stage, pair in stages.items()
        for need, x in zip((5, 6), pair) if x is not None]
    source = one_table(spark, folders, "disabilities", lines, NEED_SPEC)
    columns = ["stay", "Physical_entry", "Physical_exit", "Developmental_entry", "Developmental_exit"]
    known = lambda x: None if x == 9 else x
    want = [(stay, known(s[3][0]), s[4][0], s[3][1], s[4][1]) for stay, s in told.items() if len(s) == 2]
    for unique in (None, False):
        assert rows(get_disabilities(source, unique=unique), *columns) == want
    with pytest.raises(ValueError):
        get_disabilities(one_table(spark, folders, "disabilities", lines, {"person_enrollment_ID": "stay"}))


def test_disabilities_repeated_responses_multiply(spark):
    data = [(1, 1, 5, 0), (1, 1, 5, 1), (1, 3, 5, 0), (1, 3, 6, 1)]
    df = spark.createDataFrame(data, "id int, s int, t int, r int")
    got = widen.widen_typed_responses(df, "id", "s", {1: "_entry", 3: "_exit"}, "t", "r",
                                      {5: "P", 6: "D"})
    assert rows(got, "id", "P_entry", "P_exit", "D_exit") == [(1, 0, 0, 1), (1, 1, 0, 1)]


def test_typed_paths_agree(spark):
    df = spark.range(600).select(
        F.expr("nullif(pmod(xxhash64(id), 40), 0)").cast("int").alias("id"),
        F.expr("if(pmod(xxhash64(id, 1), 2) = 0, 1, 3)").alias("s"),
        F.expr("nullif(pmod(xxhash64(id, 2), 5) + 4, 4)").cast("int").alias("t"),
        F.expr("nullif(pmod(xxhash64(id, 3), 3), 2)").cast("int").alias("r"),
    ).dropDuplicates(["id", "s", "t"]).cache()
    args = ("id", "s", {1: "_entry", 3: "_exit"}, "t", "r", {5: "A", 6: "B", 7: "C", 8: "D"})
    slow = widen.widen_typed_responses(df, *args)
    fast = widen.widen_typed_responses(df, *args, unique=True)
    columns = sorted(slow.columns)
    assert sorted(fast.columns) == columns and slow.count() > 10
    assert rows(slow, *columns) == rows(fast, *columns)


WAGE_SPEC = dict(STAGES, person_enrollment_ID="stay", categorical_var=["paid"],
                 duplicate_check_columns=["stay", "stage", "paid", "wage"], columns_to_take_max=["paid", "wage"])


def test_income(spark, folders):
    """The highest of several answers of a stay at each stage."""
    answers = {801: {0: [(0, 40), (1, 25), (1, 70)], 1: [(0, 0)]}, 802: {0: [("", 15)], 1: [(1, 90), ("", 120)]}}
    lines = ["stay,stage,paid,wage"] + [
        f"{stay},{stage},{p},{w}" for stay, stages in answers.items() for stage, xs in stages.items() for p, w in xs]
    source = one_table(spark, folders, "income", lines, WAGE_SPEC)
    top = lambda xs, i: max((x[i] for x in xs if x[i] != ""), default=None)
    want = [(stay, top(a[0], 0), top(a[1], 0), top(a[0], 1), top(a[1], 1)) for stay, a in answers.items()]
    assert rows(get_income(source), "stay", "paid_entry", "paid_exit", "wage_entry", "wage_exit") == want
    with pytest.raises(ValueError):
        get_income(one_table(spark, folders, "income", lines, dict(STAGES, person_enrollment_ID="stay")))


def test_collapse_keeps_first_of_other_columns(spark):
    data = [(1, 5, None, 1), (1, 9, "b", 2), (None, 1, "x", 3), (None, 7, "y", 4)]
    df = spark.createDataFrame(data, "k int, m int, o string, ord int")
    with pytest.warns(UserWarning):
        got = widen.collapse_to_max(df, "k", ["m"], ["ord"])
    assert rows(got, "k", "m", "o") == [(None, 1, "x"), (1, 9, None)]


# Stays of five guests: (guest, stay, shelter, family, from, to, destination, kind of shelter, births with what
# comes out, sex, served, name, needs, works, health and wage at entry and exit).
STAYS = [
    (501, 9001, 61, 77, "2015-02-03", "2015-04-30", 3, 2, ["1981-05-06"], "1981-05-06", 1, 0, "Ada", (0, 1), (1, 1), (2, 3), (0, 250)),
    (502, 9002, 62, 78, "2015-03-15", "2015-09-01", 27, 13, ["1969-02-11", "2016-02-11"], "1969-02-11", 0, 1, "Bruno", (1, 1), (0, 1), (1, 1), (90, 80)),
    (503, 9003, 61, 78, "2015-05-20", "2015-05-28", 10, 2, ["1990-09-01", "1993-09-01"], None, 1, 1, "Cleo", (0, 0), (0, 0), (3, 2), (700, 0)),
    (504, 9004, 63, 79, "2015-08-08", "2016-01-02", 12, 1, ["1975-11-10", "1975-11-14"], "1975-11-12", 0, 0, "refused", (1, 0), (1, 0), (2, 2), (15, 16)),
    (505, 9005, 63, 80, "2015-12-31", "2016-02-20", 20, 1, ["1820-01-01", "1948-06-30"], "1948-06-30", 1, 0, "Dario", (0, 0), (0, 1), (1, 2), (5, 4)),
]


def by_stage(header, place):
    return [header] + [f"{s[1]},{stage},{s[place][stage]}" for s in STAYS for stage in (0, 1)]


MERGE_FILES = {
    "Enrollment.csv": ["guest,stay,shelter,family,since"] + [",".join(map(str, s[:5])) for s in STAYS],
    "Exit.csv": ["stay,goes_to,until"] + [f"{s[1]},{s[6]},{s[5]}" for s in STAYS],
    "Client.csv": ["guest,born,sex,served,called"] + [f"{s[0]},{b},{s[10]},{s[11]},{s[12]}" for s in STAYS for b in s[8]],
    "Disabilities.csv": ["stay,stage,need,told"] + [f"{s[1]},{k},5,{s[13][k]}" for s in STAYS for k in (0, 1)],
    "EmploymentEducation.csv": by_stage("stay,stage,works", 14),
    "HealthAndDV.csv": by_stage("stay,stage,health", 15),
    "IncomeBenefits.csv": by_stage("stay,stage,wage", 16),
    "Project.csv": ["shelter,kind"] + [f"{a},{b}" for a, b in sorted({(s[2], s[7]) for s in STAYS if s[2] != 62} | {(62, 13)})],
}
MERGE_SPECS = {
    "enrollment": {"person_enrollment_ID": "stay", "person_ID": "guest", "program_ID": "shelter", "groupID_column": "family",
                   "time_var": ["since"], "duplicate_check_columns": ["guest", "stay", "shelter", "family"],
                   "entry_date": "since"},
    "exit": {"person_enrollment_ID": "stay", "destination_column": "goes_to", "duplicate_check_columns": ["stay"],
             "time_var": ["until"]},
    "client": {"person_ID": "guest", "dob_column": "born", "time_var": ["born"], "categorical_var": ["sex", "served"],
               "boolean": ["served"], "numeric_code": ["sex"], "duplicate_check_columns": ["guest", "born"],
               "name_columns": ["called"]},
    "disabilities": dict(STAGES, person_enrollment_ID="stay", categorical_var=["told"], type_column="need",
                         response_column="told", duplicate_check_columns=["stay", "stage", "need"]),
    "employment_education": dict(STAGES, person_enrollment_ID="stay", categorical_var=["works"],
                                 duplicate_check_columns=["stay", "stage"]),
    "health_dv": dict(STAGES, person_enrollment_ID="stay", categorical_var=["health"],
                      duplicate_check_columns=["stay", "stage"]),
    "income": dict(STAGES, person_enrollment_ID="stay", categorical_var=["wage"], columns_to_take_max=["wage"],
                   duplicate_check_columns=["stay", "stage"]),
    "project": {"program_ID": "shelter", "project_type_column": "kind", "duplicate_check_columns": ["shelter"]},
}


@pytest.mark.parametrize("name_exclusion", [False, True])
def test_merge_tables(spark, folders, name_exclusion):
    root = folders({"all": MERGE_FILES})
    source = Extracts(spark, data_dir=root, paths=["all"], specs=MERGE_SPECS)
    got = merge_tables(source, groups=False, name_exclusion=name_exclusion)
    columns = ["guest", "called", "stay", "family", "since", "until", "DestinationNumeric", "born", "sex", "served",
               "Physical_entry", "Physical_exit", "works_entry", "works_exit", "health_entry", "health_exit",
               "wage_entry", "wage_exit", "ProjectNumeric"]
    assert set(got.columns) == {*columns, "shelter", "DestinationDescription", "DestinationGroup",
                                "DestinationSuccess", "Subsidy", "ProjectType"}
    want = [(s[0], s[12], s[1], s[3], moment(s[4]), moment(s[5]), s[6], moment(s[9]), s[10], s[11], *s[13], *s[14], *s[15],
             *s[16], s[7]) for s in STAYS if not (name_exclusion and s[12] == "refused")]
    assert rows(got, *columns) == want
    groups = {d[0]: (d[2], d[4]) for d in DESTINATIONS}
    assert all((r["DestinationGroup"], r["Subsidy"]) == groups[r["DestinationNumeric"]] for r in got.collect())


def test_stage_counts(spark, folders):
    root = folders({"all": MERGE_FILES})
    source = Extracts(spark, data_dir=root, paths=["all"], specs=MERGE_SPECS)
    assert dict(rows(stage_counts(source, groups=False))) == {
        "enrollment": 5, "exit": 5, "client": 9, "bad_dob": 2, "disabilities": 5,
        "employment_education": 5, "health_dv": 5, "income": 5, "project": 3}


def test_files_are_not_read_again_for_hot_keys(spark, folders, monkeypatch):
    """The tables that hot keys are looked for in are fixed before, as their rows are read again."""
    source = Extracts(spark, data_dir=folders({"all": MERGE_FILES}), paths=["all"], specs=MERGE_SPECS)
    find, plans = skew.find_hot_key_sets, []

    def looked(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return find(df, *args)

    for module in (skew, enrollment):
        monkeypatch.setattr(module, "find_hot_key_sets", looked)
    for groups in (False, True):
        merge_tables(source, groups=groups)
    assert plans and not [p for p in plans if "csv" in p or "Join" in p and "__first" not in p]
