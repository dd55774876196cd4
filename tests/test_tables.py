import pytest
from helpers import moment, rows

from hearthline.operators.cleaning import (
    coerce_times,
    exclude_names,
    exclude_refused,
    null_unknown,
    strip_bom,
)
from hearthline.operators.dedup import keep_first, keep_last
from hearthline.plans.enrollment import Extracts, get_enrollment
from hearthline.sources.spec import TableSpec
from hearthline.sources.tables import (
    apply_types,
    count_misfits,
    folder_files,
    read_table,
    resolve_files,
    scan_folders,
    write_stage,
)

# Two stays of one guest; then one stay twice, of which the later row counts. Code 9 means unknown.
STAYS = [
    "guest,arrival,note,nights,pets",
    "71,2017-10-02,x,3,9",
    "71,2018-02-17,y,11,1",
    "45,2017-12-30,z,6,0",
    "45,2017-12-30,w,2,0",
]
STAY_SPEC = {
    "columns_to_drop": ["note", "never_there"],
    "categorical_var": ["pets"],
    "time_var": ["arrival"],
    "duplicate_check_columns": ["guest", "arrival", "pets"],
}


def test_folder_files():
    assert folder_files("a.csv", "/d", ["x", "y"]) == {"x": "/d/x/a.csv", "y": "/d/y/a.csv"}
    assert list(resolve_files("a.csv", county="king")) == ["2012", "2013", "2014", "2015", "2016"]


def test_read_table(spark, folders):
    root = folders({"north": {"stays.csv": STAYS}})
    df = read_table(spark, {"north": f"{root}/north/stays.csv"}, **STAY_SPEC)
    assert df.columns == ["guest", "arrival", "nights", "pets"]
    assert rows(df) == sorted([
        (71, moment("2017-10-02"), 3, None),
        (71, moment("2018-02-17"), 11, 1),
        (45, moment("2017-12-30"), 2, 0),
    ], key=str)


def test_read_table_without_dedup(spark, folders):
    root = folders({"north": {"stays.csv": STAYS}})
    files = {"north": f"{root}/north/stays.csv"}
    assert read_table(spark, files, dedup=False).count() == 4
    with pytest.warns(UserWarning):
        assert read_table(spark, files).count() == 4


def test_load_order_prefers_the_last_but_one_folder(spark, folders):
    root = folders({y: {"t.csv": ["id,v", f"1,{y}"]} for y in ("2011", "2012", "2013")})
    df = read_table(spark, "t.csv", data_dir=root, paths=["2011", "2012", "2013"],
                    duplicate_check_columns=["id"])
    assert rows(df) == [(1, 2012)]


def test_folders_with_other_columns_and_bom(spark, folders):
    root = folders({"a": {"t.csv": ["﻿id,x", "1,5"]}, "b": {"t.csv": ["id,y", "2,a"]}})
    df = read_table(spark, "t.csv", data_dir=root, paths=["a", "b"], dedup=False)
    assert rows(df, "id", "x", "y") == [(1, 5, None), (2, None, "a")]
    assert strip_bom(spark.createDataFrame([(1,)], ["﻿id"])).columns == ["id"]


def test_quotes_and_null_texts(spark, folders):
    root = folders({"a": {"t.csv": ["id,n", '1,"say ""hi"", you"', "2,NA", "3,"]}})
    df = read_table(spark, "t.csv", data_dir=root, paths=["a"], dedup=False)
    assert rows(df) == [(1, 'say "hi", you'), (2, None), (3, None)]


@pytest.mark.parametrize(
    "args",
    [
        {"file_spec": {"a": "b"}, "data_dir": "x"},
        {"file_spec": {"a": "b"}, "paths": ["x"]},
        {"file_spec": "t.csv"},
        {"file_spec": "t.csv", "data_dir": "x"},
        {"file_spec": "t.csv", "county": ["king", "pierce"]},
    ],
)
def test_bad_arguments(args):
    with pytest.raises(ValueError):
        resolve_files(**args)


def test_keep_last_and_first_on_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (7, 3)], "k int, o int")
    assert rows(keep_last(df, ["k"], ["o"])) == [(None, 2), (7, 3)]
    assert rows(keep_first(df, ["k"], ["o"])) == [(None, 1), (7, 3)]
    with pytest.raises(ValueError):
        keep_last(df, ["missing"], ["o"])


def test_null_unknown_takes_any_number_of_codes(spark):
    df = spark.createDataFrame([("8", 1.0), ("8.0", 99.0), ("x", 3.0)], "a string, b double")
    assert rows(null_unknown(df, ["a", "b"], [8, 1])) == [(None, None), (None, 99.0), ("x", 3.0)]


def test_coerce_times(spark):
    spring = {
        "2019-04-17": "2019-04-17", "4/17/2019": "2019-04-17", "4/17/2019 0:00": "2019-04-17", " 04/17/2019 9:05:30 ": "2019-04-17T09:05:30",
        "4/17/2019 1:30 PM": "2019-04-17T13:30", "4/17/19": "2019-04-17", "17/4/2019": "2019-04-17", "20190417": "2019-04-17",
        "Apr 17, 2019": "2019-04-17", "17 Apr 2019": "2019-04-17", "4-17-2019": "2019-04-17", "2019/4/17": "2019-04-17",
        "3/4/2019": "2019-03-04", "2019": "2019-01-01", "2019-04-17 22:10:00": "2019-04-17T22:10", "nothing": None, None: None,
        "2019-13-40": None, "31/31/2019": None, "": None, "99999999": None,
    }
    df = spark.createDataFrame(list(enumerate(spring)), "i int, t string")
    got = dict(rows(coerce_times(df, ["t"])))
    assert got == {i: moment(t) for i, t in enumerate(spring.values())}


def test_types_never_cut_numbers(spark):
    texts = ["3", "3.0", "3.7", "-4.", "1e3", "1.5e1", "9007199254740993", "x", None, " 8 "]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    got = [r.a for r in apply_types(df, {"a": "bigint", "absent": "int"}).collect()]
    assert got == [3, 3, None, -4, 1000, 15, 9007199254740993, None, None, 8]
    assert count_misfits(df, {"a": "bigint"}) == {"a": 2} and count_misfits(df, {}) == {}


def test_files_of_a_folder_with_other_column_order_are_an_error(spark, folders):
    root = folders({"a": {"1.csv": ["k,v", "1,10"], "2.csv": ["v,k", "20,2"]}})
    with pytest.raises(Exception, match="(?i)header|column"):
        scan_folders(spark, {"a": f"{root}/a"}).collect()


def test_names(spark):
    names = ["Ann", "Re.fused", "CLIENT", "B", "J.", "R2", None, "...", "Zoë"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert rows(exclude_names(df, ["n"])) == [("...",), ("Ann",), ("Zoë",)]
    df = spark.createDataFrame([("REFUSED X",), ("refused",), (None,), ("ANONYMOUS",)], "n string")
    assert rows(exclude_refused(df, ["n"])) == [(None,), ("refused",)]


@pytest.mark.parametrize("groups,ids", [(True, [71, 71]), (False, [45, 71, 71])])
def test_enrollment(spark, folders, groups, ids):
    root = folders({"north": {"stays.csv": STAYS}})
    spec = dict(STAY_SPEC, groupID_column="guest", person_enrollment_ID="guest", person_ID="guest",
                program_ID="guest", entry_date="arrival")
    source = Extracts(spark, files={"enrollment": {"north": f"{root}/north/stays.csv"}},
                      specs={"enrollment": spec})
    assert sorted(r["guest"] for r in get_enrollment(source, groups).collect()) == ids


def test_spec_is_immutable_and_checks_roles():
    spec = TableSpec.from_dict({"name": "t", "time_var": ["a"], "person_ID": "p"})
    assert spec.role("person_ID") == "p" and spec.time_var == ("a",)
    with pytest.raises(ValueError):
        spec.role("dob_column")
    with pytest.raises(Exception):
        spec.name = "other"


def test_write_stage(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, n string")
    for kind in ("csv", "parquet"):
        write_stage(df, str(tmp_path / kind), kind)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 1
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["id", "n"]
    with pytest.raises(ValueError):
        write_stage(df, str(tmp_path / "x"), "xml")
