"""Registered queries against their SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from hearthline import catalog

FOLDER = contract.FLAGSHIP_FOLDER
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")

QUICK = [
    "dedup_keep_last", "folder_union_order", "unknown_codes", "date_coerce", "group_filter", "name_exclude",
    "refused_filter", "stage_widen", "income_max", "type_stage_pivot", "destination_lookup", "project_lookup",
    "ssn_quality", "dob_quality", "sequential_ids", "resolve_time", "resolve_code", "dob_sanity", "modal_value",
    "assemble", "block_match", "date_compare", "time_co_occurrence", "household_types", "spell_history",
    "merged_agencies", "date_forms", "stage_widen_hot", "block_match_qgram", "block_match_cosine", "block_match_damerau",
]


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in os.listdir(FOLDER):
        db.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return db


def plain(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER)
    want = duck.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.columns, map(tuple, got.collect())) == plain(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
