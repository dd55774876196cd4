"""From raw yearly CSV extracts to one row per person and enrolment."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import widen
from ..operators.cleaning import exclude_names
from ..operators.dedup import keep_last
from ..operators.joins import merge_on
from ..operators.lookup import merge_destination, merge_project_type
from ..operators.reconcile import null_impossible_dob, resolve_person_values
from ..operators.skew import HotKeys, find_hot_key_sets, find_hot_keys, with_group_values
from ..session import materialise
from ..sources.codes import DISABILITY_TYPES, PROJECT_TYPES
from ..sources.hmis import DEFAULT_FILES, DEFAULT_SPECS
from ..sources.spec import STAGE_KEYS, TableSpec, code_map
from ..sources.tables import ORD, read_spec, resolve_files

# Suffixes of the entry and exit stages' columns.
ENTRY, EXIT = "_entry", "_exit"


@dataclass(frozen=True)
class Extracts:
    """Where the raw tables lie and how they are specified; gaps use the defaults.

    ``files`` maps a table to a file name (found below ``data_dir`` or the county's folder in
    every path) or to its own folder-to-file mapping.
    """

    spark: SparkSession
    county: str | None = None
    data_dir: str | None = None
    paths: Sequence[str] | None = None
    files: Mapping[str, str | Mapping] = field(default_factory=dict)
    specs: Mapping[str, TableSpec | Mapping | str] = field(default_factory=dict)
    data_root: str = "data"
    multi_line: bool = False

    def spec(self, table: str) -> TableSpec:
        return TableSpec.of(self.specs.get(table) or DEFAULT_SPECS[table])

    def read(self, table: str, spec: TableSpec | None = None) -> DataFrame:
        """The cleaned table with its load order in ``__ord``."""
        given = self.files.get(table) or DEFAULT_FILES[table]
        files = resolve_files(given, self.county, self.data_dir, self.paths, self.data_root)
        return read_spec(self.spark, files, spec or self.spec(table), self.multi_line)


def enrollment_table(source: Extracts, groups: bool = True) -> DataFrame:
    """Enrolments; with ``groups`` only those of households with more than one row."""
    spec = source.spec("enrollment")
    spec.require("groupID_column", "person_enrollment_ID", "person_ID", "program_ID", "entry_date")
    df = source.read("enrollment", spec)
    # Fixed, as its groups are read for hot keys and for rows: the files are read once.
    return group_rows(materialise(df), spec.role("groupID_column")) if groups else df


def group_rows(df: DataFrame, group: str) -> DataFrame:
    """Rows of groups with more than one row; rows without a group go."""
    known = df.filter(F.col(group).isNotNull())
    counted = with_group_values(known, [group], {"__n": F.count(F.lit(1))})
    return counted.filter("__n > 1").drop("__n")


def get_enrollment(source: Extracts, groups: bool = True) -> DataFrame:
    """The enrolment table sorted by household."""
    group = source.spec("enrollment").role("groupID_column")
    return enrollment_table(source, groups).drop(ORD).orderBy(group)


def get_exit(source: Extracts, destination_file: str | None = None) -> DataFrame:
    """Exits with the destination's description, group, outcome and subsidy."""
    spec = source.spec("exit")
    spec.require("destination_column", "person_enrollment_ID")
    df = source.read("exit", spec).drop(ORD)
    return merge_destination(df, spec.role("destination_column"), destination_file)


def client_table(source: Extracts, name_exclusion: bool = False) -> DataFrame:
    """Clients with agreed times, flags and codes; one row per person and date of birth.

    Dates of birth are left for :func:`merge_tables`, which knows the enrolments.
    """
    spec = source.spec("client")
    person, dob = spec.role("person_ID"), spec.role("dob_column")
    flags, codes = spec.roles.get("boolean", ()), spec.roles.get("numeric_code", ())
    for key in ("boolean", "numeric_code"):
        if key not in spec.roles:
            warnings.warn(f"the client specification has no {key} columns")
    final_keys = tuple(spec.duplicate_check_columns or ())
    keys = tuple(dict.fromkeys([*final_keys, *spec.time_var, *flags, *codes, person]))
    df = materialise(source.read("client", spec.with_dedup_columns(keys)))  # read for hot keys and for rows
    times = [c for c in spec.time_var if c != dob]
    df = resolve_person_values(df, person, times, flags, codes)
    df = keep_last(df, final_keys, [ORD])
    return exclude_names(df, spec.name_columns) if name_exclusion else df


def get_client(source: Extracts, name_exclusion: bool = False) -> DataFrame:
    return client_table(source, name_exclusion).drop(ORD)


def _stages(spec: TableSpec) -> dict:
    return {spec.role("entry_stage_val"): ENTRY, spec.role("exit_stage_val"): EXIT}


def _kept_stages(source: Extracts, table: str, spec: TableSpec) -> DataFrame:
    spec.require(*STAGE_KEYS)
    others = [
        spec.role(k)
        for k in ("update_stage_val", "annual_assessment_stage_val", "post_exit_stage_val")
    ]
    stage = spec.role("collection_stage_column")
    # Each stage becomes a branch of its own; they share one scan and deduplication.
    return materialise(widen.drop_stages(source.read(table, spec), stage, others))


def entry_exit_table(source: Extracts, table: str, kept: DataFrame | None = None) -> DataFrame:
    """Entry and exit rows side by side, other stages dropped; keeps the rows' load orders."""
    spec = source.spec(table)
    df = _kept_stages(source, table, spec) if kept is None else kept
    return widen.split_rows_to_columns(
        df, spec.role("collection_stage_column"), _stages(spec), spec.role("person_enrollment_ID")
    )


def _without_order(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(ORD)])


def get_employment_education(source: Extracts) -> DataFrame:
    return _without_order(entry_exit_table(source, "employment_education"))


def get_health_dv(source: Extracts) -> DataFrame:
    return _without_order(entry_exit_table(source, "health_dv"))


def get_disabilities(
    source: Extracts, types: Mapping | str = DISABILITY_TYPES, unique: bool | None = None
) -> DataFrame:
    """A column per disability type and stage.

    The one-shuffle path is taken when the deduplication key makes (enrolment, stage, type)
    unique, or when ``unique`` says so.
    """
    spec = source.spec("disabilities")
    type_column, response = spec.role("type_column"), spec.role("response_column")
    stage, enrolment = spec.role("collection_stage_column"), spec.role("person_enrollment_ID")
    if unique is None:
        keys = spec.duplicate_check_columns
        unique = bool(spec.dedup and keys and set(keys) <= {enrolment, stage, type_column})
    return widen.widen_typed_responses(
        _kept_stages(source, "disabilities", spec),
        enrolment, stage, _stages(spec), type_column, response, code_map(types), unique,
    )


def get_income(source: Extracts) -> DataFrame:
    """One row per enrolment with the maxima of the income columns per stage."""
    spec = source.spec("income")
    columns = spec.role("columns_to_take_max")
    kept = _kept_stages(source, "income", spec)
    return widen.collapse_stages_to_max(
        kept, spec.role("person_enrollment_ID"), spec.role("collection_stage_column"), _stages(spec), columns, ORD
    )


def get_project(source: Extracts, types: Mapping | str = PROJECT_TYPES) -> DataFrame:
    spec = source.spec("project")
    column = spec.role("project_type_column")
    spec.require("program_ID")
    df = source.read("project", spec).drop(ORD)
    return merge_project_type(df, column, code_map(types))


def settle_dob(
    source: Extracts, clients: DataFrame, enrollments: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Null impossible dates of birth, reconcile the others, deduplicate."""
    spec, enrol = source.spec("client"), source.spec("enrollment")
    person, dob = spec.role("person_ID"), spec.role("dob_column")
    hot = find_hot_keys(clients, [person]) if hot is None else hot
    df = null_impossible_dob(
        clients, person, dob, enrollments, enrol.role("person_ID"), enrol.role("entry_date"), hot
    )
    df = resolve_person_values(df, person, times=[dob], hot=hot)
    return keep_last(df.drop("__bad_dob"), spec.duplicate_check_columns, [ORD])


def merge_tables(
    source: Extracts, groups: bool = True, name_exclusion: bool = False
) -> DataFrame:
    """All eight tables joined to one row per person and enrolment.

    Clients are right-joined: enrolments without a client vanish, clients without an enrolment
    stay. The other tables are left-joined; tables with several rows per enrolment multiply it.
    """
    enrol = source.spec("enrollment")
    enrolment, person, program = (
        enrol.role(k) for k in ("person_enrollment_ID", "person_ID", "program_ID")
    )
    # Both tables are read several times below, so each is cleaned once and fixed.
    enrollments = materialise(enrollment_table(source, groups).drop(ORD))
    clients = materialise(client_table(source, name_exclusion))
    hot_enrolment, hot_person = find_hot_key_sets(enrollments, [[enrolment], [person]])
    exits = source.spec("exit").role("person_enrollment_ID")
    df = merge_on(enrollments, get_exit(source), enrolment, exits, hot=hot_enrolment)
    settled = settle_dob(source, clients, enrollments).drop(ORD)
    df = merge_on(df, settled, person, source.spec("client").role("person_ID"), "right", hot_person)
    df = materialise(df)  # the joins so far are read for hot keys and for rows
    # Clients without an enrolment have null keys, which may be many.
    hot_enrolment, hot_program = find_hot_key_sets(df, [[enrolment], [program]])
    for table, read in (
        ("disabilities", get_disabilities),
        ("employment_education", get_employment_education),
        ("health_dv", get_health_dv),
        ("income", get_income),
    ):
        key = source.spec(table).role("person_enrollment_ID")
        df = merge_on(df, read(source), enrolment, key, hot=hot_enrolment)
    projects = source.spec("project").role("program_ID")
    return merge_on(df, get_project(source), program, projects, hot=hot_program)


def stage_counts(
    source: Extracts, groups: bool = True, name_exclusion: bool = False
) -> DataFrame:
    """Rows per stage table and the number of client rows with an impossible date of birth."""
    spec, enrol = source.spec("client"), source.spec("enrollment")
    enrollments = enrollment_table(source, groups)
    clients = client_table(source, name_exclusion)
    flagged = null_impossible_dob(
        clients, spec.role("person_ID"), spec.role("dob_column"), enrollments,
        enrol.role("person_ID"), enrol.role("entry_date"),
    )
    tables = {
        "enrollment": enrollments,
        "exit": get_exit(source),
        "client": clients,
        "bad_dob": flagged.filter("__bad_dob"),
        "disabilities": get_disabilities(source),
        "employment_education": get_employment_education(source),
        "health_dv": get_health_dv(source),
        "income": get_income(source),
        "project": get_project(source),
    }
    return count_stages(tables)


def count_stages(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``stage`` and ``n_rows``."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
