"""The registered queries: every operator on the given tables, with its SQL where SQL can say it.

A query takes the session and the folder of the parquet tables and reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.identity import (
    clean_ssn,
    gender_from_code,
    race_flag,
    ssn_length_quality,
    ssn_repeat_quality,
    stringify_ssn,
    usable_ssn,
)
from .operators import cleaning, cooccurrence, household, linkage, lookup, reconcile, spells, widen
from .operators.dedup import keep_last
from .operators.identity import (
    date_parts,
    frequent_or_odd_dates,
    grade_dates,
    with_sequential_id,
)
from .operators.joins import merge_on
from .operators.skew import find_hot_keys
from .plans.agencies import merge_agencies, prelink
from .plans.enrollment import Extracts, count_stages, group_rows, merge_tables
from .plans.housing import housing_table
from .session import scratch_path
from .sources.codes import DESTINATIONS, PROJECT_TYPES
from .sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the date as a date."""
    return table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def values_sql(rows) -> str:
    def literal(x) -> str:
        if isinstance(x, str):
            return "'" + x.replace("'", "''") + "'"
        return str(x).lower() if isinstance(x, bool) else str(x)

    return ", ".join("(" + ", ".join(literal(x) for x in row) + ")" for row in rows)


# ---------------------------------------------------------------- sources and cleaning

ORDER_COLUMNS = (
    "o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority"
)


@register(
    "dedup_keep_last",
    f"""SELECT {ORDER_COLUMNS} FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) = 1""",
)
def dedup_keep_last(spark, folder):
    return keep_last(orders(spark, folder), ["o_custkey", "o_orderpriority"], ["o_orderkey"])


@register(
    "folder_union_order",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey, o_orderpriority
        ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END DESC, o_orderkey DESC
    ) = 1""",
)
def folder_union_order(spark, folder):
    """Orders written as three CSV folders and read back: the last-but-one folder wins."""
    root = scratch_path(spark, "folders")
    data = table(spark, folder, "orders").drop("o_orderdate")
    states = ["O", "F", "P"]
    for state in states:
        part = data.filter(F.col("o_orderstatus") == state).orderBy("o_orderkey")
        part.write.option("header", True).csv(f"{root}/{state}")
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    return read_table(
        spark, {s: f"{root}/{s}" for s in states}, types=types,
        duplicate_check_columns=["o_custkey", "o_orderpriority"],
    )


@register(
    "unknown_codes",
    """SELECT p_partkey, p_name, p_brand, p_type,
        CASE WHEN p_size NOT IN (8, 9, 99) THEN p_size END AS p_size FROM part""",
)
def unknown_codes(spark, folder):
    df = cleaning.drop_columns(table(spark, folder, "part"), ["p_retailprice", "not_there"])
    return cleaning.null_unknown(df, ["p_size"])


@register(
    "date_coerce",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS written
    FROM orders""",
)
def date_coerce(spark, folder):
    """Dates as ISO text, as month/day/year text and as no date at all."""
    day, state = F.col("o_orderdate"), F.col("o_orderstatus")
    text = (
        F.when(state == "O", F.date_format(day, "yyyy-MM-dd"))
        .when(state == "F", F.date_format(day, "M/d/yyyy"))
        .otherwise(F.concat(F.date_format(day, "yyyy-"), F.col("o_orderpriority")))
    )
    written = table(spark, folder, "orders").select("o_orderkey", text.alias("written"))
    return cleaning.coerce_times(written, ["written"], "date")


DATE_FORMS = (
    "d-MMM-yy", "MMM d yyyy", "M.d.yyyy", "yyyyMMdd H:mm", "M/d/yyyy H:mm:ss.SSS", "yyyy-MM-dd H:mm:ss.SSS", "MMMM d, yyyy",
)


@register(
    "date_forms",
    f"""SELECT o_orderkey, make_date(CASE WHEN o_orderkey % {len(DATE_FORMS)} = 0 THEN 2000 + year(d) % 100 ELSE year(d) END,
        month(d), day(d)) AS written FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def date_forms(spark, folder):
    """Dates in the forms of several programs, written as CSV and read back as texts."""
    form = F.pmod("o_orderkey", F.lit(len(DATE_FORMS)))
    text = F.coalesce(*[F.when(form == i, F.date_format("o_orderdate", f)) for i, f in enumerate(DATE_FORMS)])
    root = scratch_path(spark, "date-forms")
    orders(spark, folder).select("o_orderkey", text.alias("written")).write.csv(f"{root}/a", header=True)
    read = read_table(spark, {"a": f"{root}/a"}, types={"o_orderkey": "bigint", "written": "string"})
    return cleaning.coerce_times(read, ["written"], "date").select("o_orderkey", "written")


@register(
    "group_filter",
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
    QUALIFY count(*) OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)) > 1""",
)
def group_filter(spark, folder):
    df = orders(spark, folder).select("o_orderkey", "o_custkey", "o_orderdate")
    grouped = df.withColumn("household", F.concat_ws("/", "o_custkey", "o_orderdate"))
    return group_rows(grouped, "household").drop("household")


@register(
    "name_exclude",
    """SELECT p_partkey, p_name, p_type FROM part
    WHERE NOT regexp_matches(replace(lower(p_name), '.', ''), 'red|small|promo|[0-9]')
      AND NOT regexp_matches(replace(lower(p_type), '.', ''), 'red|small|promo|[0-9]')
      AND length(replace(p_name, '.', '')) <> 1 AND length(replace(p_type, '.', '')) <> 1""",
)
def name_exclude(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    return cleaning.exclude_names(df, ["p_name", "p_type"], ["red", "small", "promo"])


@register(
    "refused_filter",
    """SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
    WHERE c_mktsegment NOT LIKE '%HOUSE%' AND c_mktsegment NOT LIKE '%BUILD%'""",
)
def refused_filter(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return cleaning.exclude_refused(df, ["c_mktsegment"], ["HOUSE", "BUILD"])


@register(
    "stage_counts",
    """SELECT 'orders' AS stage, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'open orders', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'customers with orders', count(DISTINCT o_custkey) FROM orders""",
)
def stage_counts(spark, folder):
    data = table(spark, folder, "orders")
    return count_stages(
        {
            "orders": data,
            "open orders": data.filter("o_orderstatus = 'O'"),
            "lineitem": table(spark, folder, "lineitem"),
            "customers with orders": data.select("o_custkey").distinct(),
        }
    )


# ---------------------------------------------------------------- rows to columns

STAGES = {"O": "_entry", "F": "_exit"}


def staged_orders(spark, folder, *columns):
    df = table(spark, folder, "orders").select("o_custkey", "o_orderstatus", *columns)
    return widen.drop_stages(df, "o_orderstatus", ["P"])


@register(
    "stage_widen",
    """SELECT coalesce(e.o_custkey, x.o_custkey) AS o_custkey,
        e.o_totalprice AS o_totalprice_entry, x.o_totalprice AS o_totalprice_exit
    FROM (SELECT * FROM orders WHERE o_orderstatus = 'O') e
    FULL JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') x ON e.o_custkey = x.o_custkey""",
)
def stage_widen(spark, folder):
    df = staged_orders(spark, folder, "o_totalprice")
    return widen.split_rows_to_columns(df, "o_orderstatus", STAGES, "o_custkey")


@register(
    "income_max",
    """SELECT o_custkey,
        max(o_totalprice) FILTER (o_orderstatus = 'O') AS o_totalprice_entry,
        max(o_totalprice) FILTER (o_orderstatus = 'F') AS o_totalprice_exit,
        arg_min(o_orderpriority, o_orderkey) FILTER (o_orderstatus = 'O') AS o_orderpriority_entry,
        arg_min(o_orderpriority, o_orderkey) FILTER (o_orderstatus = 'F') AS o_orderpriority_exit
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey""",
)
def income_max(spark, folder):
    df = staged_orders(spark, folder, "o_orderkey", "o_totalprice", "o_orderpriority")
    return widen.collapse_stages_to_max(
        df, "o_custkey", "o_orderstatus", STAGES, ["o_totalprice"], "o_orderkey"
    )


@register(
    "stage_widen_hot",
    """WITH o AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE o_custkey END AS person, o_orderstatus,
            count(*) AS n_orders, max(o_totalprice) AS dearest
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL),
      l AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE o_custkey END AS person, o_orderkey, o_totalprice
        FROM orders WHERE o_orderstatus = 'O')
    SELECT coalesce(l.person, o.person) AS person, l.o_orderkey AS o_orderkey_entry,
        l.o_totalprice AS o_totalprice_entry, CAST(o.n_orders AS BIGINT) AS o_orderkey_exit, o.dearest AS o_totalprice_exit
    FROM l FULL JOIN (SELECT * FROM o WHERE o_orderstatus = 'F') o ON l.person = o.person""",
)
def stage_widen_hot(spark, folder):
    """Widening where one person holds half of the entry rows: those are dealt over pieces."""
    data = table(spark, folder, "orders").withColumn(
        "person", F.expr("CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE o_custkey END")
    )
    entry = data.filter("o_orderstatus = 'O'").select("person", "o_orderstatus", "o_orderkey", "o_totalprice")
    exits = data.filter("o_orderstatus = 'F'").groupBy("person", "o_orderstatus").agg(
        F.count("*").alias("o_orderkey"), F.max("o_totalprice").alias("o_totalprice")
    )
    rows = entry.withColumn("o_orderkey", F.col("o_orderkey").cast("long")).unionByName(exits)
    hot = find_hot_keys(rows.select("person"), ["person"], 1_000)
    return widen.split_rows_to_columns(rows, "o_orderstatus", STAGES, "person", hot)


TYPE_NAMES = {1: "Urgent", 2: "High", 3: "Medium", 4: "Open", 5: "Low"}
TYPED_SQL = (
    "SELECT o_custkey, "
    + ", ".join(
        f"max(o_totalprice) FILTER (o_orderstatus = '{s}' AND o_orderpriority LIKE '{code}%') "
        f"AS {name}{suffix}"
        for s, suffix in STAGES.items()
        for code, name in TYPE_NAMES.items()
    )
    + """ FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey
    HAVING count(*) FILTER (o_orderstatus = 'O') > 0 AND count(*) FILTER (o_orderstatus = 'F') > 0"""
)


def typed_orders(spark, folder):
    """The highest price per customer, stage and priority."""
    code = F.substring("o_orderpriority", 1, 1).cast("int").alias("kind")
    df = staged_orders(spark, folder, "o_totalprice", code)
    return df.groupBy("o_custkey", "o_orderstatus", "kind").agg(F.max("o_totalprice").alias("price"))


@register("type_stage_pivot", TYPED_SQL)
def type_stage_pivot(spark, folder):
    return widen.widen_typed_responses(
        typed_orders(spark, folder), "o_custkey", "o_orderstatus", STAGES, "kind", "price",
        TYPE_NAMES, unique=True,
    )


@register("type_stage_joins", TYPED_SQL)
def type_stage_joins(spark, folder):
    """The same by the successive outer joins that also allow repeated responses."""
    return widen.widen_typed_responses(
        typed_orders(spark, folder), "o_custkey", "o_orderstatus", STAGES, "kind", "price",
        TYPE_NAMES,
    )


# ---------------------------------------------------------------- lookups and recodes


@register(
    "destination_lookup",
    f"""SELECT p_partkey, m.* FROM part LEFT JOIN (
        SELECT CAST(a AS BIGINT) AS "DestinationNumeric", b AS "DestinationDescription",
            c AS "DestinationGroup", d AS "DestinationSuccess", e AS "Subsidy"
        FROM (VALUES {values_sql(DESTINATIONS)}) v(a, b, c, d, e)) m
    ON p_size = m."DestinationNumeric" """,
)
def destination_lookup(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_size")
    return lookup.merge_destination(df, "p_size")


@register(
    "project_lookup",
    f"""SELECT p_partkey, CAST(a AS BIGINT) AS "ProjectNumeric", b AS "ProjectType"
    FROM part LEFT JOIN (VALUES {values_sql(PROJECT_TYPES.items())}) v(a, b) ON p_size = a""",
)
def project_lookup(spark, folder):
    return lookup.merge_project_type(table(spark, folder, "part").select("p_partkey", "p_size"), "p_size")


@register(
    "recodes",
    """SELECT c_custkey,
        CASE c_nationkey WHEN 0 THEN 'Fem' WHEN 1 THEN 'Mal' WHEN 2 THEN 'MTF' WHEN 3 THEN 'FTM'
            WHEN 4 THEN 'GNC' END AS gender,
        CASE WHEN c_mktsegment = 'BUILDING' OR flag = 1 THEN 1
            WHEN flag IS NULL THEN NULL ELSE 0 END AS r_flag
    FROM (SELECT *, nullif(c_nationkey, 3) AS flag FROM customer)""",
)
def recodes(spark, folder):
    df = table(spark, folder, "customer").withColumn("flag", F.nullif("c_nationkey", F.lit(3)))
    return df.select(
        "c_custkey",
        gender_from_code(F.col("c_nationkey")).alias("gender"),
        race_flag(F.col("flag"), F.col("c_mktsegment"), "BUILDING").alias("r_flag"),
    )


SSN_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 11111111 * (o_custkey % 10)
    WHEN '3-MEDIUM' THEN 111111111 * (o_custkey % 11) ELSE o_orderkey * 40000 + o_custkey END"""


@register(
    "ssn_quality",
    f"""SELECT o_orderkey, cleaned, text_form, first_dq,
        CASE WHEN number IS NULL THEN NULL
            WHEN number % 111111111 = 0 AND number <= 999999999 THEN 3 ELSE first_dq END AS ssn_dq,
        CASE WHEN length(text_form) = 9 AND number % 111111111 <> 0 THEN text_form END AS ssn1
    FROM (SELECT o_orderkey, number, CAST(number AS VARCHAR) AS text_form,
            CASE WHEN number % 11111111 = 0 AND number / 11111111 BETWEEN 1 AND 8 THEN NULL
                ELSE number END AS cleaned,
            CASE WHEN number IS NULL THEN 3 WHEN length(CAST(number AS VARCHAR)) < 9 THEN 2 ELSE 1 END
                AS first_dq
        FROM (SELECT o_orderkey, CAST({SSN_SQL} AS BIGINT) AS number FROM orders))""",
)
def ssn_quality(spark, folder):
    number = F.expr(f"CAST({SSN_SQL} AS BIGINT)")
    df = table(spark, folder, "orders").select("o_orderkey", number.alias("number"))
    df = df.withColumns(
        {"cleaned": clean_ssn(F.col("number")), "text_form": stringify_ssn(F.col("number"))}
    ).drop("number")
    df = df.withColumn("first_dq", ssn_length_quality(F.col("text_form")))
    df = df.withColumn("ssn_dq", ssn_repeat_quality(F.col("text_form"), F.col("first_dq")))
    return df.withColumn("ssn1", usable_ssn(F.col("text_form"), F.col("ssn_dq")))


# ---------------------------------------------------------------- identity

DOB_SQL = "CAST(o_orderdate AS DATE) - CAST(o_custkey % 1500 * 30 AS INTEGER)"


def birth_dates(spark, folder):
    shift = (F.col("o_custkey") % 1500 * 30).cast("int")
    dob = F.date_sub("o_orderdate", shift)
    return orders(spark, folder).select("o_orderkey", "o_custkey", dob.alias("dob"))


@register(
    "bad_value_freq",
    f"""SELECT dob, count(*) AS freq FROM (SELECT {DOB_SQL} AS dob FROM orders) GROUP BY dob
    HAVING year(dob) > 2018 OR year(dob) < 1900 OR count(*) >= 4""",
)
def bad_value_freq(spark, folder):
    return frequent_or_odd_dates(birth_dates(spark, folder), "dob", 4)


@register(
    "dob_quality",
    f"""WITH d AS (SELECT o_orderkey, {DOB_SQL} AS dob FROM orders), bad AS (
        SELECT dob FROM d GROUP BY dob
        HAVING year(dob) > 2018 OR year(dob) < 1900 OR count(*) >= 4)
    SELECT o_orderkey, dob, CAST(year(dob) AS INTEGER) AS dob_y, CAST(month(dob) AS INTEGER) AS dob_m,
        CAST(day(dob) AS INTEGER) AS dob_d,
        CASE WHEN dob IN (SELECT dob FROM bad) THEN 2 ELSE 1 END AS dob_dq FROM d""",
)
def dob_quality(spark, folder):
    df = birth_dates(spark, folder).drop("o_custkey")
    return grade_dates(date_parts(df, "dob", "dob"), "dob", frequent_or_odd_dates(df, "dob", 4))


@register(
    "sequential_ids",
    """SELECT name, nation, segment, 'pid_' || CASE WHEN n < 1000000
        THEN lpad(CAST(n AS VARCHAR), 6, '0') ELSE CAST(n AS VARCHAR) END AS pid
    FROM (SELECT *, row_number() OVER (ORDER BY name, nation, segment NULLS LAST) AS n
        FROM (SELECT DISTINCT * FROM (
            SELECT upper(c_name) AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
            UNION ALL SELECT upper(s_name), s_nationkey, NULL FROM supplier)))""",
)
def sequential_ids(spark, folder):
    people = table(spark, folder, "customer").select(
        F.upper("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    firms = table(spark, folder, "supplier").select(
        F.upper("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    both = people.unionByName(firms, allowMissingColumns=True).distinct()
    return with_sequential_id(both, ["name", "nation", "segment"], "pid", "pid_")


# ---------------------------------------------------------------- reconciliation

CONFLICTS_SQL = """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) AS person,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS seen,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS flag,
    CASE WHEN o_orderpriority NOT LIKE '4%' THEN CAST(left(o_orderpriority, 1) AS INTEGER) END AS code
    FROM orders"""


def conflicting_rows(spark, folder):
    state, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders(spark, folder).select(
        "o_orderkey",
        F.concat_ws("/", "o_custkey", F.year("o_orderdate")).alias("person"),
        F.when(state != "P", F.col("o_orderdate")).alias("seen"),
        F.when(state == "F", 1).when(state == "O", 0).alias("flag"),
        F.when(~priority.startswith("4"), F.substring(priority, 1, 1).cast("int")).alias("code"),
    )


@register(
    "resolve_time",
    f"""SELECT o_orderkey, person, CASE WHEN lo = hi AND known = n THEN seen WHEN known <= 1 THEN lo
        WHEN hi - lo < 365 THEN lo + CAST((hi - lo) // 2 AS INTEGER) END AS seen
    FROM (SELECT *, min(seen) OVER w AS lo, max(seen) OVER w AS hi, count(seen) OVER w AS known,
        count(*) OVER w AS n FROM ({CONFLICTS_SQL}) WINDOW w AS (PARTITION BY person))""",
)
def resolve_time(spark, folder):
    df = conflicting_rows(spark, folder).select("o_orderkey", "person", "seen")
    return reconcile.resolve_person_values(df, "person", times=["seen"])


@register(
    "resolve_flag",
    f"""SELECT o_orderkey, person, max(flag) OVER (PARTITION BY person) AS flag FROM ({CONFLICTS_SQL})""",
)
def resolve_flag(spark, folder):
    df = conflicting_rows(spark, folder).select("o_orderkey", "person", "flag")
    return reconcile.resolve_person_values(df, "person", flags=["flag"])


@register(
    "resolve_code",
    f"""SELECT o_orderkey, person, CASE WHEN lo = hi AND known = n THEN code WHEN known <= 1 THEN lo END AS code
    FROM (SELECT *, min(code) OVER w AS lo, max(code) OVER w AS hi, count(code) OVER w AS known,
        count(*) OVER w AS n FROM ({CONFLICTS_SQL}) WINDOW w AS (PARTITION BY person))""",
)
def resolve_code(spark, folder):
    df = conflicting_rows(spark, folder).select("o_orderkey", "person", "code")
    return reconcile.resolve_person_values(df, "person", codes=["code"])


@register(
    "dob_sanity",
    """WITH c AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) - CAST(floor(o_totalprice / 100) AS INTEGER) AS dob
            FROM orders),
        f AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first FROM orders
            WHERE o_orderstatus = 'F' GROUP BY o_custkey),
        s AS (SELECT c.o_custkey, o_orderkey, CASE WHEN dob > first OR dob < DATE '1900-01-01' THEN NULL ELSE dob END AS dob
            FROM c LEFT JOIN f ON c.o_custkey = f.o_custkey),
        r AS (SELECT o_custkey, o_orderkey, CASE WHEN lo = hi AND known = n THEN dob WHEN known <= 1 THEN lo
                WHEN hi - lo < 365 THEN lo + CAST((hi - lo) // 2 AS INTEGER) END AS dob
            FROM (SELECT *, min(dob) OVER w AS lo, max(dob) OVER w AS hi, count(dob) OVER w AS known,
                count(*) OVER w AS n FROM s WINDOW w AS (PARTITION BY o_custkey)))
    SELECT o_custkey, dob, max(o_orderkey) AS o_orderkey FROM r GROUP BY o_custkey, dob""",
)
def dob_sanity(spark, folder):
    """Each order as a client record; closed orders as the enrolments."""
    data = orders(spark, folder)
    age = F.floor(F.col("o_totalprice") / 100).cast("int")
    clients = data.select("o_custkey", "o_orderkey", F.date_sub("o_orderdate", age).alias("dob"))
    enrolled = data.filter("o_orderstatus = 'F'")
    sane = reconcile.null_impossible_dob(
        clients, "o_custkey", "dob", enrolled, "o_custkey", "o_orderdate"
    ).drop("__bad_dob")
    settled = reconcile.resolve_person_values(sane, "o_custkey", times=["dob"])
    return keep_last(settled, ["o_custkey", "dob"], ["o_orderkey"])


@register(
    "modal_value",
    """WITH u AS (SELECT *, max(o_orderstatus = 'F') OVER (PARTITION BY o_custkey) AS has_f FROM orders)
    SELECT o_custkey, o_orderpriority AS h_value, count(*) AS n FROM u
    WHERE (o_orderstatus = 'F') = has_f GROUP BY o_custkey, o_orderpriority
    QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC) = 1""",
)
def modal_value(spark, folder):
    return reconcile.modal_values(
        table(spark, folder, "orders"), "o_custkey", "o_orderpriority", "o_orderstatus", ["F"],
        "h_value",
    )


@register(
    "assemble",
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice, n_items, shipped, n_name
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    LEFT JOIN (SELECT l_orderkey, count(*) AS n_items, CAST(max(l_shipdate) AS DATE) AS shipped
        FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
    LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def assemble(spark, folder):
    """Orders with their items, right-joined to customers, with the nation's name."""
    data = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    items = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n_items"), F.to_date(F.max("l_shipdate")).alias("shipped")
    )
    people = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    people = people.withColumn("o_custkey", F.col("c_custkey"))
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    df = merge_on(data, items, "o_orderkey", "l_orderkey")
    df = merge_on(df, people, "o_custkey", "o_custkey", "right").drop("o_custkey")
    return merge_on(df, nations, "c_nationkey", "n_nationkey").drop("c_nationkey")


# ---------------------------------------------------------------- linkage


@register(
    "block_match",
    """SELECT id_l, id_r, p_name, p_type, (p_name + p_type) / 2 AS mean, (p_name + p_type) / 2 > 0.5 AS match
    FROM (SELECT l.p_partkey AS id_l, r.p_partkey AS id_r,
            CAST(jaro_winkler_similarity(l.p_name, r.p_name) >= 0.85 AS DOUBLE) AS p_name,
            CAST(jaro_winkler_similarity(l.p_type, r.p_type) >= 0.85 AS DOUBLE) AS p_type
        FROM part l JOIN part r ON l.p_brand = r.p_brand AND l.p_partkey < r.p_partkey)""",
)
def block_match(spark, folder):
    return linkage.block_and_match(
        table(spark, folder, "part"), "p_partkey", "p_brand", {"p_name": "string", "p_type": "string"}
    )


GRAMS_SQL = """WITH words AS (SELECT p_partkey AS k, p_brand AS b, ' ' || w || ' ' AS w
        FROM (SELECT p_partkey, p_brand, unnest(string_split(lower(p_name), ' ')) AS w FROM part) WHERE w <> ''),
      grams AS (SELECT k, b, g, count(*) AS n FROM (SELECT k, b, substring(w, CAST(i AS BIGINT), 2) AS g
        FROM words, unnest(range(1, length(w))) AS r(i)) GROUP BY ALL),
      sums AS (SELECT k, sum(n) AS n, sqrt(sum(n * n)) AS norm FROM grams GROUP BY k),
      common AS (SELECT l.k AS id_l, r.k AS id_r, sum(least(l.n, r.n)) AS shared, sum(l.n * r.n) AS dot
        FROM grams l JOIN grams r ON l.b = r.b AND l.g = r.g AND l.k < r.k GROUP BY ALL),
      pairs AS (SELECT l.p_partkey AS id_l, r.p_partkey AS id_r FROM part l JOIN part r ON l.p_brand = r.p_brand AND l.p_partkey < r.p_partkey),
      scored AS (SELECT id_l, id_r, coalesce(shared, 0) / greatest(x.n, y.n) AS qgram, coalesce(dot, 0) / (x.norm * y.norm) AS cosine
        FROM pairs LEFT JOIN common USING (id_l, id_r) JOIN sums x ON x.k = id_l JOIN sums y ON y.k = id_r)
    SELECT id_l, id_r, CAST({score} AS DOUBLE) AS p_name, CAST({score} AS DOUBLE) AS mean, {score} AS match FROM scored"""


@register("block_match_qgram", GRAMS_SQL.format(score="qgram >= 0.52"))
def block_match_qgram(spark, folder):
    return linkage.block_and_match(
        table(spark, folder, "part"), "p_partkey", "p_brand", {"p_name": "string"}, string_method="qgram", string_threshold=0.52
    )


@register("block_match_cosine", GRAMS_SQL.format(score="cosine >= 0.52003"))
def block_match_cosine(spark, folder):
    return linkage.block_and_match(
        table(spark, folder, "part"), "p_partkey", "p_brand", {"p_name": "string"}, string_method="cosine", string_threshold=0.52003
    )


@register(
    "block_match_damerau",
    """SELECT id_l, id_r, CAST(near AS DOUBLE) AS p_type, CAST(near AS DOUBLE) AS mean, near AS match
    FROM (SELECT l.p_partkey AS id_l, r.p_partkey AS id_r, 1.0 - damerau_levenshtein(l.p_type, r.p_type)
            / CAST(greatest(length(l.p_type), length(r.p_type)) AS DOUBLE) >= 0.58 AS near
        FROM part l JOIN part r ON l.p_brand = r.p_brand AND l.p_partkey < r.p_partkey)""",
)
def block_match_damerau(spark, folder):
    return linkage.block_and_match(
        table(spark, folder, "part"), "p_partkey", "p_brand", {"p_type": "string"},
        string_method="damerau_levenshtein", string_threshold=0.58,
    )


DATE_SCORE_SQL = """CASE WHEN a = b THEN 1.0
    WHEN year(a) = year(b) AND month(a) = day(b) AND day(a) = month(b) THEN 0.5
    WHEN year(a) = year(b) AND day(a) = day(b) AND (least(month(a), month(b)), greatest(month(a), month(b)))
        IN ((6, 7), (9, 10)) THEN 0.5 ELSE 0.0 END"""


@register(
    "date_compare",
    f"""SELECT id_l, id_r, CAST({DATE_SCORE_SQL} AS DOUBLE) AS o_orderdate,
        CAST({DATE_SCORE_SQL} AS DOUBLE) AS mean, {DATE_SCORE_SQL} > 0.5 AS match
    FROM (SELECT l.o_orderkey AS id_l, r.o_orderkey AS id_r, CAST(l.o_orderdate AS DATE) AS a,
            CAST(r.o_orderdate AS DATE) AS b
        FROM orders l JOIN orders r ON l.o_custkey = r.o_custkey AND l.o_orderkey < r.o_orderkey)""",
)
def date_compare(spark, folder):
    return linkage.block_and_match(
        orders(spark, folder), "o_orderkey", "o_custkey", {"o_orderdate": "date"}
    )


def components_sql(nodes: str, edges: str) -> str:
    """CTEs ``nodes``, ``both`` (edges both ways) and ``cc`` (node, root = smallest node)."""
    return f"""WITH RECURSIVE nodes AS ({nodes}), edges AS ({edges}),
    pairs AS MATERIALIZED (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
    cc(node, root) USING KEY (node) AS (
        SELECT node, node FROM nodes
        UNION
        SELECT p.v, min(c.root) FROM cc c JOIN pairs p ON p.u = c.node
            JOIN recurring.cc r ON r.node = p.v WHERE c.root < r.root GROUP BY p.v)"""


LINK_EDGES_SQL = f"""
    SELECT id_l AS u, id_r AS v FROM (
        SELECT l.o_orderkey AS id_l, r.o_orderkey AS id_r, CAST(l.o_orderdate AS DATE) AS a,
            CAST(r.o_orderdate AS DATE) AS b, l.o_orderpriority AS p, r.o_orderpriority AS q,
            l.o_orderstatus AS s, r.o_orderstatus AS t
        FROM orders l JOIN orders r ON l.o_custkey = r.o_custkey AND l.o_orderkey < r.o_orderkey)
    WHERE ({DATE_SCORE_SQL} + CAST(jaro_winkler_similarity(p, q) >= 0.85 AS INTEGER)
        + CAST(jaro_winkler_similarity(s, t) >= 0.85 AS INTEGER)) / 3 > 0.5
    UNION
    SELECT l.o_orderkey, r.o_orderkey FROM orders l
    JOIN orders r ON CAST(l.o_orderdate AS DATE) = CAST(r.o_orderdate AS DATE) AND l.o_orderkey < r.o_orderkey
    WHERE (CAST(jaro_winkler_similarity(CAST(l.o_custkey AS VARCHAR), CAST(r.o_custkey AS VARCHAR)) >= 0.85 AS INTEGER)
        + CAST(jaro_winkler_similarity(l.o_orderpriority, r.o_orderpriority) >= 0.85 AS INTEGER)
        + CAST(jaro_winkler_similarity(CAST(l.o_totalprice AS VARCHAR), CAST(r.o_totalprice AS VARCHAR)) >= 0.85
            AS INTEGER)) / 3 > 0.5"""


@register(
    "link_records",
    components_sql("SELECT o_orderkey AS node FROM orders", LINK_EDGES_SQL)
    + """ SELECT node AS o_orderkey, dense_rank() OVER (ORDER BY single, root) AS linkage_PID
    FROM (SELECT node, root, count(*) OVER (PARTITION BY root) = 1 AS single FROM cc)""",
)
def link_records(spark, folder):
    """Orders as person records: once by customer, once by day."""
    data = orders(spark, folder)
    people = data.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus",
        F.col("o_custkey").cast("string").alias("name"),
        F.col("o_totalprice").cast("string").alias("number"),
    )
    passes = [
        {
            "block_variable": "o_custkey",
            "match_variables": {
                "o_orderdate": "date", "o_orderpriority": "string", "o_orderstatus": "string",
            },
        },
        {
            "block_variable": "o_orderdate",
            "match_variables": {"name": "string", "o_orderpriority": "string", "number": "string"},
        },
    ]
    return linkage.link_records(people, passes, order="o_orderkey").select("o_orderkey", "linkage_PID")


# ---------------------------------------------------------------- clusters


@register(
    "co_occurrence",
    """WITH m AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
    SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS n
    FROM m x JOIN m y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey GROUP BY ALL""",
)
def co_occurrence(spark, folder):
    return cooccurrence.groups_co_occurrence(
        table(spark, folder, "lineitem"), "l_suppkey", "l_orderkey"
    )


@register(
    "time_co_occurrence",
    """SELECT x.user_id AS a, y.user_id AS b, CAST(1 AS BIGINT) AS n FROM events x
    JOIN events y ON x.ts BETWEEN y.ts - INTERVAL 30 SECOND AND y.ts + INTERVAL 30 SECOND
        AND x.user_id < y.user_id GROUP BY x.user_id, y.user_id""",
)
def time_co_occurrence(spark, folder):
    return cooccurrence.time_co_occurrence(
        table(spark, folder, "events"), "user_id", ["ts"], "s", 30
    )


@register(
    "cluster_by_group",
    components_sql(
        "SELECT DISTINCT o_custkey AS node FROM orders",
        """SELECT o_custkey AS u, min(o_custkey) OVER (
            PARTITION BY CAST(o_orderdate AS DATE), CAST(floor(o_totalprice / 1000) AS BIGINT)) AS v FROM orders""",
    )
    + """ SELECT o_orderkey, o_custkey, dense_rank() OVER (ORDER BY first) AS cluster
    FROM (SELECT o_orderkey, o_custkey, min(o_orderkey) OVER (PARTITION BY root) AS first
        FROM orders JOIN cc ON o_custkey = node)""",
)
def cluster_by_group(spark, folder):
    """Customers with orders of the same day and price range."""
    price = F.floor(F.col("o_totalprice") / 1000)
    df = orders(spark, folder).select(
        "o_orderkey", "o_custkey", F.concat_ws("/", "o_orderdate", price).alias("together")
    )
    return cooccurrence.cluster(df, "o_custkey", "together", order="o_orderkey").drop("together")


@register(
    "cluster_by_time",
    components_sql(
        """SELECT min(event_id) AS node FROM events GROUP BY user_id, event_type""",
        """SELECT n AS u, lag(n) OVER (ORDER BY ts) AS v FROM (
            SELECT ts, n, ts - lag(ts) OVER (ORDER BY ts) AS gap FROM (
                SELECT ts, min(event_id) OVER (PARTITION BY user_id, event_type) AS n FROM events))
        QUALIFY gap <= INTERVAL 5 SECOND""",
    )
    + """ SELECT event_id, dense_rank() OVER (ORDER BY root) AS cluster
    FROM (SELECT event_id, min(event_id) OVER (PARTITION BY user_id, event_type) AS n FROM events)
    JOIN cc ON n = node""",
)
def cluster_by_time(spark, folder):
    """Users' event series that come within five seconds of each other."""
    df = table(spark, folder, "events").select(
        "event_id", "ts", F.concat_ws("/", "user_id", "event_type").alias("series")
    )
    out = cooccurrence.cluster(df, "series", times="ts", time_unit="s", time_delta=5, order="event_id")
    return out.select("event_id", "cluster")


@register(
    "household_cluster",
    components_sql(
        "SELECT DISTINCT l_orderkey AS node FROM lineitem",
        """SELECT l_orderkey AS u, min(l_orderkey) OVER (
            PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)) AS v FROM lineitem""",
    )
    + """ SELECT node AS l_orderkey, dense_rank() OVER (ORDER BY root) AS h_cluster,
        count(*) OVER (PARTITION BY root) AS h_cluster_ct FROM cc""",
)
def household_cluster(spark, folder):
    """Orders that share a supplier and ship day."""
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", F.concat_ws("/", "l_suppkey", F.to_date("l_shipdate")).alias("hh_id")
    )
    return cooccurrence.household_clusters(df, "l_orderkey")


@register(
    "household_edges",
    """WITH m AS (SELECT DISTINCT l_orderkey AS p, l_suppkey AS s, CAST(l_shipdate AS DATE) AS d FROM lineitem)
    SELECT DISTINCT x.p AS "from", y.p AS "to" FROM m x JOIN m y ON x.s = y.s AND x.d = y.d""",
)
def household_edges(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", F.concat_ws("/", "l_suppkey", F.to_date("l_shipdate")).alias("hh_id")
    )
    return cooccurrence.household_edges(df, "l_orderkey")


# ---------------------------------------------------------------- households and spells

MEMBERS_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS hh_id, CAST(o_orderdate AS DATE) AS entry,
    CASE WHEN l_returnflag <> 'N' OR l_linenumber > 2
        THEN CAST(o_orderdate AS DATE) - CAST(l_quantity * l_partkey % 40000 AS INTEGER) + 200 END AS h_dob,
    CASE l_linenumber WHEN 1 THEN 'H' WHEN 2 THEN 'Y' WHEN 3 THEN 'F' WHEN 4 THEN '2' WHEN 5 THEN '99'
        WHEN 6 THEN 'S' END AS relcode,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Disabled' WHEN l_returnflag = 'A' THEN 'None' END
        AS disability
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def household_sql(base: str) -> str:
    """Rows with hh_id, entry, h_dob, relcode and disability, described."""
    return f"""WITH m AS ({base}),
    a AS (SELECT * REPLACE (CASE WHEN days BETWEEN 0 AND 120 * 365.25 THEN h_dob END AS h_dob),
            CASE WHEN days BETWEEN 0 AND 120 * 365.25 THEN days / 365.25 END AS age
        FROM (SELECT *, CAST(entry - h_dob AS DOUBLE) AS days FROM m)),
    r AS (SELECT *, CASE WHEN relcode NOT IN ('', '99', 'D', 'M', 'N') THEN relcode END AS h_relcode FROM a),
    c AS (SELECT *, CASE
            WHEN age < 18 AND h_relcode IN ('Y', 'F', '2') THEN 'yes'
            WHEN age < 18 AND h_relcode IS NULL THEN NULL
            WHEN age IS NULL AND (h_relcode IS NULL OR h_relcode IN ('Y', 'F', '2')) THEN NULL
            WHEN age >= 18 AND h_relcode = 'Y' THEN 'relcode'
            WHEN age >= 18 AND h_relcode IS NULL THEN NULL
            ELSE 'no' END AS h_child FROM r),
    d AS (SELECT *, CASE WHEN age <= 25 OR h_child = 'no' THEN age END AS h_age FROM c),
    e AS (SELECT *, CASE WHEN h_child IS NULL AND (h_age >= 62 OR h_age IS NULL) THEN NULL
            WHEN h_child = 'no' AND h_age IS NULL THEN NULL
            WHEN h_child = 'no' AND h_age >= 62 THEN 'yes' ELSE 'no' END AS h_elder FROM d),
    g AS (SELECT *, count(*) OVER w AS h_hh_ct,
            CASE WHEN count(h_child) OVER w = count(*) OVER w
                THEN count(*) FILTER (h_child <> 'no') OVER w END AS h_hh_kids,
            CASE WHEN count(h_child) OVER w = count(*) OVER w
                THEN count(*) FILTER (h_child = 'no') OVER w END AS h_hh_adults,
            bool_or(h_elder = 'yes') OVER w AS elder, bool_or(disability = 'Disabled') OVER w AS disabled
        FROM e WINDOW w AS (PARTITION BY hh_id, entry))
    SELECT * EXCLUDE (age, days, elder, disabled) REPLACE (round(h_age, 6) AS h_age),
        CASE WHEN elder THEN 'Elderly household' WHEN disabled THEN 'Non-elderly disabled household'
            ELSE 'Non-elderly non-disabled household' END AS h_hh_type1,
        CASE WHEN h_hh_kids > 0 AND h_hh_adults > 1 THEN 'multi-adult household with children'
            WHEN h_hh_kids > 0 AND h_hh_adults = 1 THEN 'single parent household with children'
            WHEN h_hh_kids = 0 AND h_hh_adults > 0 THEN 'household without children' END AS h_hh_type2
    FROM g"""


@register(
    "household_types",
    household_sql(MEMBERS_SQL),
)
def household_types(spark, folder):
    """The lines of an order as the members of a household."""
    items, data = table(spark, folder, "lineitem"), orders(spark, folder)
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    days = (F.col("l_quantity") * F.col("l_partkey") % 40000).cast("int")
    relations = {1: "H", 2: "Y", 3: "F", 4: "2", 5: "99", 6: "S"}
    relation = F.lit(None).cast("string")
    for number, code in relations.items():
        relation = F.when(line == number, code).otherwise(relation)
    members = items.join(data, items["l_orderkey"] == data["o_orderkey"]).select(
        F.col("l_orderkey").cast("string").alias("hh_id"),
        F.col("o_orderdate").alias("entry"),
        F.when((flag != "N") | (line > 2), F.date_add(F.date_sub("o_orderdate", days), 200)).alias("h_dob"),
        relation.alias("relcode"),
        F.when((flag == "R") & (F.col("l_linestatus") == "F"), "Disabled")
        .when(flag == "A", "None")
        .alias("disability"),
    )
    described = household.describe_households(members)
    return described.withColumn("h_age", F.round("h_age", 6))


SPELLS_SQL = """SELECT o_orderkey, o_custkey AS linkage_PID, CAST(o_orderdate AS DATE) AS entry,
    CASE WHEN o_orderpriority <> '5-LOW' THEN shipped END AS exit,
    CASE o_orderstatus WHEN 'F' THEN 'HMIS' WHEN 'O' THEN 'SHA' ELSE 'KCHA' END AS agency,
    CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') AND o_totalprice > 250000 THEN 'Emergency Shelter'
        WHEN o_orderpriority <> '2-HIGH' THEN 'Transitional Housing' END AS hmis_proj_type
    FROM orders LEFT JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS shipped
        FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""


def bounds_sql(base: str, order: str) -> str:
    """Spells with the imputed exit, days and entry."""
    return f"""SELECT *, CASE WHEN h_servdays < 0 THEN exit WHEN h_servdays >= 0 THEN entry END AS h_entry
    FROM (SELECT *, CAST(h_exit - entry AS INTEGER) AS h_servdays FROM (
        SELECT * EXCLUDE (ne, nx), CASE
            WHEN exit IS NOT NULL OR agency <> 'HMIS' THEN exit
            WHEN coalesce(hmis_proj_type, '') <> 'Emergency Shelter'
                THEN CASE WHEN nx IS NULL THEN DATE '2017-12-31' ELSE ne END
            WHEN nx IS NULL OR ne - entry >= 90 THEN entry + 90 ELSE ne END AS h_exit
        FROM (SELECT *, lead(entry) OVER w AS ne, lead(exit) OVER w AS nx FROM ({base})
            WINDOW w AS (PARTITION BY linkage_PID ORDER BY entry, {order}))))"""


def covered_sql(keys: str, name: str, order: str) -> str:
    """A table of covered days per group by gaps and islands."""
    return f"""SELECT {keys}, CAST(sum(last - first) AS BIGINT) AS {name} FROM (
        SELECT {keys}, island, min(h_entry) AS first, max(h_exit) AS last FROM (
            SELECT *, sum(CASE WHEN h_entry <= seen THEN 0 ELSE 1 END)
                OVER (PARTITION BY {keys} ORDER BY h_entry, {order}) AS island
            FROM (SELECT *, max(h_exit) OVER (PARTITION BY {keys} ORDER BY h_entry, {order}
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
                FROM bounds WHERE h_entry IS NOT NULL AND h_exit IS NOT NULL))
        GROUP BY {keys}, island) GROUP BY {keys}"""


def spells_sql(base: str, order: str) -> str:
    """The whole history of spells."""
    return f"""WITH bounds AS ({bounds_sql(base, order)}),
        a AS ({covered_sql("linkage_PID, agency", "h_agency_time", order)}),
        t AS ({covered_sql("linkage_PID", "h_tot_time", order)}),
        f AS (SELECT b.* REPLACE (CASE WHEN h_servdays >= 0 THEN h_exit END AS h_exit,
                CASE WHEN h_servdays >= 0 THEN entry END AS h_entry,
                CASE WHEN h_servdays >= 0 THEN h_servdays + 1 END AS h_servdays),
            CASE WHEN h_servdays >= 0 THEN 0 ELSE 1 END AS h_time_qual,
            coalesce(h_agency_time, 0) AS h_agency_time, coalesce(h_tot_time, 0) AS h_tot_time
            FROM bounds b LEFT JOIN a ON a.linkage_PID = b.linkage_PID AND a.agency = b.agency
            LEFT JOIN t ON t.linkage_PID = b.linkage_PID),
        p AS (SELECT * EXCLUDE ({order}), min({order}) AS {order} FROM f GROUP BY ALL),
        n AS (SELECT *, lead(agency) OVER w AS la, lead(h_entry) OVER w AS li, lead(h_exit) OVER w AS lo FROM p
            WINDOW w AS (PARTITION BY linkage_PID ORDER BY h_entry NULLS LAST, h_exit NULLS LAST, {order}))
    SELECT * EXCLUDE (la, li, lo), CASE WHEN la IS NULL THEN agency ELSE agency || ' to ' || la END AS h_agency_trans,
        CAST(li - h_exit AS INTEGER) AS h_t2next_prog, li <= h_exit AND h_entry <= lo AS h_overlap,
        li >= h_entry AND lo <= h_exit AS h_within FROM n"""


def spell_rows(spark, folder):
    """Orders as spells: from the order day to the last ship day, some of them open."""
    shipped = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.to_date(F.max("l_shipdate")).alias("shipped")
    )
    data = orders(spark, folder)
    state, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    shelter = priority.isin("1-URGENT", "5-LOW") & (F.col("o_totalprice") > 250000)
    return data.join(shipped, data["o_orderkey"] == shipped["l_orderkey"], "left").select(
        "o_orderkey",
        F.col("o_custkey").alias("linkage_PID"),
        F.col("o_orderdate").alias("entry"),
        F.when(priority != "5-LOW", F.col("shipped")).alias("exit"),
        F.when(state == "F", "HMIS").when(state == "O", "SHA").otherwise("KCHA").alias("agency"),
        F.when(shelter, "Emergency Shelter")
        .when(priority != "2-HIGH", "Transitional Housing")
        .alias("hmis_proj_type"),
    )


@register("exit_impute", bounds_sql(SPELLS_SQL, "o_orderkey"))
def exit_impute(spark, folder):
    return spells.spell_bounds(spells.impute_exits(spell_rows(spark, folder), "o_orderkey"))


@register(
    "interval_union",
    f"""WITH bounds AS ({bounds_sql(SPELLS_SQL, "o_orderkey")}),
        a AS ({covered_sql("linkage_PID, agency", "h_agency_time", "o_orderkey")}),
        t AS ({covered_sql("linkage_PID", "h_tot_time", "o_orderkey")})
    SELECT o_orderkey, coalesce(h_agency_time, 0) AS h_agency_time, coalesce(h_tot_time, 0) AS h_tot_time
    FROM bounds b LEFT JOIN a ON a.linkage_PID = b.linkage_PID AND a.agency = b.agency
    LEFT JOIN t ON t.linkage_PID = b.linkage_PID""",
)
def interval_union(spark, folder):
    df = exit_impute(spark, folder)
    df = spells.covered_days(df, ["linkage_PID", "agency"], "h_agency_time", "o_orderkey")
    df = spells.covered_days(df, ["linkage_PID"], "h_tot_time", "o_orderkey")
    return df.select("o_orderkey", "h_agency_time", "h_tot_time")


@register("spell_history", spells_sql(SPELLS_SQL, "o_orderkey"))
def spell_history(spark, folder):
    return spells.spell_history(spell_rows(spark, folder), "o_orderkey")


# ---------------------------------------------------------------- whole jobs

STAGE_SPEC = {
    "person_enrollment_ID": "eid", "collection_stage_column": "stage", "entry_stage_val": 1,
    "exit_stage_val": 3, "update_stage_val": 2, "annual_assessment_stage_val": 5,
    "post_exit_stage_val": 6,
}
RAW_SPECS = {
    "enrollment": {
        "person_enrollment_ID": "eid", "person_ID": "pid", "program_ID": "program",
        "groupID_column": "household", "entry_date": "entry", "time_var": ["entry"],
        "categorical_var": ["residence"], "duplicate_check_columns": ["eid", "pid"],
        "types": {"eid": "bigint", "pid": "bigint", "program": "bigint", "residence": "bigint", "entry": "date"},
    },
    "exit": {
        "person_enrollment_ID": "eid", "destination_column": "dest", "duplicate_check_columns": ["eid"],
        "categorical_var": ["dest"], "time_var": ["left_on"],
        "types": {"eid": "bigint", "dest": "bigint", "left_on": "date"},
    },
    "client": {
        "person_ID": "person", "dob_column": "dob", "time_var": ["dob"], "boolean": ["veteran"],
        "numeric_code": ["gender"], "categorical_var": ["gender", "veteran"],
        "duplicate_check_columns": ["person", "dob", "veteran", "gender"],
        "types": {"person": "bigint", "dob": "date", "veteran": "bigint", "gender": "bigint"},
    },
    "disabilities": {
        **STAGE_SPEC, "type_column": "kind", "response_column": "answer", "categorical_var": ["answer"],
        "duplicate_check_columns": ["eid", "stage", "kind"],
        "types": {"eid": "bigint", "stage": "bigint", "kind": "bigint", "answer": "bigint"},
    },
    "employment_education": {
        **STAGE_SPEC, "categorical_var": ["employed"], "duplicate_check_columns": ["eid", "stage"],
        "types": {"eid": "bigint", "stage": "bigint", "employed": "bigint"},
    },
    "health_dv": {
        **STAGE_SPEC, "categorical_var": ["health"], "duplicate_check_columns": ["eid", "stage"],
        "types": {"eid": "bigint", "stage": "bigint", "health": "bigint"},
    },
    "income": {
        **STAGE_SPEC, "categorical_var": ["source"], "columns_to_take_max": ["source", "amount"],
        "duplicate_check_columns": ["eid", "stage", "source", "amount"],
        "types": {"eid": "bigint", "stage": "bigint", "source": "bigint", "amount": "double"},
    },
    "project": {
        "program_ID": "program", "project_type_column": "kind", "duplicate_check_columns": ["program", "kind"],
        "types": {"program": "bigint", "kind": "bigint"},
    },
}

# The raw tables as SQL both engines read; folder F2 is the one loaded first.
STAGE_OF = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 3 ELSE 2 END"
RAW_SQL = {
    "enrollment": """SELECT o_orderkey AS eid, o_custkey AS pid, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS program,
        CAST(o_custkey AS {text}) || '/' || CAST(year(o_orderdate) AS {text}) AS household,
        CAST(o_orderdate AS DATE) AS entry, o_custkey % 12 AS residence FROM orders""",
    "exit": """SELECT o_orderkey AS eid, o_custkey % 33 AS dest,
        CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 5000) AS INT) AS left_on
        FROM orders WHERE o_orderstatus = 'F'""",
    "client": """SELECT c_custkey AS person, DATE '1994-01-01' + CAST(c_custkey % 1500 AS INT) AS dob,
        CAST(c_nationkey % 2 AS BIGINT) AS veteran, CAST(c_nationkey % 3 AS BIGINT) AS gender, 'one' AS folder FROM customer""",
    "client2": """SELECT c_custkey AS person,
        DATE '1994-01-01' + CAST(c_custkey % 1500 + floor(c_acctbal / 15) AS INT) AS dob,
        CAST(CASE WHEN c_nationkey > 20 THEN 1 ELSE 99 END AS BIGINT) AS veteran, CAST(c_nationkey % 4 AS BIGINT) AS gender,
        'two' AS folder FROM customer""",
    "disabilities": f"""SELECT l_orderkey AS eid, {STAGE_OF} AS stage, l_linenumber % 6 + 5 AS kind,
        max(CAST(l_quantity AS BIGINT) % 10) AS answer FROM lineitem GROUP BY 1, 2, 3""",
    "employment_education": f"""SELECT l_orderkey AS eid, {STAGE_OF} AS stage, max(l_suppkey % 10) AS employed
        FROM lineitem GROUP BY 1, 2""",
    "health_dv": f"""SELECT l_orderkey AS eid, {STAGE_OF} AS stage, min(l_suppkey % 11) AS health
        FROM lineitem GROUP BY 1, 2""",
    "income": f"""SELECT l_orderkey AS eid, {STAGE_OF} AS stage, l_partkey % 10 AS source, l_extendedprice AS amount
        FROM lineitem""",
    "project": """SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS program,
        CAST(substr(o_orderpriority, 1, 1) AS BIGINT) * 4 AS kind FROM orders""",
}


def known(column: str) -> str:
    return f"CASE WHEN {column} NOT IN (8, 9, 99) THEN {column} END"


def staged_sql(name: str, column: str) -> str:
    return f"""SELECT eid, max({known(column)}) FILTER (stage = 1) AS {column}_entry,
        max({known(column)}) FILTER (stage = 3) AS {column}_exit, FROM ({RAW_SQL[name]})
        WHERE stage <> 2 GROUP BY eid"""


DISABILITY_COLUMNS = {
    f"{name}{suffix}": (stage, code)
    for stage, suffix in ((1, "_entry"), (3, "_exit"))
    for code, name in enumerate(
        ("Physical", "Developmental", "ChronicHealth", "HIVAIDS", "MentalHealth", "SubstanceAbuse"), 5
    )
}
ENROLLMENT_SQL = f"""WITH e AS (SELECT * REPLACE ({known("residence")} AS residence)
        FROM ({RAW_SQL["enrollment"].format(text="VARCHAR")}) QUALIFY count(*) OVER (PARTITION BY household) > 1),
    x AS (SELECT eid, left_on, m.* FROM ({RAW_SQL["exit"]}) LEFT JOIN (
        SELECT CAST(a AS BIGINT) AS "DestinationNumeric", b AS "DestinationDescription",
            c AS "DestinationGroup", d AS "DestinationSuccess", e AS "Subsidy"
        FROM (VALUES {values_sql(DESTINATIONS)}) v(a, b, c, d, e)) m
        ON {known("dest")} = m."DestinationNumeric"),
    raw AS ({RAW_SQL["client"]} UNION ALL {RAW_SQL["client2"]}),
    flagged AS (SELECT person, dob, folder, max({known("veteran")}) OVER w AS veteran,
            CASE WHEN min(gender) OVER w = max(gender) OVER w THEN gender END AS gender
        FROM raw WINDOW w AS (PARTITION BY person)),
    first AS (SELECT pid, min(entry) AS first FROM e GROUP BY pid),
    sane AS (SELECT person, CASE WHEN dob <= coalesce(first, DATE '9999-01-01') THEN dob END AS dob, folder,
        veteran, gender FROM flagged LEFT JOIN first ON pid = person),
    c AS (SELECT person, 'one' AS folder, max(veteran) AS veteran, max(gender) AS gender,
            CASE WHEN count(dob) < 2 THEN max(dob)
                WHEN max(dob) - min(dob) < 365 THEN min(dob) + CAST((max(dob) - min(dob)) // 2 AS INTEGER) END AS dob
        FROM sane GROUP BY person),
    d AS (SELECT eid, {", ".join(
        f"max({known('answer')}) FILTER (stage = {s} AND kind = {k}) AS {n}"
        for n, (s, k) in DISABILITY_COLUMNS.items())}
        FROM ({RAW_SQL["disabilities"]}) WHERE stage <> 2 GROUP BY eid
        HAVING count(*) FILTER (stage = 1) > 0 AND count(*) FILTER (stage = 3) > 0),
    w AS ({staged_sql("employment_education", "employed")}),
    h AS ({staged_sql("health_dv", "health")}),
    s AS ({staged_sql("income", "source")}),
    a AS ({staged_sql("income", "amount")}),
    p AS (SELECT program, CAST(k AS BIGINT) AS "ProjectNumeric", t AS "ProjectType" FROM ({RAW_SQL["project"]})
        LEFT JOIN (VALUES {values_sql(PROJECT_TYPES.items())}) v(k, t) ON kind = k)
    SELECT e.eid, e.pid, e.program, e.household, e.entry, e.residence, x.* EXCLUDE (eid), c.* EXCLUDE (person),
        d.* EXCLUDE (eid), w.* EXCLUDE (eid), h.* EXCLUDE (eid), s.* EXCLUDE (eid), a.* EXCLUDE (eid),
        p.* EXCLUDE (program)
    FROM c LEFT JOIN e ON e.pid = c.person LEFT JOIN x ON x.eid = e.eid LEFT JOIN d ON d.eid = e.eid
    LEFT JOIN w ON w.eid = e.eid LEFT JOIN h ON h.eid = e.eid LEFT JOIN s ON s.eid = e.eid
    LEFT JOIN a ON a.eid = e.eid LEFT JOIN p ON p.program = e.program"""


def write_raw_tables(spark, folder) -> Extracts:
    """The eight raw tables as CSV, clients in two folders, the others in the first."""
    for name in ("orders", "lineitem", "customer"):
        table(spark, folder, name).createOrReplaceTempView(name)
    root = scratch_path(spark, "extracts")
    files = {}
    for name, sql in RAW_SQL.items():
        path = f"{root}/{'F2' if name == 'client2' else 'F1'}/{name}"
        data = spark.sql(sql.format(text="STRING"))
        data.write.option("header", True).csv(path)
        files.setdefault(name.removesuffix("2"), {})["F2" if name == "client2" else "F1"] = path
    return Extracts(spark, files=files, specs=RAW_SPECS)


@register("enrollment_merge", ENROLLMENT_SQL)
def enrollment_merge(spark, folder):
    """All eight raw tables from CSV to one row per person and enrolment."""
    return merge_tables(write_raw_tables(spark, folder), groups=True)


# Both agencies' extracts from orders, as SQL both engines read: closed orders are the
# homeless-services rows, the others those of two housing authorities. All values are text.
HMIS_SQL = """SELECT 'HMIS0_' || CAST(o_custkey AS {text}) AS pid0,
    CASE WHEN o_orderpriority LIKE '1%' THEN NULL WHEN o_orderpriority LIKE '2%'
        THEN CAST(111111111 * (o_custkey % 10) AS {text}) ELSE CAST(o_custkey * 700001 AS {text}) END AS SSN,
    CASE o_orderpriority WHEN '2-HIGH' THEN '99' WHEN '5-LOW' THEN '2' ELSE '1' END AS SSNDataQuality,
    CAST(o_orderkey AS {text}) AS LastName, CASE WHEN o_custkey % 50 = 7 THEN 'Refused' ELSE 'Ann' END AS FirstName,
    '' AS MiddleName, CAST(NULL AS {text}) AS NameSuffix,
    CAST(DATE '1975-01-01' + CAST(o_custkey % 9000 + o_orderkey % 2 * 10 AS INT) AS {text}) AS DOB,
    CAST(o_custkey % 6 AS {text}) AS Gender,
    CAST(CAST(floor(o_custkey / 3) AS BIGINT) AS {text}) || '-' || CAST(year(o_orderdate) AS {text}) AS HouseholdID,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Y' WHEN '2' THEN 'F' WHEN '3' THEN '99' ELSE 'S' END
        AS RelationshipToHoH,
    CAST(o_custkey % 2 AS {text}) AS AmIndAKNative, '0' AS Asian, CAST(NULL AS {text}) AS BlackAfAmerican,
    '1' AS NativeHIOtherPacific, '0' AS White, '1' AS Ethnicity,
    CAST(CAST(o_orderdate AS DATE) + 3200 AS {text}) AS EntryDate,
    CASE WHEN o_orderpriority NOT LIKE '5%'
        THEN CAST(CAST(o_orderdate AS DATE) + CAST(3150 + floor(o_totalprice / 1000) AS INT) AS {text}) END AS ExitDate,
    CASE WHEN o_totalprice > 250000 THEN 'Emergency Shelter' ELSE 'Transitional Housing' END AS ProjectType,
    o_orderpriority AS ProjectName FROM orders WHERE o_orderstatus = 'F'"""
PHA_SQL = """SELECT 'PHA0_' || CAST(o_custkey AS {text}) AS pid0,
    CASE WHEN o_orderpriority NOT LIKE '1%' THEN CAST(o_custkey * 700001 AS {text}) END AS ssn_id_m6,
    lower(o_orderpriority) AS lname_new_m6, CASE WHEN o_custkey % 40 = 3 THEN 'anonymous' ELSE 'bo' END AS fname_new_m6,
    '' AS mname_new_m6, CAST(NULL AS {text}) AS lnamesuf_new_m6,
    CAST(DATE '1870-01-01' + CAST(o_custkey * 31 % 40000 + o_orderkey % 3 * 10 AS INT) AS {text}) AS dob,
    CASE o_custkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' END AS gender2,
    CAST(o_orderkey AS {text}) AS lname_new, 'bo' AS fname_new, CAST(NULL AS {text}) AS mname_new,
    CASE o_custkey % 4 WHEN 0 THEN 'Asian only' WHEN 1 THEN 'Multiple race' WHEN 2 THEN 'White only' END AS race_new,
    '0' AS r_aian_new, CAST(NULL AS {text}) AS r_asian_new, CAST(o_custkey % 2 AS {text}) AS r_black_new,
    '0' AS r_nhpi_new, CAST(NULL AS {text}) AS r_white_new, '1' AS r_hisp_new,
    CASE o_orderstatus WHEN 'O' THEN 'SHA' ELSE 'KCHA' END AS agency_new,
    CAST(CAST(floor(o_custkey / 3) AS BIGINT) AS {text}) || '-' || CAST(year(o_orderdate) AS {text}) AS hh_id_new,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Y' WHEN '2' THEN 'H' ELSE 'S' END AS relcode,
    CAST(CAST(o_orderdate AS DATE) + 3200 AS {text}) AS startdate,
    CASE WHEN o_orderpriority NOT LIKE '5%'
        THEN CAST(CAST(o_orderdate AS DATE) + CAST(3150 + floor(o_totalprice / 1000) AS INT) AS {text}) END AS enddate,
    CASE WHEN o_orderpriority LIKE '3%' THEN 'Disabled' END AS disability2,
    'HCV' AS major_prog, 'Tenant' AS prog_type, substr(o_orderpriority, 3, 3) AS subsidy_type,
    CAST(NULL AS {text}) AS vouch_type_final, 'X' AS operator_type, CAST(NULL AS {text}) AS portfolio_final
    FROM orders WHERE o_orderstatus <> 'F'"""
HMIS_DUCK, PHA_DUCK = HMIS_SQL.format(text="VARCHAR"), PHA_SQL.format(text="VARCHAR")


def agency_extracts(spark, folder) -> tuple[DataFrame, DataFrame]:
    table(spark, folder, "orders").createOrReplaceTempView("orders")
    return spark.sql(HMIS_SQL.format(text="STRING")), spark.sql(PHA_SQL.format(text="STRING"))


def identity_sql(source: str, prefix: str, at_least: int) -> str:
    order = "pid0, ssn NULLS LAST, lname, fname, mname, suf NULLS LAST, dob, gen NULLS LAST"
    if prefix == "hmis1_":
        order = order.replace("lname", "raw_dq, lname", 1)
    return f"""SELECT * EXCLUDE (n, raw_dq), '{prefix}' || lpad(CAST(n AS VARCHAR), 6, '0') AS pid1,
        CAST(CASE WHEN year(dob) < 1900 OR year(dob) > 2018 OR (SELECT count(*) FROM ({source}) o
            WHERE o.born = i.dob) >= {at_least} THEN 2 ELSE 1 END AS INTEGER) AS dob_dq
        FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS n
            FROM (SELECT DISTINCT * EXCLUDE (born), born AS dob FROM ({source}))) i"""


HMIS_IDENTITY_SQL = f"""SELECT pid0, SSN AS ssn, CAST(SSNDataQuality AS INTEGER) AS raw_dq, LastName AS lname,
    FirstName AS fname, MiddleName AS mname, NameSuffix AS suf, CAST(DOB AS DATE) AS born,
    CAST(Gender AS INTEGER) AS gen FROM ({HMIS_DUCK})"""
PHA_IDENTITY_SQL = f"""SELECT pid0, ssn_id_m6 AS ssn,
    CASE WHEN ssn_id_m6 IS NULL THEN 3 WHEN length(ssn_id_m6) < 9 THEN 2 ELSE 1 END AS raw_dq,
    lname_new_m6 AS lname, fname_new_m6 AS fname, mname_new_m6 AS mname, lnamesuf_new_m6 AS suf,
    CAST(dob AS DATE) AS born, CASE gender2 WHEN 'Female' THEN 1 WHEN 'Male' THEN 0 END AS gen FROM ({PHA_DUCK})"""


def with_quality(sql: str) -> str:
    return sql.replace("* EXCLUDE (n, raw_dq)", "* EXCLUDE (n, raw_dq), raw_dq AS dq")


@register(
    "prelink",
    f"""WITH u AS (SELECT *, 1 AS src FROM ({with_quality(identity_sql(PHA_IDENTITY_SQL, "pha1_", 64))})
        UNION ALL BY NAME SELECT *, 2 AS src FROM ({with_quality(identity_sql(HMIS_IDENTITY_SQL, "hmis1_", 81))})),
    q AS (SELECT pid0, ssn, upper(lname) AS lname, upper(fname) AS fname, nullif(mname, '') AS mname, suf, dob, gen,
            CAST(CASE WHEN ssn IS NULL THEN NULL WHEN CAST(ssn AS BIGINT) % 111111111 = 0
                AND CAST(ssn AS BIGINT) <= 999999999 THEN 3 WHEN dq > 2 THEN 3 ELSE dq END AS INTEGER) AS ssn_dq,
            CAST(year(dob) AS INTEGER) AS dob_y, CAST(month(dob) AS INTEGER) AS dob_m, CAST(day(dob) AS INTEGER) AS dob_d,
            pid1, dob_dq,
            'pid2_' || lpad(CAST(row_number() OVER (ORDER BY src, length(pid1), pid1) AS VARCHAR), 6, '0') AS pid2
        FROM u)
    SELECT *, CASE WHEN ssn_dq = 1 AND length(ssn) = 9 THEN ssn END AS ssn1,
        CASE WHEN dob_dq = 1 THEN dob END AS dob1,
        CASE WHEN dob_dq = 1 THEN dob_y END AS dob1_y, CASE WHEN dob_dq = 1 THEN dob_m END AS dob1_m,
        CASE WHEN dob_dq = 1 THEN dob_d END AS dob1_d
    FROM q WHERE fname NOT LIKE '%REFUSED%' AND fname NOT LIKE '%ANONYMOUS%'""",
)
def prelink_rows(spark, folder):
    hmis, pha = agency_extracts(spark, folder)
    return prelink(pha, hmis)


MERGED_SQL = f"""SELECT m.*, 'one' AS pid1, 'two' AS pid2, CAST(split_part(m.pid0, '_', 2) AS BIGINT) AS linkage_PID,
    CASE WHEN agency <> 'HMIS' THEN agency || ',' || ha_sub_type || ',NA,X,NA' END AS ha_prog_cat,
    CASE WHEN agency = 'HMIS' THEN agency || ',' || hmis_proj_type || ',' || hmis_proj_name || ',' END AS hmis_prog_cat
    FROM (SELECT pid0, 'HMIS_' || HouseholdID AS hh_id, RelationshipToHoH AS relcode, LastName AS lname,
            FirstName AS fname, MiddleName AS mname,
            CASE Gender WHEN '0' THEN 'Fem' WHEN '1' THEN 'Mal' WHEN '2' THEN 'MTF' WHEN '3' THEN 'FTM'
                WHEN '4' THEN 'GNC' END AS gender, CAST(DOB AS DATE) AS dob,
            CAST(AmIndAKNative AS INTEGER) AS r_aian, CAST(Asian AS INTEGER) AS r_asian,
            CAST(BlackAfAmerican AS INTEGER) AS r_black, CAST(NativeHIOtherPacific AS INTEGER) AS r_nhpi,
            CAST(White AS INTEGER) AS r_white, CAST(Ethnicity AS INTEGER) AS r_ethnicity,
            CAST(EntryDate AS DATE) AS entry, CAST(ExitDate AS DATE) AS exit, 'HMIS' AS agency,
            ProjectType AS hmis_proj_type, ProjectName AS hmis_proj_name FROM ({HMIS_DUCK})
        UNION ALL BY NAME
        SELECT pid0, agency_new || '_' || hh_id_new AS hh_id, relcode, lname_new AS lname, fname_new AS fname,
            mname_new AS mname, CASE gender2 WHEN 'Female' THEN 'Fem' WHEN 'Male' THEN 'Mal' END AS gender,
            CAST(dob AS DATE) AS dob, CASE WHEN FALSE THEN 1 WHEN race_new IS NULL THEN NULL ELSE 0 END AS r_aian,
            CASE WHEN race_new = 'Asian only' THEN 1 END AS r_asian,
            CASE WHEN r_black_new = '1' THEN 1 WHEN race_new IS NULL THEN NULL ELSE 0 END AS r_black,
            CASE WHEN race_new IS NULL THEN NULL ELSE 0 END AS r_nhpi,
            CASE WHEN race_new = 'White only' THEN 1 END AS r_white,
            CASE WHEN race_new = 'Multiple race' THEN 1 WHEN race_new IS NULL THEN NULL ELSE 0 END AS r_multi,
            CAST(r_hisp_new AS INTEGER) AS r_ethnicity, disability2 AS disability, CAST(startdate AS DATE) AS entry,
            CAST(enddate AS DATE) AS exit, agency_new AS agency, major_prog AS ha_maj_prog, prog_type AS ha_prog_type,
            subsidy_type AS ha_sub_type, vouch_type_final AS ha_vouch_type, operator_type AS ha_op_type,
            portfolio_final AS ha_portfolio FROM ({PHA_DUCK})) m"""


def merged_rows(spark, folder) -> DataFrame:
    hmis, pha = agency_extracts(spark, folder)
    ids = hmis.select("pid0").unionByName(pha.select("pid0")).distinct()
    links = ids.select(
        "pid0", F.lit("one").alias("pid1"), F.lit("two").alias("pid2"),
        F.substring_index("pid0", "_", -1).cast("bigint").alias("linkage_PID"),
    )
    return merge_agencies(hmis, pha, links)


@register("merged_agencies", MERGED_SQL)
def merged_agencies(spark, folder):
    return merged_rows(spark, folder)


HOUSEHOLD_SQL = (
    components_sql(
        f"SELECT DISTINCT linkage_PID AS node FROM ({MERGED_SQL})",
        f"""SELECT linkage_PID AS u, min(linkage_PID) OVER (PARTITION BY hh_id) AS v FROM ({MERGED_SQL})""",
    )
    + """ SELECT node, dense_rank() OVER (ORDER BY root) AS h_cluster,
        count(*) OVER (PARTITION BY root) AS h_cluster_ct FROM cc"""
)
PLACED_SQL = f"""SELECT b.linkage_PID, hh_id, relcode, lname, disability, entry, exit, agency, hmis_proj_type, h_cluster,
        h_cluster_ct, h_dob, row_number() OVER (ORDER BY pid0, hh_id, relcode, lname, h_dob) AS place
    FROM ({MERGED_SQL}) b JOIN ({HOUSEHOLD_SQL}) k ON k.node = b.linkage_PID
    JOIN (SELECT linkage_PID AS who, dob AS h_dob FROM (
            SELECT *, bool_or(agency <> 'HMIS') OVER (PARTITION BY linkage_PID) AS has_pha FROM ({MERGED_SQL}))
        WHERE (agency <> 'HMIS') = has_pha GROUP BY linkage_PID, dob
        QUALIFY rank() OVER (PARTITION BY linkage_PID ORDER BY count(*) DESC) = 1) ON who = b.linkage_PID
    WHERE entry >= DATE '2004-01-01'"""


@register(
    "housing_table",
    f"SELECT * EXCLUDE (place) FROM ({spells_sql(household_sql(PLACED_SQL), 'place')})",
)
def housing(spark, folder):
    """From both extracts to the longitudinal housing table."""
    out = housing_table(merged_rows(spark, folder)).withColumn("h_age", F.round("h_age", 6))
    kept = ["linkage_PID", "hh_id", "relcode", "lname", "disability", "entry", "exit", "agency", "hmis_proj_type"]
    return out.select(*kept, *[c for c in out.columns if c.startswith("h_") and c not in kept])
