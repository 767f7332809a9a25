"""Bank model views derived from the driver's test tables.

The reference reads bank extracts that are not part of the test data; these
views build the same shapes from ``events``, ``orders``, ``customer`` and
``supplier`` so every registered query reads the given tables and grows with
them. The oracle SQL in ``txnwatch.plans.oracle`` states the same mapping.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.functions import scalars as X

# Fixed parameters of the mapping (shared with the oracle SQL).
TERMINAL_SNAPSHOT_DATES = (dt.date(2024, 1, 1), dt.date(2024, 1, 11), dt.date(2024, 1, 21))
TERMINAL_TYPE = "ATM"
TERMINAL_ADDRESS = "MAIN STREET 1"
CLIENT_VERSION_START = dt.datetime(1900, 1, 1)
ACCOUNT_YEAR_SHIFT = 23
BLACKLIST_BASE = dt.date(2024, 1, 1)
PASSPORT_BASE = dt.date(2023, 12, 20)
BIRTH_BASE = dt.date(1950, 1, 1)


# Columns of the driver tables that the mapping reads (types as stored). Reading
# with an explicit schema skips Parquet schema inference (one job per read) and
# states the column pruning up front.
DRIVER_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if name in DRIVER_SCHEMAS:
        return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a file stream; the pattern matches its one file or its folder of files."""
    return spark.readStream.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parque[t]")


K = "CAST(get_json_object(props, '$.k') AS BIGINT)"


def _s(prefix: str, expr: str) -> str:
    return f"concat('{prefix}', CAST({expr} AS STRING))"


def _d(value: dt.date) -> str:
    return f"DATE '{value.isoformat()}'"


def transactions(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Fact rows: every non-signup event is a card operation."""
    events = (table_stream if stream else table)(spark, sf_dir, "events")
    suppliers = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    ev = events.where("event_type <> 'signup'").select(
        "event_id", "ts", "user_id", "event_type", "value", F.expr(K).alias("k"), suppliers.alias("_suppliers"))
    return ev.selectExpr(
        f"{_s('X', 'event_id')} AS trans_id",
        f"{X.trunc_second_sql('ts')} AS trans_date",
        f"{_s('C', 'user_id')} AS card_num",
        "CASE WHEN event_type = 'purchase' THEN 'PAYMENT' ELSE 'WITHDRAW' END AS oper_type",
        "CAST(value AS DECIMAL(18,2)) AS amt",
        "CASE WHEN k % 4 = 0 THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result",
        # terminals over all suppliers; some operations have none
        f"CASE WHEN k % 50 = 17 THEN NULL ELSE {_s('T', '(user_id * 7 + k) % _suppliers')} END AS terminal")


def card_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card → account assignments; a signup event is a change of its card."""
    ev = table(spark, sf_dir, "events").where("event_type = 'signup'")
    return ev.selectExpr(
        f"{_s('C', 'user_id')} AS card_num",
        f"{_s('A', f'user_id * 10 + {K} % 10')} AS account_num",
        f"{X.trunc_second_sql('ts')} AS update_dt",
        "event_id AS seq")


def account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account versions from orders: the order date shifted into the events' years."""
    upd = f"(o_orderdate + INTERVAL '{ACCOUNT_YEAR_SHIFT}' YEAR)"
    return table(spark, sf_dir, "orders").selectExpr(
        f"{_s('A', 'o_custkey')} AS account_num",
        f"date_add(to_date({upd}), CAST(o_orderkey % 1000 AS INT)) AS valid_to",
        f"{_s('K', 'o_custkey - o_custkey % 10 + o_orderkey % 10')} AS client",
        f"{upd} AS update_dt",
        "o_orderkey AS seq")


CLIENT_COLS = [
    f"{_s('K', 'c_custkey')} AS client_id",
    "c_mktsegment AS last_name",
    "c_name AS first_name",
    f"CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE {_s('P', 'c_nationkey')} END AS patronymic",
    f"date_add({_d(BIRTH_BASE)}, CAST(c_custkey % 20000 AS INT)) AS date_of_birth",
    f"{_s('PS', 'c_custkey')} AS passport_num",
    f"CASE WHEN c_custkey % 7 = 0 THEN CAST(NULL AS DATE) "
    f"ELSE date_add({_d(PASSPORT_BASE)}, CAST(c_custkey % 300 AS INT)) END AS passport_valid_to",
    f"{_s('+7', 'c_custkey')} AS phone",
]


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client source rows (one state per customer)."""
    return table(spark, sf_dir, "customer").selectExpr(*CLIENT_COLS)


def client_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients as one version each, open from 1900-01-01."""
    return table(spark, sf_dir, "customer").selectExpr(
        *CLIENT_COLS, f"{X.ntz_sql(CLIENT_VERSION_START)} AS effective_from",
        f"{X.ntz_sql(X.OPEN_END)} AS effective_to", "0 AS deleted_flag")


#: Client changes: the first state of all clients, and a later one of every fourth.
CLIENT_CHANGE_BASE = dt.date(2024, 1, 1)
CLIENT_ATTRS = ["last_name", "first_name", "patronymic", "date_of_birth", "passport_num", "passport_valid_to", "phone"]


def client_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client states with their change times. Phones are blank-padded; a later state has another passport date or none, no
    patronymic, and of every sixteenth client no passport number."""
    first = clients(spark, sf_dir).selectExpr(
        "client_id", *[c for c in CLIENT_ATTRS if c != "phone"], "rpad(phone, 16, ' ') AS phone", f"{X.ntz_sql(CLIENT_VERSION_START)} AS update_dt")
    later = table(spark, sf_dir, "customer").where("c_custkey % 4 = 1").selectExpr(
        *[c for c in CLIENT_COLS if c.rsplit(" AS ", 1)[1] in ("client_id", "last_name", "first_name", "date_of_birth")],
        "CAST(NULL AS STRING) AS patronymic",
        f"CASE WHEN c_custkey % 16 = 9 THEN CAST(NULL AS STRING) ELSE {_s('PS', 'c_custkey')} END AS passport_num",
        f"CASE WHEN c_custkey % 8 = 1 THEN CAST(NULL AS DATE) ELSE {_d(CLIENT_CHANGE_BASE)} END AS passport_valid_to",
        f"rpad({_s('+8', 'c_custkey')}, 16, ' ') AS phone",
        f"CAST(date_add({_d(CLIENT_CHANGE_BASE)}, CAST(c_custkey % 25 AS INT)) AS TIMESTAMP_NTZ) AS update_dt")
    return first.unionByName(later)


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 11 = 0").selectExpr(
        f"{_s('PS', 'c_custkey')} AS passport_num",
        f"date_add({_d(BLACKLIST_BASE)}, CAST(c_custkey % 30 AS INT)) AS entry_dt")


def terminal_snapshot(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Full terminal snapshot number ``n`` (0, 1, 2): one row per present terminal."""
    return table(spark, sf_dir, "supplier").where(f"s_suppkey % 10 <> {n + 3}").selectExpr(
        f"{_s('T', 's_suppkey')} AS terminal_id",
        f"'{TERMINAL_TYPE}' AS terminal_type",
        f"{_s('CITY_', f'(s_nationkey + CASE WHEN s_suppkey % 3 = 0 THEN {n} ELSE 0 END) % 25')} AS terminal_city",
        f"'{TERMINAL_ADDRESS}' AS terminal_address",
        f"{X.ntz_sql(TERMINAL_SNAPSHOT_DATES[n])} AS update_dt")


def terminal_snapshots(spark: SparkSession, sf_dir: str, upto: int = 2) -> DataFrame:
    return reduce(DataFrame.unionByName, [terminal_snapshot(spark, sf_dir, n) for n in range(upto + 1)])


def incremental_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An accounts-shaped source table with create/update times, read incrementally."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"{_s('A', 'o_orderkey')} AS account",
        "date_add(to_date(o_orderdate), CAST(o_orderkey % 1000 AS INT)) AS valid_to",
        f"{_s('K', 'o_custkey')} AS client",
        "CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS TIMESTAMP_NTZ) ELSE o_orderdate END AS create_dt",
        "CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + make_dt_interval(CAST(o_orderkey % 200 AS INT)) "
        "ELSE CAST(NULL AS TIMESTAMP_NTZ) END AS update_dt")
