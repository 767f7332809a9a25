"""Fixed schemas of the warehouse tables (facts, SCD2 histories, report, metadata).

Files are read with an explicit schema, never inferred. An absent table reads
as an empty DataFrame of its schema (``empty``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, TS, D, I, L = T.StringType(), T.TimestampNTZType(), T.DateType(), T.IntegerType(), T.LongType()
AMOUNT = T.DecimalType(38, 10)


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCD2_COLS = (("effective_from", TS), ("effective_to", TS), ("deleted_flag", I))

# Raw file layouts: every column read as text, cast afterwards.
RAW_TRANSACTIONS = _st(("transaction_id", S), ("transaction_date", S), ("amount", S),
                       ("card_num", S), ("oper_type", S), ("oper_result", S), ("terminal", S))
RAW_BLACKLIST = _st(("date", S), ("passport", S))
RAW_TERMINALS = _st(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                    ("terminal_address", S))

# Staged rows: attributes plus the load's business time.
STG_TRANSACTIONS = _st(("trans_id", S), ("trans_date", TS), ("card_num", S), ("oper_type", S),
                       ("amt", AMOUNT), ("oper_result", S), ("terminal", S), ("update_dt", TS))
STG_BLACKLIST = _st(("passport_num", S), ("entry_dt", D), ("update_dt", TS))
STG_TERMINALS = _st(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                    ("terminal_address", S), ("update_dt", TS))

# Facts (append only).
FACT_TRANSACTIONS = _st(("trans_id", S), ("trans_date", TS), ("card_num", S), ("oper_type", S),
                        ("amt", AMOUNT), ("oper_result", S), ("terminal", S))
FACT_BLACKLIST = _st(("passport_num", S), ("entry_dt", D))

# SCD2 histories.
DIM_TERMINALS = _st(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                    ("terminal_address", S), *SCD2_COLS)
DIM_CARDS = _st(("card_num", S), ("account_num", S), *SCD2_COLS)
DIM_ACCOUNTS = _st(("account_num", S), ("valid_to", D), ("client", S), *SCD2_COLS)
DIM_CLIENTS = _st(("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
                  ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D),
                  ("phone", S), *SCD2_COLS)

# Source tables read incrementally (columns the loads select).
SRC_ACCOUNTS = _st(("account", S), ("valid_to", D), ("client", S), ("create_dt", TS), ("update_dt", TS))
SRC_CARDS = _st(("card_num", S), ("account", S), ("create_dt", TS), ("update_dt", TS))
SRC_CLIENTS = _st(("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
                  ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D),
                  ("phone", S), ("create_dt", TS), ("update_dt", TS))

REPORT = _st(("event_dt", TS), ("passport", S), ("fio", S), ("phone", S), ("event_type", S),
             ("report_dt", D))
#: Who owned a card when: the intersected histories, kept from load to load.
OWNERS = _st(("card_num", S), ("account_num", S), ("client_id", S), ("valid_to", D), ("passport_num", S),
             ("passport_valid_to", D), ("fio", S), ("phone", S), ("effective_from", TS), ("effective_to", TS))
#: Per bucket the digest of the source's keys at the last load; and the deliveries that are loaded.
KEY_DIGEST = _st(("bucket", I), ("n", L), ("low", L), ("high", L), ("mixed", L))
META_FILES = _st(("kind", S), ("file", S), ("src_file", S), ("stored", L), ("rejected", L))
META_LOAD = _st(("schema_name", S), ("table_name", S), ("max_update_dt", TS))
TIES = _st(("tie_key", S), ("tie_digest", L), ("tie_second", TS))

# Dimension specs: key, tracked attributes, change-time default of the source.
DIMENSIONS = {
    "terminals": dict(key="terminal_id", attrs=["terminal_type", "terminal_city", "terminal_address"],
                      schema=DIM_TERMINALS),
    "accounts": dict(key="account_num", attrs=["valid_to", "client"], schema=DIM_ACCOUNTS,
                     source_key="account", rename={"account": "account_num"}),
    "cards": dict(key="card_num", attrs=["account_num"], schema=DIM_CARDS,
                  source_key="card_num", rename={"account": "account_num"}),
    "clients": dict(key="client_id",
                    attrs=["last_name", "first_name", "patronymic", "date_of_birth",
                           "passport_num", "passport_valid_to", "phone"],
                    schema=DIM_CLIENTS, source_key="client_id", rename={}),
}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
