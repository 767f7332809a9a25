"""DuckDB SQL for every registered query: the correctness oracle.

The SQL states the same mapping from the driver tables (``sources.mapping``)
as CTEs, and computes each result the plain way: ordinary windows over the
whole key (no time buckets), rules 3 and 4 by joins on row numbers, and the SCD2
load as plain steps. Column names equal the Spark
queries'.
"""

from __future__ import annotations

OPEN = "TIMESTAMP '2990-12-31 00:00:00'"


def _v(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


EV = f"(SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"

TX = f"""tx AS (
  SELECT 'X' || {_v('event_id')} AS trans_id,
         date_trunc('second', ts) AS trans_date,
         'C' || {_v('user_id')} AS card_num,
         CASE WHEN event_type = 'purchase' THEN 'PAYMENT' ELSE 'WITHDRAW' END AS oper_type,
         CAST(value AS DECIMAL(18,2)) AS amt,
         CASE WHEN k % 4 = 0 THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
         CASE WHEN k % 50 = 17 THEN NULL
              ELSE 'T' || {_v('(user_id * 7 + k) % (SELECT count(*) FROM supplier)')} END AS terminal
  FROM {EV} e WHERE event_type <> 'signup')"""

CARD_CHG = f"""card_chg AS (
  SELECT 'C' || {_v('user_id')} AS card_num,
         'A' || {_v('user_id * 10 + k % 10')} AS account_num,
         date_trunc('second', ts) AS update_dt, event_id AS seq
  FROM {EV} e WHERE event_type = 'signup')"""

ACC_CHG = f"""acc_chg AS (
  SELECT 'A' || {_v('o_custkey')} AS account_num,
         CAST(o_orderdate + INTERVAL 23 YEAR AS DATE) + CAST(o_orderkey % 1000 AS INTEGER) AS valid_to,
         'K' || {_v('o_custkey - o_custkey % 10 + o_orderkey % 10')} AS client,
         o_orderdate + INTERVAL 23 YEAR AS update_dt, o_orderkey AS seq
  FROM orders)"""

CLI = f"""cli AS (
  SELECT 'K' || {_v('c_custkey')} AS client_id, c_mktsegment AS last_name, c_name AS first_name,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'P' || {_v('c_nationkey')} END AS patronymic,
         DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS date_of_birth,
         'PS' || {_v('c_custkey')} AS passport_num,
         CASE WHEN c_custkey % 7 = 0 THEN NULL
              ELSE DATE '2023-12-20' + CAST(c_custkey % 300 AS INTEGER) END AS passport_valid_to,
         '+7' || {_v('c_custkey')} AS phone
  FROM customer),
cli_hist AS (
  SELECT *, TIMESTAMP '1900-01-01 00:00:00' AS effective_from, {OPEN} AS effective_to, 0 AS deleted_flag
  FROM cli)"""

BL = f"""bl AS (
  SELECT 'PS' || {_v('c_custkey')} AS passport_num,
         DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS entry_dt
  FROM customer WHERE c_custkey % 11 = 0)"""

SNAPS = f"""snaps AS (
  SELECT v.n, 'T' || {_v('s_suppkey')} AS terminal_id, 'ATM' AS terminal_type,
         'CITY_' || {_v('(s_nationkey + CASE WHEN s_suppkey % 3 = 0 THEN v.n ELSE 0 END) % 25')} AS terminal_city,
         'MAIN STREET 1' AS terminal_address, v.d AS update_dt
  FROM supplier
  JOIN (VALUES (0, TIMESTAMP '2024-01-01 00:00:00'), (1, TIMESTAMP '2024-01-11 00:00:00'),
               (2, TIMESTAMP '2024-01-21 00:00:00')) v(n, d)
    ON s_suppkey % 10 <> v.n + 3)"""

SRC = f"""src AS (
  SELECT 'A' || {_v('o_orderkey')} AS account,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1000 AS INTEGER) AS valid_to,
         'K' || {_v('o_custkey')} AS client,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS create_dt,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + to_days(CAST(o_orderkey % 200 AS INTEGER)) END AS update_dt
  FROM orders)"""


def change_ts(default: str) -> str:
    d = f"TIMESTAMP '{default}'"
    return (f"date_trunc('second', greatest(coalesce(create_dt, {d}), coalesce(update_dt, {d}))"
            f" + INTERVAL 500 MILLISECOND)")


def hist_from_changes(name: str, src: str, key: str, attrs: list[str], extra_where: str = "") -> str:
    """History from a change log with plain windows over the whole key."""
    a = ", ".join(attrs)
    lags = ", ".join(f"lag({x}) OVER w AS p_{x}" for x in attrs)
    diff = " OR ".join(f"{x} IS DISTINCT FROM p_{x}" for x in attrs)
    where = f"WHERE {key} IS NOT NULL AND update_dt IS NOT NULL" + (f" AND {extra_where}" if extra_where else "")
    return f"""{name}_d AS (
  SELECT {key}, {a}, update_dt FROM {src} {where}
  QUALIFY row_number() OVER (PARTITION BY {key}, update_dt ORDER BY seq DESC) = 1),
{name}_l AS (
  SELECT *, lag(update_dt) OVER w AS p_ts, {lags} FROM {name}_d
  WINDOW w AS (PARTITION BY {key} ORDER BY update_dt)),
{name} AS (
  SELECT {key}, {a}, update_dt AS effective_from,
         coalesce(lead(update_dt) OVER (PARTITION BY {key} ORDER BY update_dt) - INTERVAL 1 SECOND, {OPEN}) AS effective_to,
         0 AS deleted_flag
  FROM {name}_l WHERE p_ts IS NULL OR {diff})"""


T_ATTRS = ["terminal_type", "terminal_city", "terminal_address"]


def terminal_hist(name: str, upto: int) -> str:
    """History from snapshots 0..upto: delete at the first snapshot a key misses, then frozen."""
    a = ", ".join(T_ATTRS)
    lags = ", ".join(f"lag({x}) OVER w AS p_{x}" for x in T_ATTRS)
    diff = " OR ".join(f"{x} IS DISTINCT FROM p_{x}" for x in T_ATTRS)
    return f"""{name}_s AS (SELECT terminal_id, {a}, update_dt FROM snaps WHERE n <= {upto}),
{name}_dates AS (
  SELECT update_dt, lead(update_dt) OVER (ORDER BY update_dt) AS next_snap
  FROM (SELECT DISTINCT update_dt FROM {name}_s)),
{name}_n AS (
  SELECT s.*, d.next_snap, lag(s.update_dt) OVER w AS p_ts, {lags},
         lead(s.update_dt) OVER w AS n_ts
  FROM {name}_s s JOIN {name}_dates d ON s.update_dt = d.update_dt
  WINDOW w AS (PARTITION BY terminal_id ORDER BY s.update_dt)),
{name}_g AS (
  SELECT *, min(CASE WHEN next_snap IS NOT NULL AND (n_ts IS NULL OR n_ts <> next_snap) THEN next_snap END)
              OVER (PARTITION BY terminal_id) AS first_del
  FROM {name}_n),
{name}_k AS (
  SELECT * FROM {name}_g
  WHERE (first_del IS NULL OR update_dt < first_del) AND (p_ts IS NULL OR {diff})),
{name} AS (
  SELECT terminal_id, {a}, update_dt AS effective_from,
         CASE WHEN lead(update_dt) OVER w2 IS NOT NULL THEN lead(update_dt) OVER w2 - INTERVAL 1 SECOND
              WHEN first_del IS NOT NULL THEN first_del ELSE {OPEN} END AS effective_to,
         CASE WHEN lead(update_dt) OVER w2 IS NULL AND first_del IS NOT NULL THEN 1 ELSE 0 END AS deleted_flag
  FROM {name}_k WINDOW w2 AS (PARTITION BY terminal_id ORDER BY update_dt))"""


CARD_HIST = hist_from_changes("card_hist", "card_chg", "card_num", ["account_num"])
ACC_HIST = hist_from_changes("acc_hist", "acc_chg", "account_num", ["valid_to", "client"])

# Reference-style three-hop valid-at join (one join per dimension).
ENRICHED = f"""enriched AS (
  SELECT t.trans_id, t.trans_date, t.card_num, t.oper_type, t.amt, t.oper_result, t.terminal,
         a.account_num, k.client_id, a.valid_to, k.passport_num AS passport, k.passport_valid_to,
         concat(coalesce(k.last_name, ''), ' ', coalesce(k.first_name, ''), ' ', coalesce(k.patronymic, '')) AS fio,
         rtrim(k.phone) AS phone
  FROM tx t
  JOIN card_hist c ON t.card_num = c.card_num AND t.trans_date BETWEEN c.effective_from AND c.effective_to AND c.deleted_flag = 0
  JOIN acc_hist a ON c.account_num = a.account_num AND t.trans_date BETWEEN a.effective_from AND a.effective_to AND a.deleted_flag = 0
  JOIN cli_hist k ON a.client = k.client_id AND t.trans_date BETWEEN k.effective_from AND k.effective_to AND k.deleted_flag = 0)"""

ENRICHED_T = f"""enriched_t AS (
  SELECT e.*, h.terminal_city FROM enriched e
  JOIN t_hist h ON e.terminal = h.terminal_id AND e.trans_date BETWEEN h.effective_from AND h.effective_to
   AND h.deleted_flag = 0)"""

BASE = ",\n".join([TX, CARD_CHG, ACC_CHG, CLI, BL, SNAPS, CARD_HIST, ACC_HIST, terminal_hist("t_hist", 2),
                   ENRICHED, ENRICHED_T])


def rule1() -> str:
    return """SELECT e.trans_date AS event_dt, e.passport, e.fio, e.phone, 1 AS event_type
  FROM enriched e LEFT JOIN bl ON bl.passport_num = e.passport AND e.trans_date >= CAST(bl.entry_dt AS TIMESTAMP)
  WHERE (e.passport_valid_to IS NOT NULL AND CAST(e.passport_valid_to AS TIMESTAMP) < e.trans_date)
     OR bl.passport_num IS NOT NULL"""


def rule2() -> str:
    return """SELECT trans_date AS event_dt, passport, fio, phone, 2 AS event_type
  FROM enriched WHERE CAST(valid_to AS TIMESTAMP) < trans_date"""


# A card's operations at a known terminal, numbered; neighbours are found by number, not by LAG.
NUMBERED = """(SELECT *, row_number() OVER (PARTITION BY card_num ORDER BY trans_date, trans_id) AS rn FROM enriched_t)"""


def rule3() -> str:
    return f"""SELECT now.trans_date AS event_dt, now.passport, now.fio, now.phone, 3 AS event_type
  FROM {NUMBERED} now JOIN {NUMBERED} before ON before.card_num = now.card_num AND before.rn + 1 = now.rn
  WHERE before.terminal_city <> now.terminal_city AND now.trans_date <= before.trans_date + INTERVAL 1 HOUR"""


def rule4(span: str = "INTERVAL 20 MINUTE") -> str:
    return f"""SELECT any_value(last.trans_date) AS event_dt, any_value(last.passport) AS passport, any_value(last.fio) AS fio,
         any_value(last.phone) AS phone, 4 AS event_type
  FROM {NUMBERED} last JOIN {NUMBERED} part ON part.card_num = last.card_num AND part.rn BETWEEN last.rn - 3 AND last.rn
  GROUP BY last.card_num, last.rn
  HAVING count(*) = 4 AND max(part.trans_date) - min(part.trans_date) <= {span}
     AND bool_and(part.oper_type = 'WITHDRAW')
     AND string_agg(part.oper_result, ',' ORDER BY part.rn) = 'REJECT,REJECT,REJECT,SUCCESS'
     AND count(DISTINCT part.amt) = 4 AND count(part.amt) = 4
     AND list(part.amt ORDER BY part.rn) = list_reverse_sort(list(part.amt))"""


def report_sql(report_dt: str, span: str = "INTERVAL 20 MINUTE") -> str:
    """The four rules inserted in order; first row per (event_dt, passport) wins; NULL passports all kept."""
    return f"""rules AS (
  {rule1()}
  UNION ALL {rule2()}
  UNION ALL {rule3()}
  UNION ALL {rule4(span)}),
rep_keyed AS (
  SELECT event_dt, passport, fio, phone, event_type FROM rules WHERE passport IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_dt, passport ORDER BY event_type, fio, phone) = 1),
rep AS (
  SELECT event_dt, passport, fio, phone, CAST(event_type AS VARCHAR) AS event_type, DATE '{report_dt}' AS report_dt
  FROM (SELECT * FROM rep_keyed UNION ALL SELECT event_dt, passport, fio, phone, event_type FROM rules WHERE passport IS NULL))"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


M_ATTRS = T_ATTRS
DIFF_T = " OR ".join(f"s.{x} IS DISTINCT FROM h.{x}" for x in M_ATTRS)
H0_S1 = [SNAPS, terminal_hist("h0", 0), f"stg AS (SELECT terminal_id, {', '.join(T_ATTRS)}, update_dt FROM snaps WHERE n = 1)"]

# Reference statement sequence of one snapshot load (insert, close, open, delete).
MERGE_SNAPSHOT = [
    *H0_S1,
    f"""ins AS (
  SELECT s.terminal_id, s.terminal_type, s.terminal_city, s.terminal_address, s.update_dt AS effective_from,
         {OPEN} AS effective_to, 0 AS deleted_flag
  FROM stg s WHERE s.terminal_id NOT IN (SELECT terminal_id FROM h0))""",
    "h1 AS (SELECT * FROM h0 UNION ALL SELECT * FROM ins)",
    f"""chg AS (
  SELECT s.* FROM stg s JOIN h1 h ON s.terminal_id = h.terminal_id
  WHERE ({DIFF_T}) AND h.effective_to >= {OPEN} AND s.update_dt > h.effective_from)""",
    f"""h2 AS (
  SELECT h.terminal_id, h.terminal_type, h.terminal_city, h.terminal_address, h.effective_from,
         CASE WHEN c.terminal_id IS NOT NULL AND h.effective_to >= {OPEN} THEN c.update_dt - INTERVAL 1 SECOND
              ELSE h.effective_to END AS effective_to, h.deleted_flag
  FROM h1 h LEFT JOIN chg c ON h.terminal_id = c.terminal_id)""",
    f"""h3 AS (
  SELECT * FROM h2 UNION ALL
  SELECT terminal_id, terminal_type, terminal_city, terminal_address, update_dt, {OPEN}, 0 FROM chg)""",
    """del AS (
  SELECT h.terminal_id, max(h.effective_to) AS max_end_dt FROM h3 h
  WHERE h.terminal_id NOT IN (SELECT terminal_id FROM stg) GROUP BY h.terminal_id)""",
]
MERGE_SNAPSHOT_OUT = """SELECT h.terminal_id, h.terminal_type, h.terminal_city, h.terminal_address, h.effective_from,
       CASE WHEN d.terminal_id IS NOT NULL AND h.effective_to = d.max_end_dt THEN TIMESTAMP '2024-01-11 00:00:00'
            ELSE h.effective_to END AS effective_to,
       CASE WHEN d.terminal_id IS NOT NULL AND h.effective_to = d.max_end_dt THEN 1 ELSE h.deleted_flag END AS deleted_flag
FROM h3 h LEFT JOIN del d ON h.terminal_id = d.terminal_id"""

A_DIFF = "s.valid_to IS DISTINCT FROM h.valid_to OR s.client IS DISTINCT FROM h.client"
MERGE_INCREMENTAL = [
    ACC_CHG,
    hist_from_changes("h0", "acc_chg", "account_num", ["valid_to", "client"],
                      "update_dt < TIMESTAMP '2023-01-01 00:00:00'"),
    "slice AS (SELECT * FROM acc_chg WHERE CAST(substr(account_num, 2) AS BIGINT) % 17 <> 3)",
    """stg AS (
  SELECT account_num, valid_to, client, update_dt FROM slice WHERE update_dt >= TIMESTAMP '2023-01-01 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY account_num ORDER BY update_dt DESC, seq DESC) = 1)""",
    f"""ins AS (
  SELECT s.account_num, s.valid_to, s.client, s.update_dt AS effective_from, {OPEN} AS effective_to, 0 AS deleted_flag
  FROM stg s WHERE s.account_num NOT IN (SELECT account_num FROM h0))""",
    "h1 AS (SELECT * FROM h0 UNION ALL SELECT * FROM ins)",
    f"""chg AS (
  SELECT s.* FROM stg s JOIN h1 h ON s.account_num = h.account_num
  WHERE ({A_DIFF}) AND h.effective_to >= {OPEN} AND s.update_dt > h.effective_from)""",
    f"""h2 AS (
  SELECT h.account_num, h.valid_to, h.client, h.effective_from,
         CASE WHEN c.account_num IS NOT NULL AND h.effective_to >= {OPEN} THEN c.update_dt - INTERVAL 1 SECOND
              ELSE h.effective_to END AS effective_to, h.deleted_flag
  FROM h1 h LEFT JOIN chg c ON h.account_num = c.account_num)""",
    f"""h3 AS (
  SELECT * FROM h2 UNION ALL SELECT account_num, valid_to, client, update_dt, {OPEN}, 0 FROM chg)""",
    """del AS (
  SELECT h.account_num, max(h.effective_to) AS max_end_dt FROM h3 h
  WHERE h.account_num NOT IN (SELECT account_num FROM slice) GROUP BY h.account_num)""",
]
MERGE_INCREMENTAL_OUT = """SELECT h.account_num, h.valid_to, h.client, h.effective_from,
       CASE WHEN d.account_num IS NOT NULL AND h.effective_to = d.max_end_dt THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE h.effective_to END AS effective_to,
       CASE WHEN d.account_num IS NOT NULL AND h.effective_to = d.max_end_dt THEN 1 ELSE h.deleted_flag END AS deleted_flag
FROM h3 h LEFT JOIN del d ON h.account_num = d.account_num"""

RAW_TX = f"""raw AS (
  SELECT trans_id AS transaction_id, strftime(trans_date, '%Y-%m-%d %H:%M:%S') AS transaction_date,
         replace(CAST(amt AS VARCHAR), '.', ',') AS amount, card_num, oper_type, oper_result, terminal,
         'transactions_' || strftime(trans_date, '%d%m%Y') || '.txt' AS file_name
  FROM tx)"""

FILE_DATE = "CAST(strptime(regexp_extract(file_name, '(\\d+)', 1), '%d%m%Y') AS DATE)"

STAGED_SRC = f"""SELECT account AS account_num, valid_to, client, {change_ts('1900-01-01 00:00:00')} AS update_dt
FROM src WHERE {change_ts('1900-01-01 00:00:00')} > TIMESTAMP '2001-01-01 00:00:00'"""

#: What a first load saw, before the rows with an update time came, and its watermark.
FIRST_LOAD = f"""ct AS (SELECT *, {change_ts('1900-01-01 00:00:00')} AS change_ts,
         update_dt IS NULL AND create_dt IS NOT NULL AND create_dt <= TIMESTAMP '2001-01-01 00:00:00' AS early FROM src),
w1 AS (SELECT max(change_ts) AS second FROM ct WHERE early)"""

C_ATTRS = ["last_name", "first_name", "patronymic", "date_of_birth", "passport_num", "passport_valid_to", "phone"]
CLI_CHG = f"""cli_chg AS (
  SELECT client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, rpad(phone, 16, ' ') AS phone,
         TIMESTAMP '1900-01-01 00:00:00' AS update_dt, 0 AS seq FROM cli
  UNION ALL
  SELECT 'K' || {_v('c_custkey')}, c_mktsegment, c_name, NULL, DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER),
         CASE WHEN c_custkey % 16 <> 9 THEN 'PS' || {_v('c_custkey')} END, CASE WHEN c_custkey % 8 <> 1 THEN DATE '2024-01-01' END,
         rpad('+8' || {_v('c_custkey')}, 16, ' '), CAST(DATE '2024-01-01' + CAST(c_custkey % 25 AS INTEGER) AS TIMESTAMP), 1
  FROM customer WHERE c_custkey % 4 = 1)"""
#: The clients' states without the single-version history that the older queries use.
CLI_ONLY = CLI[:CLI.index(",\ncli_hist AS")]


def cli_versions(name: str, before: bool = False) -> str:
    return hist_from_changes(name, "cli_chg", "client_id", C_ATTRS, "update_dt < TIMESTAMP '2024-01-01 00:00:00'" if before else "")


def merge_sql(key: str, attrs: list[str], changes: list[str], hist: str, gone: str, split: str, delete_ts: str) -> str:
    """One load by the sequence insert, close, open, delete; ``changes`` are CTEs that end with ``chg_all``."""
    a = ", ".join(attrs)
    diff = " OR ".join(f"s.{x} IS DISTINCT FROM h.{x}" for x in attrs)
    sa = ", ".join(f"s.{x}" for x in attrs)
    ha = ", ".join(f"h.{x}" for x in attrs)
    return w(*changes, hist, f"slice AS (SELECT * FROM chg_all WHERE CAST(substr({key}, 2) AS BIGINT) % {gone})", f"""stg AS (
  SELECT {key}, {a}, update_dt FROM slice WHERE update_dt >= TIMESTAMP '{split}'
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY update_dt DESC, seq DESC) = 1)""", f"""h1 AS (
  SELECT {key}, {a}, effective_from, effective_to, deleted_flag FROM h0
  UNION ALL SELECT {key}, {a}, update_dt, {OPEN}, 0 FROM stg WHERE {key} NOT IN (SELECT {key} FROM h0))""", f"""changed AS (
  SELECT s.* FROM stg s JOIN h1 h USING ({key}) WHERE ({diff}) AND h.effective_to >= {OPEN} AND s.update_dt > h.effective_from)""", f"""h2 AS (
  SELECT h.{key}, {ha}, h.effective_from, CASE WHEN s.{key} IS NOT NULL AND h.effective_to >= {OPEN} THEN s.update_dt - INTERVAL 1 SECOND
         ELSE h.effective_to END AS effective_to, h.deleted_flag FROM h1 h LEFT JOIN changed s ON s.{key} = h.{key}
  UNION ALL SELECT s.{key}, {sa}, s.update_dt, {OPEN}, 0 FROM changed s)""", f"""last AS (
  SELECT {key}, max(effective_to) AS m FROM h2 WHERE {key} NOT IN (SELECT {key} FROM slice) GROUP BY {key})""") + f"""SELECT h.{key}, {ha}, h.effective_from,
  CASE WHEN h.effective_to = m THEN TIMESTAMP '{delete_ts}' ELSE h.effective_to END AS effective_to,
  CASE WHEN h.effective_to = m THEN 1 ELSE h.deleted_flag END AS deleted_flag
FROM h2 h LEFT JOIN last ON last.{key} = h.{key}"""


def report_with(clients: str) -> str:
    """The whole report with the client versions of one time."""
    return (w(TX, CARD_CHG, ACC_CHG, CLI_ONLY, CLI_CHG, clients, BL, SNAPS, CARD_HIST, ACC_HIST, terminal_hist("t_hist", 2), ENRICHED, ENRICHED_T,
              report_sql("2024-02-01")) + "SELECT * FROM rep")


VALID_AT_CARD = w(TX, CARD_CHG, CARD_HIST) + """SELECT t.trans_id, t.trans_date, t.card_num, c.account_num, c.effective_from, c.effective_to
FROM card_hist c JOIN tx t USING (card_num) WHERE c.deleted_flag = 0 AND c.effective_from <= t.trans_date AND t.trans_date <= c.effective_to"""

ORACLE: dict[str, str] = {
    "scd2_from_changes_clients": w(CLI_ONLY, CLI_CHG, cli_versions("h")) + "SELECT * FROM h",
    "scd2_merge_cards": merge_sql("card_num", ["account_num"], [CARD_CHG, "chg_all AS (SELECT * FROM card_chg)"], hist_from_changes(
        "h0", "card_chg", "card_num", ["account_num"], "update_dt < TIMESTAMP '2024-01-12 00:00:00'"), "13 <> 5", "2024-01-12 00:00:00", "2024-02-01 00:00:00"),
    "scd2_merge_clients": merge_sql("client_id", C_ATTRS, [CLI_ONLY, CLI_CHG, "chg_all AS (SELECT * FROM cli_chg)"], cli_versions("h0", True),
                                    "19 <> 7", "2024-01-01 00:00:00", "2024-02-01 00:00:00"),
    "owner_history_versions": w(CARD_CHG, ACC_CHG, CLI_ONLY, CLI_CHG, CARD_HIST, ACC_HIST, cli_versions("cli_hist")) + """SELECT * FROM (
  SELECT c.card_num, a.account_num, k.client_id, a.valid_to, k.passport_num, k.passport_valid_to,
         concat(coalesce(k.last_name, ''), ' ', coalesce(k.first_name, ''), ' ', coalesce(k.patronymic, '')) AS fio, rtrim(k.phone) AS phone,
         greatest(c.effective_from, a.effective_from, k.effective_from) AS effective_from, least(c.effective_to, a.effective_to, k.effective_to) AS effective_to
  FROM card_hist c JOIN acc_hist a USING (account_num) JOIN cli_hist k ON k.client_id = a.client) WHERE effective_from <= effective_to""",
    "report_affected": f"""WITH earlier AS ({report_with(cli_versions("cli_hist", True))}), now AS ({report_with(cli_versions("cli_hist"))})
SELECT * FROM now n WHERE NOT EXISTS (SELECT 1 FROM earlier o WHERE o.event_dt = n.event_dt AND (o.passport = n.passport OR (
  o.passport IS NULL AND n.passport IS NULL AND o.fio = n.fio AND o.phone = n.phone AND o.event_type = n.event_type)))""",
    "valid_at_card_slots": VALID_AT_CARD,
    "valid_at_terminal_slots_left": w(TX, SNAPS, terminal_hist("t_hist", 2)) + """SELECT t.trans_id, t.trans_date, t.terminal,
       h.terminal_city, h.effective_from, h.effective_to
FROM tx t LEFT JOIN (SELECT * FROM t_hist WHERE deleted_flag = 0) h
  ON h.terminal_id = t.terminal AND h.effective_from <= t.trans_date AND t.trans_date <= h.effective_to""",
    "stage_transactions": w(TX, RAW_TX) + f"""SELECT transaction_id AS trans_id,
       date_trunc('second', strptime(trim(transaction_date), '%Y-%m-%d %H:%M:%S') + INTERVAL 500 MILLISECOND) AS trans_date,
       card_num, oper_type, CAST(replace(trim(amount), ',', '.') AS DECIMAL(38,10)) AS amt, oper_result, terminal,
       CAST({FILE_DATE} AS TIMESTAMP) AS update_dt
FROM raw""",
    "file_date_parse": w(TX, RAW_TX) + f"SELECT DISTINCT file_name, {FILE_DATE} AS file_date FROM raw",
    "facts_append": w(TX) + """SELECT * FROM tx
UNION ALL
SELECT CAST(NULL AS VARCHAR) AS trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal
FROM tx WHERE trans_date < TIMESTAMP '2024-01-02 00:00:00'""",
    "daily_slice": w(BL) + "SELECT passport_num, entry_dt, TIMESTAMP '2024-01-05 00:00:00' AS update_dt FROM bl "
                           "WHERE entry_dt = DATE '2024-01-05'",
    "full_name": w(CLI) + "SELECT client_id, concat(coalesce(last_name, ''), ' ', coalesce(first_name, ''), ' ', "
                          "coalesce(patronymic, '')) AS fio FROM cli",
    "change_time": w(SRC) + f"""SELECT account, create_dt, update_dt, {change_ts('1900-01-01 00:00:00')} AS change_ts,
       {change_ts('2001-01-01 00:00:00')} AS change_ts_cards FROM src""",
    "source_changes": w(SRC) + STAGED_SRC,
    "source_changes_late": w(SRC, FIRST_LOAD) + """SELECT account AS account_num, valid_to, client, change_ts AS update_dt
FROM ct, w1 WHERE change_ts > second OR change_ts = second AND NOT early""",
    "watermark_ties": w(SRC, FIRST_LOAD) + """SELECT DISTINCT account AS account_num, change_ts AS update_dt
FROM ct, w1 WHERE change_ts = second AND (early OR update_dt IS NOT NULL)""",
    "card_rules_stream": w(BASE) + f"""SELECT * FROM ({rule3()} UNION ALL {rule4("INTERVAL 96 HOUR")})
WHERE event_dt <= (SELECT max(trans_date) FROM enriched_t) - INTERVAL 1 HOUR""",
    "watermark_advance": w(SRC, f"stg AS ({STAGED_SRC})") + """SELECT 'public' AS schema_name, 'info.accounts' AS table_name,
       coalesce((SELECT max(update_dt) FROM stg), TIMESTAMP '2001-01-01 00:00:00') AS max_update_dt""",
    "scd2_from_changes": w(ACC_CHG, ACC_HIST) + "SELECT * FROM acc_hist",
    "scd2_from_changes_cards": w(CARD_CHG, CARD_HIST) + "SELECT * FROM card_hist",
    "current_view": w(ACC_CHG, ACC_HIST) + f"SELECT * FROM acc_hist WHERE effective_to >= {OPEN} AND deleted_flag = 0",
    "as_of": w(ACC_CHG, ACC_HIST) + "SELECT * FROM acc_hist WHERE deleted_flag = 0 AND "
                                    "TIMESTAMP '2024-01-10 12:00:00' BETWEEN effective_from AND effective_to",
    "scd2_from_snapshots": w(SNAPS, terminal_hist("t_hist", 2)) + "SELECT * FROM t_hist",
    "latest_end": w(SNAPS, terminal_hist("t_hist", 2)) + "SELECT terminal_id, max(effective_to) AS max_end_dt "
                                                         "FROM t_hist GROUP BY terminal_id",
    "new_keys": w(*H0_S1) + f"""SELECT s.terminal_id, s.terminal_type, s.terminal_city, s.terminal_address,
       s.update_dt AS effective_from, {OPEN} AS effective_to, 0 AS deleted_flag
FROM stg s LEFT JOIN h0 h ON s.terminal_id = h.terminal_id WHERE h.terminal_id IS NULL""",
    "changed_rows": w(*H0_S1) + f"""SELECT s.terminal_id, s.terminal_type, s.terminal_city, s.terminal_address, s.update_dt,
       h.effective_from AS prev_effective_from
FROM stg s JOIN h0 h ON s.terminal_id = h.terminal_id
WHERE ({DIFF_T}) AND h.effective_to >= {OPEN} AND s.update_dt > h.effective_from""",
    "missing_keys": w(*H0_S1) + """SELECT h.terminal_id, max(h.effective_to) AS max_end_dt,
       coalesce(max(CASE WHEN h.deleted_flag = 1 THEN h.effective_to END) = max(h.effective_to), NULL) AS already_deleted
FROM h0 h LEFT JOIN stg s ON s.terminal_id = h.terminal_id WHERE s.terminal_id IS NULL GROUP BY h.terminal_id""",
    "scd2_merge_snapshot": w(*MERGE_SNAPSHOT) + MERGE_SNAPSHOT_OUT,
    "scd2_soft_delete": w(*H0_S1) + """SELECT h.terminal_id, h.terminal_type, h.terminal_city, h.terminal_address,
       h.effective_from, TIMESTAMP '2024-01-11 00:00:00' AS effective_to, 1 AS deleted_flag
FROM h0 h JOIN (SELECT terminal_id, max(effective_to) AS m FROM h0
                WHERE terminal_id NOT IN (SELECT terminal_id FROM stg) GROUP BY terminal_id) d
  ON h.terminal_id = d.terminal_id AND h.effective_to = d.m""",
    "scd2_merge_incremental": w(*MERGE_INCREMENTAL) + MERGE_INCREMENTAL_OUT,
    "valid_at_card": w(TX, CARD_CHG, CARD_HIST) + """SELECT t.trans_id, t.trans_date, t.card_num, c.account_num,
       c.effective_from, c.effective_to
FROM tx t JOIN card_hist c ON t.card_num = c.card_num AND t.trans_date BETWEEN c.effective_from AND c.effective_to
 AND c.deleted_flag = 0""",
    "valid_at_terminal": w(TX, SNAPS, terminal_hist("t_hist", 2)) + """SELECT t.trans_id, t.trans_date, t.terminal,
       h.terminal_city, h.effective_from, h.effective_to
FROM tx t JOIN t_hist h ON t.terminal = h.terminal_id AND t.trans_date BETWEEN h.effective_from AND h.effective_to
 AND h.deleted_flag = 0""",
    "valid_at_card_sweep": w(TX, CARD_CHG, CARD_HIST) + """SELECT t.trans_id, t.trans_date, t.card_num,
       (SELECT max(c.account_num) FROM card_hist c WHERE c.card_num = t.card_num AND c.deleted_flag = 0
         AND c.effective_from <= t.trans_date AND t.trans_date <= c.effective_to) AS account_num
FROM tx t WHERE EXISTS (SELECT 1 FROM card_hist c WHERE c.card_num = t.card_num AND c.deleted_flag = 0
         AND c.effective_from <= t.trans_date AND t.trans_date <= c.effective_to)""",
    "valid_at_terminal_sweep_left": w(TX, SNAPS, terminal_hist("t_hist", 2)) + """SELECT t.trans_id, t.trans_date, t.terminal,
       h.terminal_city, h.effective_from, h.effective_to
FROM tx t LEFT JOIN t_hist h ON t.terminal = h.terminal_id AND t.trans_date BETWEEN h.effective_from AND h.effective_to
 AND h.deleted_flag = 0""",
    "owner_history": w(CARD_CHG, ACC_CHG, CLI, CARD_HIST, ACC_HIST) + """SELECT c.card_num, a.account_num, k.client_id,
       a.valid_to, k.passport_num, k.passport_valid_to,
       concat(coalesce(k.last_name, ''), ' ', coalesce(k.first_name, ''), ' ', coalesce(k.patronymic, '')) AS fio,
       rtrim(k.phone) AS phone,
       greatest(c.effective_from, a.effective_from, k.effective_from) AS effective_from,
       least(c.effective_to, a.effective_to, k.effective_to) AS effective_to
FROM card_hist c
JOIN acc_hist a ON c.account_num = a.account_num AND c.effective_from <= a.effective_to AND a.effective_from <= c.effective_to
JOIN cli_hist k ON a.client = k.client_id
 AND greatest(c.effective_from, a.effective_from) <= k.effective_to
 AND k.effective_from <= least(c.effective_to, a.effective_to)
WHERE c.deleted_flag = 0 AND a.deleted_flag = 0 AND k.deleted_flag = 0""",
    "enriched": w(BASE) + "SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal, account_num, "
                          "client_id, valid_to, passport, passport_valid_to, fio, phone FROM enriched",
    "enriched_terminal": w(BASE) + "SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal, "
                                   "account_num, client_id, valid_to, passport, passport_valid_to, fio, phone, "
                                   "terminal_city FROM enriched_t",
    "rule_passport": w(BASE) + rule1(),
    "rule_agreement": w(BASE) + rule2(),
    "rule_city_jump": w(BASE) + rule3(),
    "rule_amount_probe": w(BASE) + rule4(),
    "rule_amount_probe_wide": w(BASE) + rule4("INTERVAL 96 HOUR"),
    "fraud_report": w(BASE, report_sql("2024-02-01")) + "SELECT * FROM rep",
    "fraud_report_wide": w(BASE, report_sql("2024-02-01", "INTERVAL 96 HOUR")) + "SELECT * FROM rep",
    "report_incremental": w(BASE, report_sql("2024-02-01")) + f""", old AS (
  SELECT event_dt, passport, fio, phone, CAST(2 AS VARCHAR) AS event_type, DATE '2024-01-15' AS report_dt
  FROM ({rule2()}) WHERE event_dt < TIMESTAMP '2024-01-15 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY event_dt, passport ORDER BY fio, phone) = 1)
SELECT * FROM old
UNION ALL
SELECT * FROM rep r WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.event_dt = r.event_dt AND o.passport = r.passport)""",
}
