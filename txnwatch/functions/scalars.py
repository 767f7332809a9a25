"""Column expressions shared by the loaders, the SCD2 operators and the rules.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen. All timestamps are ``TIMESTAMP_NTZ`` (no time
zone); none of the helpers depends on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference warehouse's conventions.
# ---------------------------------------------------------------------------
# Open end of an SCD2 version; "open" means effective_to >= this value.
OPEN_END = dt.datetime(2990, 12, 31, 0, 0, 0)
# Change-time default when both create and update time are NULL (accounts, clients).
DEFAULT_CHANGE_TS = dt.datetime(1900, 1, 1, 0, 0, 0)
# Change-time default of the cards source.
DEFAULT_CHANGE_TS_CARDS = dt.datetime(2001, 1, 1, 0, 0, 0)
# Watermark used when the load metadata has no row for a source yet.
DEFAULT_WATERMARK = dt.datetime(1800, 12, 31, 0, 0, 0)
# Value the load metadata row is seeded with.
SEED_WATERMARK = dt.datetime(1800, 1, 1, 0, 0, 0)
# Business date in a file name: the first run of digits, day-month-year.
FILE_DATE_PATTERN = r"(\d+)"
FILE_DATE_FORMAT = "ddMMyyyy"
# Operation values the rules test for.
OPER_WITHDRAW = "WITHDRAW"
OPER_SUCCESS = "SUCCESS"
OPER_REJECT = "REJECT"

AMOUNT_TYPE = "decimal(38,10)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Expressions are built as SQL expression text where the inputs are column
# names: one ``F.expr`` is one call into the JVM, while composing Column
# objects costs one call per node. The SQL below is the same expression.

def q(name: str) -> str:
    """A column name (``a`` or ``s.f``) as a quoted SQL identifier."""
    return ".".join(f"`{part}`" for part in name.split("."))


def ntz_sql(value: dt.datetime | dt.date) -> str:
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return f"TIMESTAMP_NTZ '{value.strftime('%Y-%m-%d %H:%M:%S.%f')}'"


def ntz(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal."""
    if isinstance(value, str):
        return F.expr(f"TIMESTAMP_NTZ '{value}'")
    return F.expr(ntz_sql(value))


def open_end() -> Column:
    return F.expr(ntz_sql(OPEN_END))


def trunc_second_sql(t: str) -> str:
    return f"({t} - make_dt_interval(0, 0, 0, date_part('SECOND', {t}) - second({t})))"


def trunc_second(ts: str | Column) -> Column:
    """Cut a TIMESTAMP_NTZ to whole seconds without going through a time zone."""
    if isinstance(ts, str):
        return F.expr(trunc_second_sql(q(ts)))
    frac = F.date_part(F.lit("SECOND"), ts) - F.second(ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), frac)


def round_second_sql(t: str) -> str:
    return trunc_second_sql(f"({t} + INTERVAL '0.5' SECOND)")


def round_second(ts: str | Column) -> Column:
    """Round to the nearest second, half up, as a ``timestamp(0)`` column stores it."""
    if isinstance(ts, str):
        return F.expr(round_second_sql(q(ts)))
    return trunc_second(ts + F.expr("INTERVAL '0.5' SECOND"))


def epoch_seconds_sql(t: str) -> str:
    return (f"(CAST(datediff(to_date({t}), DATE '1970-01-01') AS BIGINT) * 86400"
            f" + hour({t}) * 3600 + minute({t}) * 60 + second({t}))")


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ, as bigint, time-zone free."""
    if isinstance(ts, str):
        return F.expr(epoch_seconds_sql(q(ts)))
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def file_date(file_name: str | Column) -> Column:
    """Business date of a dated file name: first digit run read as ddMMyyyy."""
    return F.to_date(F.regexp_extract(col(file_name), FILE_DATE_PATTERN, 1), FILE_DATE_FORMAT)


def parse_amount(text: str | Column, strict: bool = True) -> Column:
    """Decimal comma to point, then a wide decimal (no rounding of 3+ decimals)."""
    cleaned = F.regexp_replace(F.trim(col(text)), ",", ".")
    return cleaned.cast(AMOUNT_TYPE) if strict else cleaned.try_cast(AMOUNT_TYPE)


def change_time_sql(create_dt: str, update_dt: str, default: dt.datetime = DEFAULT_CHANGE_TS) -> str:
    d = ntz_sql(default)
    return round_second_sql(f"greatest(coalesce({q(create_dt)}, {d}), coalesce({q(update_dt)}, {d}))")


def change_time(create_dt: str | Column, update_dt: str | Column,
                default: dt.datetime = DEFAULT_CHANGE_TS) -> Column:
    """Later of create and update time; each NULL counts as ``default``; rounded to a second."""
    if isinstance(create_dt, str) and isinstance(update_dt, str):
        return F.expr(change_time_sql(create_dt, update_dt, default))
    d = ntz(default)
    return round_second(F.greatest(F.coalesce(col(create_dt), d), F.coalesce(col(update_dt), d)))


def change_time_after(create_dt: str | Column, update_dt: str | Column,
                      default: dt.datetime, watermark: dt.datetime) -> Column:
    """Predicate on raw columns implied by ``change_time(...) > watermark``.

    ``greatest(coalesce(..))`` does not push down to a scan; this disjunction
    does, and it keeps every row the exact test keeps (rounding up by half a
    second is covered by comparing against ``watermark - 0.5 s``).
    """
    w = ntz(watermark) - F.expr("INTERVAL '0.5' SECOND")
    parts = [col(create_dt) > w, col(update_dt) > w]
    if default + dt.timedelta(seconds=0.5) > watermark:
        parts.append(col(create_dt).isNull() | col(update_dt).isNull())
    return reduce(lambda a, b: a | b, parts)


def full_name_sql(last: str = "last_name", first: str = "first_name", middle: str = "patronymic") -> str:
    return (f"concat(coalesce({q(last)}, ''), ' ', coalesce({q(first)}, ''), ' ', "
            f"coalesce({q(middle)}, ''))")


def full_name(last: str | Column = "last_name", first: str | Column = "first_name",
              middle: str | Column = "patronymic") -> Column:
    """``last first middle`` with single spaces; a NULL part counts as empty."""
    if all(isinstance(c, str) for c in (last, first, middle)):
        return F.expr(full_name_sql(last, first, middle))
    return F.concat(F.coalesce(col(last), F.lit("")), F.lit(" "),
                    F.coalesce(col(first), F.lit("")), F.lit(" "),
                    F.coalesce(col(middle), F.lit("")))


def any_differs_sql(pairs: list[tuple[str, str]]) -> str:
    return "(" + " OR ".join(f"NOT ({q(a)} <=> {q(b)})" for a, b in pairs) + ")"


def date_as_ts(d: str | Column) -> Column:
    """A date as midnight TIMESTAMP_NTZ (the implicit rule of date vs timestamp)."""
    if isinstance(d, str):
        return F.expr(f"CAST({q(d)} AS TIMESTAMP_NTZ)")
    return d.cast("timestamp_ntz")
