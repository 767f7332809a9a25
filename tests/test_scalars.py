import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from txnwatch.functions import scalars as X


def test_amount_decimal_comma(spark):
    df = spark.createDataFrame([("12,50",), ("7",), ("1.239",)], "a string")
    got = [r[0] for r in df.select(X.parse_amount("a")).collect()]
    assert got == [Decimal("12.5"), Decimal("7"), Decimal("1.239")]


def test_file_date_and_order(spark):
    df = spark.createDataFrame([("terminals_01032021.xlsx",), ("transactions_31032021.txt",),
                                ("transactions_01042021.txt",)], "f string")
    got = [r[0] for r in df.select(X.file_date("f")).collect()]
    assert got == [dt.date(2021, 3, 1), dt.date(2021, 3, 31), dt.date(2021, 4, 1)]


def test_full_name_null_part_keeps_space(spark):
    df = spark.createDataFrame([("A", "B", None)], "l string, f string, m string")
    assert df.select(X.full_name("l", "f", "m")).first()[0] == "A B "


def test_change_time_defaults(spark):
    df = spark.createDataFrame([(None, None)], "c timestamp_ntz, u timestamp_ntz")
    r = df.select(X.change_time("c", "u").alias("a"),
                  X.change_time("c", "u", X.DEFAULT_CHANGE_TS_CARDS).alias("b")).first()
    assert r["a"] == dt.datetime(1900, 1, 1) and r["b"] == dt.datetime(2001, 1, 1)


def test_round_and_trunc_second(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0, 1, 600000),)], "t timestamp_ntz")
    r = df.select(X.round_second("t").alias("r"), X.trunc_second("t").alias("c")).first()
    assert r["r"] == dt.datetime(2024, 1, 1, 10, 0, 2) and r["c"] == dt.datetime(2024, 1, 1, 10, 0, 1)


def test_pushdown_predicate_implied(spark):
    """Every row the exact change-time test keeps is kept by the pushdown predicate."""
    w = dt.datetime(2001, 1, 1)
    vals = [None, dt.datetime(2000, 12, 31, 23, 59, 59, 700000), dt.datetime(2001, 1, 1),
            dt.datetime(2001, 1, 1, 0, 0, 1), dt.datetime(1999, 1, 1)]
    data = [(a, b) for a in vals for b in vals]
    df = spark.createDataFrame(data, "c timestamp_ntz, u timestamp_ntz")
    for d in (X.DEFAULT_CHANGE_TS, dt.datetime(2002, 1, 1)):
        exact = df.where(X.change_time("c", "u", d) > X.ntz(w)).count()
        both = df.where(X.change_time_after("c", "u", d, w) & (X.change_time("c", "u", d) > X.ntz(w))).count()
        assert exact == both


def test_epoch_seconds_tz_free(spark):
    df = spark.createDataFrame([(dt.datetime(1970, 1, 2, 0, 0, 5),)], "t timestamp_ntz")
    assert df.select(X.epoch_seconds("t")).first()[0] == 86405
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(X.epoch_seconds("t")).first()[0] == 86405
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
