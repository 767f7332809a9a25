"""Dated input files: transactions (``;`` text), passport blacklist, terminal snapshots.

Every reader takes a folder or a path glob, reads all matching files in one
distributed scan with an explicit all-text schema, and derives the business
date of each row from its file name (``_metadata.file_name``), so no file is
opened on the driver. Sheets (blacklist, terminals) are read from CSV or
Parquet extracts; xlsx decoding is not built (see README).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch import schemas
from txnwatch.functions import scalars as X
from txnwatch.operators import facts

PATTERNS = {
    "transactions": "transactions_*.txt",
    "blacklist": "passport_blacklist_*",
    "terminals": "terminals_*",
}


#: For batch and stream alike: names in the header must be the schema's, in its order, and every row must be whole.
CSV = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST"}


def _read(spark: SparkSession, path: str, schema, fmt: str, glob: str | None, sep: str = ",") -> DataFrame:
    r = spark.read.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if fmt == "csv":
        r = r.options(**CSV, sep=sep)
    df = r.format(fmt).load(path)
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def read_transactions(spark: SparkSession, path: str, glob: str | None = PATTERNS["transactions"],
                      strict_amount: bool = True) -> DataFrame:
    """``transactions_ddmmyyyy.txt`` files (``;``, header) → staged transactions with update_dt."""
    raw = _read(spark, path, schemas.RAW_TRANSACTIONS, "csv", glob, sep=";")
    return facts.stage_transactions(raw, "file_name", strict_amount)


def read_blacklist(spark: SparkSession, path: str, fmt: str = "csv",
                   glob: str | None = PATTERNS["blacklist"], daily: bool = True) -> DataFrame:
    """Blacklist extracts (date, passport). Cumulative files are cut to the file's own day."""
    raw = _read(spark, path, schemas.RAW_BLACKLIST, fmt, glob)
    staged = facts.stage_blacklist(raw, "file_name")
    return facts.daily_slice(staged) if daily else staged


def read_terminals(spark: SparkSession, path: str, fmt: str = "csv",
                   glob: str | None = PATTERNS["terminals"]) -> DataFrame:
    """Full terminal snapshots; ``update_dt`` = the file's date (one snapshot per file)."""
    raw = _read(spark, path, schemas.RAW_TERMINALS, fmt, glob)
    return raw.select("terminal_id", "terminal_type", "terminal_city", "terminal_address",
                      X.date_as_ts(X.file_date("file_name")).alias("update_dt"))


def dated_files(spark: SparkSession, path: str, glob: str) -> list[tuple[str, dt.date]]:
    """Files matching ``glob`` in business-date order (not name order: ddmmyyyy names
    do not sort by date across months). Lists names only; contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
             .select("path", X.file_date(F.element_at(F.split("path", "/"), -1)).alias("d"))
             .orderBy("d", "path").collect())
    return [(r["path"], r["d"]) for r in files]


def archive_files(spark: SparkSession, paths: list[str], archive_dir: str, suffix: str = ".backup") -> None:
    """Move processed files into ``archive_dir`` as ``<name><suffix>`` (same file system)."""
    sc = spark.sparkContext
    Path = sc._jvm.org.apache.hadoop.fs.Path
    conf = sc._jsc.hadoopConfiguration()
    dst_dir = Path(archive_dir)
    fs = dst_dir.getFileSystem(conf)
    fs.mkdirs(dst_dir)
    for p in paths:
        target = Path(dst_dir, archive_name(p, suffix))
        if fs.exists(target) or not fs.rename(Path(p), target):
            raise OSError(f"{p} cannot be archived as {target}: it stays where it is")


def archive_name(path: str, suffix: str = ".backup") -> str:
    name = path.rsplit("/", 1)[-1]
    return (name.rsplit(".", 1)[0] if "." in name else name) + suffix


def archived(spark: SparkSession, path: str, archive_dir: str, suffix: str = ".backup") -> bool:
    """Whether a file of this name is in the archive."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(archive_dir, archive_name(path, suffix))
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
