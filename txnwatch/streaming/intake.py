"""Micro-batch intake of dated files with Structured Streaming.

The reference polls a folder every 5 minutes and moves processed files to an
archive. Here a file stream does the polling: ``pathGlobFilter`` picks the
file kind, the checkpoint records which files are done (a file still in the
folder is not necessarily new), ``cleanSource=archive`` moves finished files,
and ``foreachBatch`` appends each batch to the fact table. ``foreachBatch``
is at-least-once, so facts are appended with ``on_duplicate="skip"``.

The report needs all four rules of an operation, so it is brought up to date in
``foreachBatch`` from the stored facts (``after_batch``). Rules 3-4 alone run on
the stream itself in ``streaming.lags``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnwatch import schemas
from txnwatch.functions import scalars as X
from txnwatch.operators import facts
from txnwatch.plans import pipeline
from txnwatch.plans.warehouse import Warehouse
from txnwatch.sources.files import CSV, PATTERNS

FIVE_MINUTES = "5 minutes"


def transaction_stream(spark: SparkSession, in_dir: str, archive_dir: str | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of staged transactions from ``transactions_*.txt`` files."""
    raw = _files(spark, in_dir, schemas.RAW_TRANSACTIONS, "transactions", archive_dir, max_files_per_trigger, ";")
    return facts.stage_transactions(raw, "file_name")


def blacklist_stream(spark: SparkSession, in_dir: str, archive_dir: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the blacklist rows of each file's own day."""
    raw = _files(spark, in_dir, schemas.RAW_BLACKLIST, "blacklist", archive_dir, max_files_per_trigger)
    return facts.daily_slice(facts.stage_blacklist(raw, "file_name"))


def terminal_stream(spark: SparkSession, in_dir: str, archive_dir: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of terminal snapshot rows; ``update_dt`` is the snapshot's date."""
    raw = _files(spark, in_dir, schemas.RAW_TERMINALS, "terminals", archive_dir, max_files_per_trigger)
    return raw.select("terminal_id", "terminal_type", "terminal_city", "terminal_address",
                      X.date_as_ts(X.file_date("file_name")).alias("update_dt"))


def _files(spark: SparkSession, in_dir: str, schema, kind: str, archive_dir: str | None, most: int | None,
           sep: str = ",") -> DataFrame:
    """New files of a kind as a stream, under the same rules as the batch reader."""
    r = spark.readStream.schema(schema).options(**CSV, sep=sep).option("pathGlobFilter", PATTERNS[kind])
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if most:
        r = r.option("maxFilesPerTrigger", most)
    return r.csv(in_dir).withColumn("file_name", F.col("_metadata.file_name"))


def start_transaction_intake(spark: SparkSession, in_dir: str, warehouse_root: str, checkpoint: str,
                             archive_dir: str | None = None, available_now: bool = True,
                             after_batch: Callable[[SparkSession, Warehouse, int], None] | None = None,
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the intake. ``available_now`` processes what is there and stops (a
    scheduled run); otherwise it polls every 5 minutes."""
    wh = Warehouse(spark, warehouse_root)

    def batch(df: DataFrame, epoch: int) -> None:
        pipeline.load_transactions(wh, df, on_duplicate="skip")
        if after_batch is not None:
            after_batch(df.sparkSession, wh, epoch)

    return _start(transaction_stream(spark, in_dir, archive_dir, max_files_per_trigger), batch, checkpoint, available_now)


def start_blacklist_intake(spark: SparkSession, in_dir: str, warehouse_root: str, checkpoint: str,
                           archive_dir: str | None = None, available_now: bool = True,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    wh = Warehouse(spark, warehouse_root)
    return _start(blacklist_stream(spark, in_dir, archive_dir, max_files_per_trigger),
                  lambda df, epoch: pipeline.load_blacklist(wh, df, on_duplicate="skip"), checkpoint, available_now)


def start_terminal_intake(spark: SparkSession, in_dir: str, warehouse_root: str, checkpoint: str,
                          archive_dir: str | None = None, available_now: bool = True,
                          opt: pipeline.RunOptions | None = None) -> StreamingQuery:
    """Snapshots must be merged by date: a batch's snapshots are, one after the other (one small row a snapshot
    comes to the driver); a batch that is repeated changes nothing."""
    wh = Warehouse(spark, warehouse_root)

    def batch(df: DataFrame, epoch: int) -> None:
        df = wh.stage("stg_terminal_files", df)
        for r in df.select("update_dt").distinct().orderBy("update_dt").collect():
            snap = df.where(F.col("update_dt") == F.lit(r["update_dt"]).cast("timestamp_ntz"))
            pipeline.load_terminal_snapshot(wh, snap, r["update_dt"].date(), opt or pipeline.RunOptions())
        wh.unstage("stg_terminal_files")

    return _start(terminal_stream(spark, in_dir, archive_dir), batch, checkpoint, available_now)


def _start(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=FIVE_MINUTES)
    return w.start()


def report_after_batch(opt: pipeline.RunOptions | None = None):
    """``after_batch`` hook that rebuilds and appends the fraud report."""
    def hook(spark: SparkSession, wh: Warehouse, epoch: int) -> None:
        pipeline.update_report(spark, wh, opt or pipeline.RunOptions())
    return hook
