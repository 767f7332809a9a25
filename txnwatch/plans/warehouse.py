"""Warehouse tables as Parquet folders, replaced by writing a new version.

Without a transactional table format, a table being read is never
overwritten: ``replace`` writes ``<root>/<table>/v<NNNNNNNN>`` and the newest
version with Spark's ``_SUCCESS`` commit marker is the current one, so a
failed or half-written load is never read. Fact tables are append only
(``append``), partitioned by day. Paths may be on any Hadoop file system
(the shared cluster folder); listing goes through the session's Hadoop
configuration.

Large tables that change in places (histories, owners) are written by key
bucket under the same rule: a version folder holds the buckets that a load
changed, and a bucket's current rows are those of the newest committed version
that has it. Rows that never change again (``state=past``) are only added.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch import schemas


#: Key buckets of a table. Fixed for the life of a warehouse: choose it so that one bucket of the largest history suits one task.
BUCKETS = 64
TIP, PAST = "tip", "past"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # --- file system helpers ----------------------------------------------
    def _fs(self, path: str):
        return self._Path(path).getFileSystem(self._conf)

    def _exists(self, path: str) -> bool:
        return self._fs(path).exists(self._Path(path))

    def _versions(self, table: str) -> list[int]:
        base = f"{self.root}/{table}"
        if not self._exists(base):
            return []
        out = []
        for st in self._fs(base).listStatus(self._Path(base)):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v") and name[1:].isdigit():
                out.append(int(name[1:]))
        return sorted(out)

    def current_path(self, table: str) -> str | None:
        for v in reversed(self._versions(table)):
            p = f"{self.root}/{table}/v{v:08d}"
            if self._exists(f"{p}/_SUCCESS"):
                return p
        return None

    # --- tables ---------------------------------------------------------------
    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The current version, and the rows appended to the table since; of a table by buckets, all of its rows."""
        if self.has_buckets(table):
            return self.read_buckets(table, schema)
        p, more = self.current_path(table), self.facts_path(table)
        paths = ([p] if p else []) + ([more] if self._exists(more) else [])
        return self.spark.read.schema(schema).parquet(*paths) if paths else schemas.empty(self.spark, schema)

    def replace(self, table: str, df: DataFrame) -> str:
        """Write ``df`` as the next version; it becomes current once committed."""
        vs = self._versions(table)
        p = f"{self.root}/{table}/v{(vs[-1] + 1 if vs else 1):08d}"
        df.write.mode("errorifexists").parquet(p)
        return p

    def stage(self, table: str, df: DataFrame) -> DataFrame:
        """``df`` evaluated once and stored as the next version of a staging table; the stored copy."""
        return self.spark.read.schema(df.schema).parquet(self.replace(table, df))

    def unstage(self, *tables: str) -> None:
        """Delete staging tables whose load has been committed."""
        for table in tables:
            p = f"{self.root}/{table}"
            self._fs(p).delete(self._Path(p), True)

    # --- tables by key bucket ---------------------------------------------------
    def _names(self, path: str) -> list[str]:
        return [st.getPath().getName() for st in self._fs(path).listStatus(self._Path(path))] if self._exists(path) else []

    def _bucket_versions(self, table: str) -> list[str]:
        """Committed version folders, newest first, down to the newest whole one."""
        base, out = f"{self.root}/{table}/by{self.buckets}", []
        for name in sorted(self._names(base), reverse=True):
            if self._exists(f"{base}/{name}/_SUCCESS"):
                out.append(f"{base}/{name}")
                if name.endswith("_whole"):
                    break
        return out

    def has_buckets(self, table: str) -> bool:
        return bool(self._bucket_versions(table))

    def read_buckets(self, table: str, schema: T.StructType, buckets: list[int] | None = None, state: str | None = None) -> DataFrame:
        """Rows of the given buckets (all) and state (both): the newest tips of each bucket, and all past rows."""
        wanted = None if buckets is None else {f"bucket={b}" for b in buckets}
        paths, seen = [], set()
        for version in self._bucket_versions(table):
            for s in (TIP, PAST):
                for name in self._names(f"{version}/state={s}") if state in (None, s) else ():
                    if (wanted is None or name in wanted) and (s, name) not in seen:
                        paths.append(f"{version}/state={s}/{name}")
                        if s == TIP:
                            seen.add((s, name))
        return self.spark.read.schema(schema).parquet(*paths) if paths else schemas.empty(self.spark, schema)

    def write_buckets(self, table: str, df: DataFrame, key: str, whole: bool = False) -> str:
        """Write rows with a ``state`` as the next version. It must hold all tips of each bucket that it has; a ``whole`` one
        stands for the table, and nothing older is read any more."""
        base = f"{self.root}/{table}/by{self.buckets}"
        last = max((int(n[1:9]) for n in self._names(base) if n[:1] == "v"), default=0)
        p = f"{base}/v{last + 1:08d}{'_whole' if whole else ''}"
        df = df.withColumn("bucket", bucket_of(key, self.buckets))
        df.repartition("bucket", "state").write.mode("errorifexists").partitionBy("state", "bucket").parquet(p)
        return p

    def compact(self, table: str, schema: T.StructType, key: str, after: int) -> bool:
        """A table whose buckets are scattered over more than ``after`` versions is written as one whole version."""
        if len(self._bucket_versions(table)) <= after:
            return False
        parts = [self.read_buckets(table, schema, state=s).withColumn("state", F.lit(s)) for s in (TIP, PAST)]
        self.write_buckets(table, parts[0].unionByName(parts[1]), key, whole=True)
        return True

    # --- change notes of the loads, until the report has taken them up --------------
    def note(self, kind: str, df: DataFrame) -> None:
        df.write.parquet(f"{self.root}/notes/{kind}/{uuid.uuid4().hex}")

    def notes(self, kind: str) -> list[str]:
        base = f"{self.root}/notes/{kind}"
        return [f"{base}/{n}" for n in self._names(base) if self._exists(f"{base}/{n}/_SUCCESS")]

    def drop(self, paths: list[str]) -> None:
        for p in paths:
            self._fs(p).delete(self._Path(p), True)

    def fact_days(self, table: str) -> list[str]:
        """The days that a fact table has, from its folder names."""
        return sorted(n.split("=", 1)[1] for n in self._names(self.facts_path(table)) if n.startswith("day=") and n[4:5].isdigit())

    def prune(self, table: str, keep: int = 3, older_than: float = 86400.0) -> int:
        """Maintenance, called when no reader needs them: delete committed versions but the newest ``keep`` that were
        written more than ``older_than`` seconds ago, and uncommitted folders as old. Returns how many went."""
        now, good, gone = time.time(), 0, 0
        for v in reversed(self._versions(table)):
            p = f"{self.root}/{table}/v{v:08d}"
            committed = self._exists(f"{p}/_SUCCESS")
            good += committed
            age = now - self._fs(p).getFileStatus(self._Path(p)).getModificationTime() / 1000
            if age > older_than and (not committed or good > keep):
                self._fs(p).delete(self._Path(p), True)
                gone += 1
        base, current = f"{self.root}/{table}/by{self.buckets}", set(self._bucket_versions(table))
        for name in self._names(base):
            p = f"{base}/{name}"
            if p not in current and now - self._fs(p).getFileStatus(self._Path(p)).getModificationTime() / 1000 > older_than:
                self._fs(p).delete(self._Path(p), True)
                gone += 1
        return gone

    def facts_path(self, table: str) -> str:
        return f"{self.root}/{table}/data"

    def read_facts(self, table: str, schema: T.StructType, day_col: str = "day") -> DataFrame:
        p = self.facts_path(table)
        if not self._exists(p):
            return schemas.empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(p).select(*schema.fieldNames())

    def read_facts_with_day(self, table: str, schema: T.StructType, day_col: str = "day") -> DataFrame:
        p = self.facts_path(table)
        whole = T.StructType([*schema.fields, T.StructField(day_col, T.DateType())])
        return self.spark.read.schema(whole).parquet(p) if self._exists(p) else schemas.empty(self.spark, whole)

    def append(self, table: str, df: DataFrame, partition_by: list[str] | None = None, bloom: str | None = None) -> None:
        """Append rows; ``bloom`` names a key column that gets Parquet Bloom filters."""
        w = df.write.mode("append")
        if bloom:
            w = w.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.facts_path(table))
