"""Which files are loaded: one small committed row a delivery, written when its rows are stored and counted.

A file of a name is its first delivery until that is archived; what comes under the name later is the next one. A
delivery's rows carry its name in the table, so that those of a broken append are told from an earlier delivery's.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch import schemas
from txnwatch.plans.warehouse import Warehouse
from txnwatch.sources import files

TABLE, SRC_FILE = "meta_files", "src_file"


def delivery(wh: Warehouse, kind: str, path: str, archive_dir: str | None) -> str | None:
    """The name under which the file's rows are stored (``<name>``, then ``<name>#2``, ...), or None if this delivery is loaded
    and only has to be archived."""
    name = path.rsplit("/", 1)[-1]
    n = wh.read(TABLE, schemas.META_FILES).where((F.col("kind") == kind) & (F.col("file") == name)).count()
    if n and archive_dir is not None and not files.archived(wh.spark, path, archive_dir):
        return None
    return name if not n else f"{name}#{n + 1}"


def loaded(wh: Warehouse, kind: str, path: str, src: str, table: str, rejected: int, staged: int | None) -> int:
    """Note a delivery whose rows are stored, and return their number. With ``staged``, the rows that the file has, a
    delivery counts as loaded only if as many are stored (None: rows of stored keys were skipped)."""
    stored = wh.read_facts(table, T.StructType([T.StructField(SRC_FILE, T.StringType())])).where(F.col(SRC_FILE) == src).count()
    if staged is not None and stored != staged:
        raise ValueError(f"{src}: {stored} of {staged} rows are stored in {table}")
    row = [(kind, path.rsplit("/", 1)[-1], src, stored, rejected)]
    wh.replace(TABLE, wh.read(TABLE, schemas.META_FILES).unionByName(wh.spark.createDataFrame(row, schemas.META_FILES)).coalesce(1))
    return stored
