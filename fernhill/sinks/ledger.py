"""Loads that remember what they have loaded (K4).

A table folder holds ``load=<id>/`` parquet folders and a ledger: per load the files it
took, each with its length and modification time. A load takes the files that no earlier one took in this
state, so running it twice adds nothing and a file that has changed is loaded again; forced, it takes
all. Rows count from the moment their load's entry is made; entries are numbered and made by
creating a file that must not exist, so of two loads that meet one is first, and the other sees what
that one took and starts over with what is left. Folders without an entry, left by a
load that failed or came second, are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import file_manifest

LEDGER = "path string, length bigint, modified timestamp, load_id string"


def _entries(spark: SparkSession, table: str) -> list[tuple[int, str]]:
    """(number, load id) of every load, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/_entries")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted((int(n.split("-")[0]), n.split("-")[1]) for n in names if not n.startswith((".", "_")) and "-" in n)


def _enter(spark: SparkSession, table: str, number: int, load_id: str) -> bool:
    """Make the entry; False if another load has this number."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    lock = fs_path(f"{table.rstrip('/')}/_numbers/{number:08d}")
    fs = lock.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(lock, False)
    except Exception:
        if fs.exists(lock):
            return False
        raise
    out.write(bytearray(json.dumps({"load": load_id}).encode()))
    out.close()
    fs.create(fs_path(f"{table.rstrip('/')}/_entries/{number:08d}-{load_id}"), False).close()
    return True


def load_ledger(spark: SparkSession, table: str) -> DataFrame:
    """path, length, modified, load_id of every file that a load has taken."""
    paths = [f"{table.rstrip('/')}/_files/{load_id}" for _, load_id in _entries(spark, table)]
    return spark.read.schema(LEDGER).parquet(*paths) if paths else spark.createDataFrame([], LEDGER)


def read_loads(spark: SparkSession, table: str, schema) -> DataFrame:
    """The rows of all loads that have an entry, with their load_id."""
    paths = [f"{table.rstrip('/')}/load={load_id}" for _, load_id in _entries(spark, table)]
    if not paths:
        return spark.createDataFrame([], schema).withColumn("load_id", F.lit(None).cast("string"))
    r = spark.read.schema(schema).parquet(*paths)
    return r.withColumn("load_id", F.regexp_extract(F.col("_metadata.file_path"), "/load=([0-9a-f]+)/", 1))


def load_once(spark: SparkSession, path: str, table: str, read: Callable[[list[str]], DataFrame], force: bool = False,
              glob: str | None = None) -> str | None:
    """Load the files under ``path`` that are new or changed (all with ``force``): ``read`` gets
    their paths and gives typed rows. The load's id, or None if there was nothing to load.

    The files' names pass through the driver, which lists them for any reader anyway."""
    while True:
        entries = _entries(spark, table)
        found = file_manifest(spark, path, glob).select("path", "length", F.col("modificationTime").alias("modified"))
        if not force:
            found = found.join(load_ledger(spark, table).select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")
        names = sorted(r.path for r in found.select("path").collect())
        if not names:
            return None
        load_id = uuid.uuid4().hex[:12]
        files = f"{table.rstrip('/')}/_files/{load_id}"
        found.withColumn("load_id", F.lit(load_id)).write.parquet(files)
        read(names).write.parquet(f"{table.rstrip('/')}/load={load_id}")
        if _enter(spark, table, entries[-1][0] + 1 if entries else 1, load_id):
            return load_id
