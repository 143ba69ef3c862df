"""The latest row per key, kept up to date by incremental pickup (C2 over I1).

New files are picked up once each by a file-source stream; every micro-batch is
reduced to its latest row per key and merged into a bucketed table (``sinks.bucketed``), so
a drop of a few keys reads and writes a few buckets, and the feed is never read again. A row replaces the
kept one only if it is later, so a batch that runs twice, as after a failure between the
merge and the stream's own commit, changes nothing the second time, and drops may come in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.snapshots import rank_first
from ..session import scratch_path
from ..sinks.bucketed import create_bucketed, manifests, read_bucketed, upsert_bucketed

#: The key as text (null keys are a key too) and what a row is ordered by.
KEY, ORDER = "_key", "_order"


def merge_latest(batch: DataFrame, root: str, buckets: int = 64) -> None:
    """Merge a batch that carries ``KEY`` and ``ORDER`` into the table at ``root``."""
    spark = batch.sparkSession
    where = scratch_path(spark, "latest-batch")
    rank_first(batch, KEY, [ORDER]).write.parquet(where)
    newest = spark.read.schema(batch.schema).parquet(where)
    if not manifests(spark, root):
        create_bucketed(newest, root, KEY, buckets)
        return
    later = F.col(f"s.{ORDER}") > F.col(f"t.{ORDER}")
    update = {c: F.when(later, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")) for c in batch.columns if c != KEY}
    upsert_bucketed(newest, root, update=update, check=False)


def keep_latest(spark: SparkSession, path: str, schema: T.StructType | str, root: str, checkpoint: str, keys: Sequence[str],
                order: Sequence[str | Column], fmt: str = "json", options: dict | None = None, buckets: int = 64,
                max_files_per_trigger: int | None = 1000) -> None:
    """Pick up the files landed under ``path`` since the last run and merge them.

    ``order``: the row with the largest values is the latest; ``_metadata.file_path`` may
    be among them. Ties go to the row that was kept first. A null sorts before all values."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    by = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{n}") for n, c in enumerate(order)])
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    stream = reader.load(path).select("*", key.alias(KEY), by.alias(ORDER))
    q = (stream.writeStream.foreachBatch(lambda batch, _: merge_latest(batch, root, buckets))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The latest row per key."""
    return read_bucketed(spark, root).drop(KEY, ORDER)
