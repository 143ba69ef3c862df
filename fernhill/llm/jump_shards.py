"""Sharding by jump consistent hashing (Lamping and Veach).

A stable key and the shard count alone decide the shard; going from n to n + 1
shards moves 1 / (n + 1) of the keys, all into the new shard, and no ring table is kept.

Defined cases: a null key counts as one more key value; null text has size 0 + 1 and
the CRC of no bytes; repeated rows fall into the same shard and get slots of their own.
Texts of any length are measured as a whole; other columns, whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

# Fixed value: the multiplier of the published algorithm's generator.
JUMP_MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards of 64-bit keys: each key jumps ahead until it would leave the range."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = ahead[live]
        state[live] = state[live] * JUMP_MULTIPLIER + np.uint64(1)
        step = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[live] = ((shard[live] + 1) * (float(1 << 31) / step)).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard


def stable_key(*columns: Column) -> Column:
    """A well mixed 64-bit key of the columns' text; nulls are a value of their own."""
    return F.xxhash64(*(F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in columns))


def assign_shards(rows: DataFrame, key: Column, shards: int) -> DataFrame:
    """``rows`` plus shard, grown_shard (with one shard more) and slot, which counts each
    shard's rows from 0 without gaps.

    Slots need no sort: rows are numbered where they are read, per task and shard, and
    written; each task's numbers are then moved up by the counts of the tasks before it.
    """
    names = [f.name for f in rows.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    keyed = rows.select(key.alias("_key"), F.spark_partition_id().alias("_task"), *(F.col(f"`{c}`") for c in names))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(shards, np.int64)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            shard = jump_hash(keys, shards)
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            first = np.repeat(np.cumsum(counts) - counts, counts)
            local = np.empty(len(shard), np.int64)
            local[order] = np.arange(len(shard)) - first + seen[shard[order]]
            seen += counts
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(shard.astype(np.int32)), pa.array(jump_hash(keys, shards + 1).astype(np.int32)), pa.array(local)],
                names=["_task", *names, "shard", "grown_shard", "_local"])

    numbered = settle(keyed.mapInArrow(number, f"_task int, {schema}, shard int, grown_shard int, _local bigint"), "shards")
    counts = numbered.groupBy("_task", "shard").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_task", "shard", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return numbered.join(settle(starts, "shard-starts"), ["_task", "shard"]).select(
        *(F.col(f"`{c}`") for c in names), "shard", "grown_shard", (F.col("_start") + F.col("_local")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, grown_shard, slot of each document."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    return assign_shards(rows, stable_key(F.col("doc_id")), shards)
