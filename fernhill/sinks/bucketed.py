"""Keyed tables in hash buckets, upserted by touched buckets.

A table folder holds ``data/<version>/bucket=<n>/`` parquet files and one small JSON
manifest per version, which names for every bucket the version that wrote it. An upsert
reads and writes only the buckets that hold a source key; all others stay where they
are and are named by the new manifest as by the old. So a source of a hundred keys
rewrites at most a hundred buckets, whatever the size of the table.

A version becomes visible when its manifest is created; creation fails if that version exists,
so of two upserts that start from the same version one fails with ``VersionConflict``, changes nothing
and can be run again. Earlier versions stay readable until their folders are deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import upsert


class VersionConflict(RuntimeError):
    """Another writer made the version first."""


@dataclass(frozen=True)
class Manifest:
    version: int
    keys: tuple[str, ...]
    buckets: int
    schema: str
    #: bucket -> name of the folder under data/ that holds it; buckets without rows are absent
    folders: Mapping[int, str]


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/manifests")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def manifests(spark: SparkSession, root: str) -> list[int]:
    """Versions of the table, ascending."""
    path, fs = _folder(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    versions = manifests(spark, root)
    if not versions:
        raise FileNotFoundError(f"no bucketed table at {root}")
    path = f"{root.rstrip('/')}/manifests/{versions[-1] if version is None else version:08d}.json"
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())     # one small file
    raw = json.loads(text)
    return Manifest(raw["version"], tuple(raw["keys"]), raw["buckets"], raw["schema"],
                    {int(b): folder for folder, bs in raw["folders"].items() for b in bs})


def _commit(spark: SparkSession, root: str, m: Manifest) -> None:
    by_folder: dict[str, list[int]] = {}
    for b, folder in sorted(m.folders.items()):
        by_folder.setdefault(folder, []).append(b)
    text = json.dumps({"version": m.version, "keys": m.keys, "buckets": m.buckets, "schema": m.schema, "folders": by_folder})
    path, fs = _folder(spark, root)
    target = spark._jvm.org.apache.hadoop.fs.Path(path, f"{m.version:08d}.json")
    try:
        out = fs.create(target, False)
    except Exception as e:
        if fs.exists(target):
            raise VersionConflict(f"version {m.version} of {root} was made by another writer") from e
        raise
    out.write(bytearray(text.encode()))
    out.close()


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(buckets)).cast("int")


def _write(df: DataFrame, root: str, keys: Sequence[str], buckets: int, some: int) -> tuple[str, list[int]]:
    """Write the rows to a new folder, one task per bucket; the folder's name and its buckets."""
    folder = uuid.uuid4().hex[:12]
    path = f"{root.rstrip('/')}/data/{folder}"
    dealt = df.withColumn("bucket", _bucket(keys, buckets)).repartition(max(1, some), "bucket")
    dealt.write.partitionBy("bucket").parquet(path)
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return folder, sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("bucket="))


def create_bucketed(df: DataFrame, root: str, key: str | Sequence[str], buckets: int = 64) -> Manifest:
    """A new table at ``root``: all rows of ``df`` in ``buckets`` buckets by hash of the key."""
    keys = (key,) if isinstance(key, str) else tuple(key)
    if "bucket" in (c.lower() for c in df.columns):
        raise ValueError("a column may not be called bucket: the folders are")
    folder, held = _write(df, root, keys, buckets, buckets)
    m = Manifest(1, keys, buckets, df.schema.json(), dict.fromkeys(held, folder))
    _commit(df.sparkSession, root, m)
    return m


def _rows(spark: SparkSession, root: str, m: Manifest, only: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(m.schema))
    paths = [f"{root.rstrip('/')}/data/{folder}/bucket={b}" for b, folder in sorted(m.folders.items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_bucketed(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """All rows of the latest (or a given) version."""
    return _rows(spark, root, read_manifest(spark, root, version))


def read_keys(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """Rows of the buckets that can hold the given keys (a DataFrame of the key columns), and of no others."""
    m = read_manifest(spark, root)
    return _rows(spark, root, m, _touched(keys, m))


def _touched(source: DataFrame, m: Manifest) -> set[int]:
    return {r.b for r in source.select(_bucket(m.keys, m.buckets).alias("b")).distinct().collect()}     # at most one row per bucket


def upsert_bucketed(source: DataFrame, root: str, update: Mapping[str, Column | str] | None = None,
                    insert: Mapping[str, Column | str] | None = None, check: bool = True, distinct_source: bool = False) -> Manifest:
    """Merge ``source`` into the table by its key, as ``upsert`` does; the new manifest.

    ``source`` is read twice (its buckets, then its rows): hand over a written table if it is dear.
    """
    spark = source.sparkSession
    m = read_manifest(spark, root)
    types = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(m.schema)).fields}
    # keys of another type would hash to other buckets
    source = source.select(*(F.col(f"`{c}`").cast(types[c]).alias(c) if c in m.keys else F.col(f"`{c}`") for c in source.columns))
    touched = _touched(source, m)
    if not touched:
        return m
    merged = upsert(_rows(spark, root, m, touched), source, list(m.keys), update, insert, check, distinct_source)
    folder, held = _write(merged, root, m.keys, m.buckets, len(touched))
    kept = {b: f for b, f in m.folders.items() if b not in touched}
    new = replace(m, version=m.version + 1, folders={**kept, **dict.fromkeys(held, folder)})
    _commit(spark, root, new)
    return new
