"""A registry of the schemas of staged parquet.

Parts of a staged prefix differ as their reports do: columns come and go, and types widen. Merging
their schemas on every read looks into the footer of every file. The registry notes each
file once: ``staged_schema`` lists the prefix (no footers), reads the footers of files that are new or
have changed, in one job over these alone, and widens the registered schema by rule. Reads with a
registered schema look into no footer before their own scan.

Widening: whole numbers to longer ones, float to double, int and shorter to double, date to timestamp without
zone, decimals to what holds both; nullable if either is. These are what Spark's parquet reader
converts by itself. Other differences are conflicts, named by column.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import file_manifest

ENTRIES = "path string, length bigint, modified timestamp, drop_schema string"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class SchemaConflict(TypeError):
    """A column has types that no rule brings together."""


def widen(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if isinstance(x, _WHOLE) and isinstance(y, _WHOLE) and _WHOLE.index(type(x)) < _WHOLE.index(type(y)):
            return y
        if isinstance(x, T.FloatType) and isinstance(y, T.DoubleType):
            return y
        if isinstance(x, _WHOLE[:3]) and isinstance(y, T.DoubleType):
            return y
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b, f"{name}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(f"{name}[]", a.elementType, b.elementType), a.containsNull or b.containsNull)
    raise SchemaConflict(f"column {name}: {a.simpleString()} and {b.simpleString()}")


def merge_schemas(a: T.StructType, b: T.StructType, prefix: str = "") -> T.StructType:
    """Columns of both by exact name, those of ``a`` first."""
    theirs = {f.name: f for f in b.fields}
    fields = [T.StructField(f.name, widen(prefix + f.name, f.dataType, theirs[f.name].dataType) if f.name in theirs else f.dataType,
                            f.nullable or f.name not in theirs or theirs[f.name].nullable) for f in a.fields]
    own = {f.name for f in a.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name not in own])


def _entries(spark: SparkSession, registry: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(registry)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(registry)


def _footers(spark: SparkSession, paths: list[str]) -> T.StructType:
    """The merged schema of some files: one job over their footers; files whose types differ are merged by rule."""
    try:
        return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths).schema
    except Exception:
        if len(paths) == 1:
            raise
    half = len(paths) // 2
    return merge_schemas(_footers(spark, paths[:half]), _footers(spark, paths[half:]))


def staged_schema(spark: SparkSession, path: str, registry: str, glob: str = "*.parquet") -> T.StructType:
    """The registered schema of the files under ``path``, after those that are new have been registered."""
    found = file_manifest(spark, path, glob).select("path", "length", F.col("modificationTime").alias("modified"))
    known = _entries(spark, registry)
    new = found.join(known.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")
    names = sorted(r.path for r in new.select("path").collect())       # names that the reader lists anyway
    have = [T.StructType.fromJson(json.loads(r.drop_schema)) for r in known.select("drop_schema").distinct().orderBy("drop_schema").collect()]
    if not names:
        if not have:
            raise FileNotFoundError(f"no staged files under {path}")
        return reduce(merge_schemas, have)
    dropped = _footers(spark, names)
    merged = reduce(merge_schemas, [*have, dropped])                    # a conflict leaves the registry as it was
    new.withColumn("drop_schema", F.lit(dropped.json())).write.mode("append").parquet(registry)
    return merged


def read_registered(spark: SparkSession, path: str, registry: str, glob: str = "*.parquet") -> DataFrame:
    """Staged parquet under its registered schema; columns that a file lacks are null."""
    schema = staged_schema(spark, path, registry, glob)
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", glob).parquet(path)
