"""A registry of the schemas of staged parquet."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernhill.session import scratch_path
from fernhill.sources import schema_registry as R


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def places(spark):
    base = scratch_path(spark, "t-registry")
    return f"{base}/staged", f"{base}/registry"


def test_columns_come_and_types_widen(spark, places):
    path, registry = places
    spark.range(3).select(F.col("id").cast("int").alias("a"), F.lit(1.5).cast("float").alias("f")).write.parquet(f"{path}/one")
    assert R.read_registered(spark, path, registry).schema.simpleString() == "struct<a:int,f:float>"
    spark.range(2).select((F.col("id") + 2 ** 40).alias("a"), F.lit("x").alias("b"), F.lit(2.25).alias("f")).write.parquet(f"{path}/two")
    got = R.read_registered(spark, path, registry)
    assert got.schema.simpleString() == "struct<a:bigint,f:double,b:string>"
    assert rows_of(got) == sorted([(0, 1.5, None), (1, 1.5, None), (2, 1.5, None), (2 ** 40, 2.25, "x"), (2 ** 40 + 1, 2.25, "x")], key=str)


def test_known_files_are_not_looked_into_again(spark, places, monkeypatch):
    path, registry = places
    spark.range(4).repartition(2).write.parquet(f"{path}/one")
    seen = []
    real = R._footers
    monkeypatch.setattr(R, "_footers", lambda s, paths: seen.append(len(paths)) or real(s, paths))
    for _ in range(2):
        schema = R.staged_schema(spark, path, registry)
    assert seen == [2]
    spark.range(4).select("id", F.lit(1).alias("n")).coalesce(1).write.parquet(f"{path}/two")
    schema = R.staged_schema(spark, path, registry)
    assert seen == [2, 1]
    # planning a read under the registered schema runs no job
    sc = spark.sparkContext
    sc.setJobGroup("registered", "read")
    df = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    df._jdf.queryExecution().executedPlan()
    jobs = sc.statusTracker().getJobIdsForGroup("registered")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0 and df.count() == 8


def test_conflicts_are_named_and_change_nothing(spark, places):
    path, registry = places
    spark.range(1).select(F.col("id").alias("a")).coalesce(1).write.parquet(f"{path}/one")
    R.staged_schema(spark, path, registry)
    spark.range(1).select(F.lit("text").alias("a")).write.parquet(f"{path}/two")
    with pytest.raises(R.SchemaConflict, match="column a: bigint and string"):
        R.staged_schema(spark, path, registry)
    assert R._entries(spark, registry).count() == 1
    with pytest.raises(FileNotFoundError):
        R.staged_schema(spark, f"{path}/one", f"{registry}-other", glob="*.none")


def test_one_drop_with_files_of_different_types(spark, places):
    path, registry = places
    for n, t in enumerate(("int", "bigint", "smallint")):
        spark.range(1).select(F.col("id").cast(t).alias("a"), F.lit(n).alias(f"c{n}")).write.parquet(f"{path}/p{n}")
    assert {f.name: f.dataType.simpleString() for f in R.staged_schema(spark, path, registry).fields} == {"a": "bigint", "c0": "int", "c1": "int", "c2": "int"}
    assert R.read_registered(spark, path, registry).count() == 3


@pytest.mark.parametrize("a,b,want", [
    ("decimal(10,2)", "decimal(8,5)", "decimal(13,5)"), ("date", "timestamp_ntz", "timestamp_ntz"), ("tinyint", "double", "double"),
    ("struct<x:int>", "struct<y:string,x:bigint>", "struct<x:bigint,y:string>"), ("array<int>", "array<bigint>", "array<bigint>"),
    ("bigint", "double", None), ("decimal(38,0)", "decimal(38,10)", None), ("string", "date", None)])
def test_widening_rules(spark, a, b, want):
    x, y = (T.StructType.fromDDL(f"c {t}").fields[0].dataType for t in (a, b))
    for p, q in ((x, y), (y, x)):
        if want is None:
            with pytest.raises(R.SchemaConflict, match="column c"):
                R.widen("c", p, q)
        elif not isinstance(x, T.StructType):
            assert R.widen("c", p, q).simpleString() == want
    if isinstance(x, T.StructType):
        assert R.widen("c", x, y).simpleString() == want
