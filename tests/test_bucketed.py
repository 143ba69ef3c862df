"""Upsert by touched buckets."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fernhill.operators.resolve import record_matches, record_matches_bucketed
from fernhill.operators.upsert import upsert
from fernhill.session import scratch_path
from fernhill.sinks import bucketed
from tests.test_sources_sinks import local


def files_of(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(local(root) + "/data") for f in fs if f.endswith(".parquet")}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), (F.col("id") % 7).cast("int").alias("n"))


def test_a_small_source_rewrites_its_buckets_alone(spark, target):
    root = scratch_path(spark, "t-buckets")
    first = bucketed.create_bucketed(target, root, "k", buckets=256)
    assert len(first.folders) == 256
    before = files_of(root)
    source = spark.range(50).select((F.col("id") * 391).alias("k"), F.lit("new").alias("v"), F.lit(1).alias("n")).union(
        spark.range(50).select(F.col("id") + 100_000, F.lit("added"), F.lit(2)))
    second = bucketed.upsert_bucketed(source, root)
    after = files_of(root)
    assert {p: t for p, t in after.items() if p in before} == before                 # nothing was rewritten in place
    touched = {b for b in second.folders if second.folders[b] != first.folders[b]}
    assert 0 < len(touched) <= 100 and len(after) - len(before) == len(touched)
    assert rows_of(bucketed.read_bucketed(spark, root)) == rows_of(upsert(target, source, "k"))
    # the version before is still there
    assert rows_of(bucketed.read_bucketed(spark, root, version=1)) == rows_of(target)
    # the upsert read no other bucket
    read = bucketed._rows(spark, root, first, touched)
    assert read.count() < 20_000 and len(read.inputFiles()) == len(touched)


def test_equal_to_upsert_with_expressions_nulls_and_two_keys(spark):
    t = spark.createDataFrame([(i, str(i % 3), i * 10, None if i % 4 else "x") for i in range(60)] + [(None, "a", 1, "n")], "a int, b string, c int, d string")
    s = spark.createDataFrame([(i, str(i % 3), i, None) for i in range(50, 70)] + [(None, "a", 2, "m")], "a long, b string, c int, d string")
    root = scratch_path(spark, "t-buckets")
    bucketed.create_bucketed(t, root, ["a", "b"], buckets=8)
    rules = {"update": {"c": F.col("t.c") + F.col("s.c")}, "insert": {"a": F.col("s.a"), "b": F.col("s.b"), "d": F.lit("in")}}
    bucketed.upsert_bucketed(s, root, **rules)
    got = bucketed.read_bucketed(spark, root)
    assert got.schema == t.schema or got.dtypes == t.dtypes
    assert rows_of(got) == rows_of(upsert(t, s, ["a", "b"], **rules))
    again = bucketed.upsert_bucketed(s.where("a < 0"), root, **rules)      # nothing to do
    assert again.version == 2 and bucketed.manifests(spark, root) == [1, 2]


def test_duplicates_leave_the_table_as_it_was(spark, target):
    root = scratch_path(spark, "t-buckets")
    bucketed.create_bucketed(target, root, "k", buckets=4)
    twice = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], "k long, v string, n int")
    with pytest.raises(PySparkException, match="duplicate keys"):
        bucketed.upsert_bucketed(twice, root)
    assert bucketed.manifests(spark, root) == [1] and bucketed.read_bucketed(spark, root).count() == 20_000


def test_of_two_writers_from_one_version_one_fails(spark, target, monkeypatch):
    root = scratch_path(spark, "t-buckets")
    bucketed.create_bucketed(target, root, "k", buckets=4)
    one = spark.createDataFrame([(1, "a", 1)], "k long, v string, n int")
    two = spark.createDataFrame([(2, "b", 1)], "k long, v string, n int")
    real = bucketed._write

    def late(*args):
        out = real(*args)
        monkeypatch.setattr(bucketed, "_write", real)
        bucketed.upsert_bucketed(two, root)          # another writer commits first
        return out

    monkeypatch.setattr(bucketed, "_write", late)
    with pytest.raises(bucketed.VersionConflict):
        bucketed.upsert_bucketed(one, root)
    bucketed.upsert_bucketed(one, root)              # run again, it starts from the new version
    assert {r.k: r.v for r in bucketed.read_bucketed(spark, root).where("k in (1, 2)").collect()} == {1: "a", 2: "b"}


def test_empty_tables(spark, target):
    root = scratch_path(spark, "t-buckets")
    m = bucketed.create_bucketed(target.where("k < 0"), root, "k", buckets=4)
    assert m.folders == {} and bucketed.read_bucketed(spark, root).count() == 0
    bucketed.upsert_bucketed(target.where("k < 5"), root)
    assert rows_of(bucketed.read_bucketed(spark, root)) == rows_of(target.where("k < 5"))
    assert rows_of(bucketed.read_keys(spark, root, spark.createDataFrame([(3,)], "k long")).where("k = 3")) == [(3, "v3", 3)]
    with pytest.raises(FileNotFoundError):
        bucketed.read_bucketed(spark, scratch_path(spark, "t-none"))


def test_matches_are_recorded_in_touched_buckets(spark):
    matches = spark.createDataFrame([(f"title {k}", None, None, False, None) for k in range(200)],
                                    "title string, title_id string, itemset_id string, has_match boolean, match_ts timestamp_ntz")
    found = spark.createDataFrame([(" Title 3 ", "tt1", None), ("brand new", "tt2", "tt9"), ("Title 3", "tt1", None)], "title string, title_id string, itemset_id string")
    root = scratch_path(spark, "t-buckets")
    first = bucketed.create_bucketed(matches, root, "title", buckets=64)
    second = record_matches_bucketed(spark, root, found)
    got, want = bucketed.read_bucketed(spark, root).drop("match_ts"), record_matches(matches, found).drop("match_ts")
    assert rows_of(got) == rows_of(want)
    assert sum(second.folders[b] != first.folders.get(b) for b in second.folders) <= 2
