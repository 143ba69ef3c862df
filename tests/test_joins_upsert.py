"""NOT IN versus NOT EXISTS (J2) and the keyed upsert."""

import pytest
from pyspark.errors import PySparkException

from fernhill.operators.joins import left_anti, not_in
from fernhill.operators.upsert import upsert


def keys(df, c="k"):
    return sorted((r[c] for r in df.collect()), key=lambda v: (v is None, v))


def test_not_in_is_null_aware(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    assert keys(not_in(left, right, "k")) == []
    assert keys(left_anti(left, right, "k")) == ["b"]


def test_not_in_empty_subquery_keeps_null_probe(spark):
    left = spark.createDataFrame([("a",), (None,)], "k string")
    empty = spark.createDataFrame([], "k string")
    assert keys(not_in(left, empty, "k")) == ["a", None]
    right = spark.createDataFrame([("b",)], "k string")
    assert keys(not_in(left, right, "k")) == ["a"]


def test_upsert_updates_inserts_keeps(spark):
    t = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    s = spark.createDataFrame([(2, "Y"), (3, "Z")], "k int, v string")
    out = sorted(tuple(r) for r in upsert(t, s, "k").collect())
    assert out == [(1, "x"), (2, "Y"), (3, "Z")]


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    s = spark.createDataFrame([(2, "Y"), (3, "Z")], "k int, v string")
    once = upsert(t, s, "k")
    twice = upsert(once, s, "k")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_upsert_refuses_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "x")], "k int, v string")
    s = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(PySparkException):
        upsert(t, s, "k").collect()
    same = spark.createDataFrame([(1, "a"), (1, "a")], "k int, v string")
    assert [tuple(r) for r in upsert(t, same, "k", distinct_source=True).collect()] == [(1, "a")]
