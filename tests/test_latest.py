"""The latest row per key, kept by incremental pickup (C2 over I1)."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fernhill.operators.snapshots import latest_per_key
from fernhill.session import scratch_path
from fernhill.sinks import bucketed
from fernhill.streaming import latest
from tests.test_sources_sinks import write_text

SCHEMA = "k string, at int, v string"


def drop(path, name, rows):
    write_text(path, name, "".join(json.dumps(dict(zip(("k", "at", "v"), r))) + "\n" for r in rows))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


DROPS = [[("a", 1, "a1"), ("b", 5, "b5"), (None, 1, "n1"), ("a", 3, "a3")], [("a", 2, "late"), ("c", 1, "c1"), (None, 2, "n2")], [("b", 6, "b6"), ("b", None, "none"), ("d", None, "d")]]


def run(spark, path, root, checkpoint):
    latest.keep_latest(spark, path, SCHEMA, root, checkpoint, ["k"], ["at", "v"], buckets=4)


@pytest.fixture
def places(spark):
    base = scratch_path(spark, "t-latest")
    return f"{base}/landing", f"{base}/table", f"{base}/checkpoint"


def test_three_drops_equal_one_batch(spark, places):
    for n, rows in enumerate(DROPS):
        drop(places[0], f"drop-{n}.json", rows)
        run(spark, *places)
        run(spark, *places)        # nothing new
    whole = spark.createDataFrame([r for d in DROPS for r in d], SCHEMA)
    want = rows_of(latest_per_key(whole, "k", order=["at", "v"]))
    assert rows_of(latest.read_latest(spark, places[1])) == want
    assert ("a", 3, "a3") in want and (None, 2, "n2") in want and ("d", None, "d") in want


def test_a_run_that_dies_after_the_merge_leaves_no_double_rows(spark, places, monkeypatch):
    drop(places[0], "drop-0.json", DROPS[0])
    run(spark, *places)
    drop(places[0], "drop-1.json", DROPS[1])
    real = latest.merge_latest

    def dies(batch, root, buckets):
        real(batch, root, buckets)
        raise RuntimeError("lost")

    monkeypatch.setattr(latest, "merge_latest", dies)
    with pytest.raises(PySparkException):
        run(spark, *places)
    monkeypatch.setattr(latest, "merge_latest", real)
    merged = rows_of(latest.read_latest(spark, places[1]))
    run(spark, *places)            # the same batch again
    assert rows_of(latest.read_latest(spark, places[1])) == merged
    assert sorted(str(r[0]) for r in merged) == ["None", "a", "b", "c"]


def test_a_drop_touches_its_buckets_alone(spark, places):
    drop(places[0], "drop-0.json", [(f"k{n}", 1, "x") for n in range(200)])
    latest.keep_latest(spark, places[0], SCHEMA, places[1], places[2], ["k"], ["at"], buckets=32)
    first = bucketed.read_manifest(spark, places[1])
    drop(places[0], "drop-1.json", [("k7", 2, "y"), ("k8", 0, "old")])
    latest.keep_latest(spark, places[0], SCHEMA, places[1], places[2], ["k"], ["at"], buckets=32)
    second = bucketed.read_manifest(spark, places[1])
    assert sum(second.folders[b] != first.folders[b] for b in second.folders) <= 2
    got = {r.k: r.v for r in latest.read_latest(spark, places[1]).where(F.col("k").isin("k7", "k8")).collect()}
    assert got == {"k7": "y", "k8": "x"}
