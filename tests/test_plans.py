"""Plan shapes that the design relies on at scale (checked on the physical plan,
with broadcasts switched off so the plans are the ones large inputs get)."""

import contextlib
import os

import pytest
from pyspark.sql import functions as F

from fernhill.operators.joins import not_in
from fernhill.operators.resolve import resolve_titles, with_episode
from fernhill.operators.snapshots import latest_per_key, weekday_snapshots
from fernhill.operators.upsert import upsert
from fernhill.operators.views import furthest_view
from fernhill.plans.loads import load_projection
from fernhill.plans.specs import SPECS
from fernhill.session import scratch_path
from fernhill.sources.readers import read_json_feed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def views(spark):
    rows = [("ip", "ag", "f", 5, "d2", "t1"), ("ip", "ag", "f", 3, "d0", "t0")]
    return spark.createDataFrame(rows, "c_ip string, cs_user_agent string, file_id string, content_ts int, "
                                       "date string, time string")


def test_furthest_view_is_one_shuffle(spark, views):
    with no_broadcast(spark):
        one = plan(furthest_view(views))
        ref = plan(furthest_view(views, method="self_join"))
    assert one.count("Exchange hashpartitioning") == 1
    assert "Join" not in one
    assert ref.count("Exchange hashpartitioning") >= 3


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    p = plan(latest_per_key(df, "k", order=["v"]))
    assert "WindowGroupLimit" in p and "Partial" in p
    head, _, tail = p.partition("Exchange")
    assert "Partial" in tail   # the partial limit sits below (before) the exchange


def test_weekday_snapshots_prune_folders(spark):
    root = scratch_path(spark, "t-snap")
    df = spark.createDataFrame([(1, "20220105_000000"), (2, "20220106_000000")], "v int, snap string")
    df.write.partitionBy("snap").json(root)
    feed = read_json_feed(spark, root, schema="v int", recursive=False)
    out = weekday_snapshots(feed, stamp_col="snap")
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in p and "dayofweek" in p.split("PartitionFilters: [", 1)[1]
    assert [r.v for r in out.collect()] == [1]


def test_not_in_needs_no_broadcast(spark):
    left = spark.range(50).select(F.col("id").cast("string").alias("k"))
    right = spark.range(10).select(F.col("id").cast("string").alias("k"))
    with no_broadcast(spark):
        p = plan(not_in(left, right, "k"))
        builtin = plan(spark.sql("SELECT k FROM {l} WHERE k NOT IN (SELECT k FROM {r})", l=left, r=right))
    assert "BroadcastNestedLoopJoin" not in p and "BroadcastHashJoin" not in p
    assert "SortMergeJoin" in p and "LeftAnti" in p
    # Spark's own NOT IN falls back to a nested-loop join when it may not broadcast
    assert "BroadcastNestedLoopJoin" in builtin or "BroadcastHashJoin" in builtin


def test_load_projection_stays_in_the_jvm(spark):
    cols = [f.sources[-1] for f in SPECS["c9"].fields]
    df = spark.createDataFrame([tuple("1" for _ in cols)], ", ".join(f"`{c}` string" for c in cols))
    p = plan(load_projection(df, SPECS["c9"], run_id="r", source_key=F.lit("k")))
    assert "Python" not in p and "ArrowEval" not in p
    assert "Exchange" not in p


def test_not_in_sends_each_subquery_key_once(spark):
    left = spark.range(100).select(F.col("id").cast("string").alias("k"))
    right = spark.range(1000).select((F.col("id") % 2).cast("string").alias("k"))
    with no_broadcast(spark):
        df = not_in(left, right, "k")
        p = plan(df)
        assert df.count() == 98
        df.collect()
    assert "keys=[__k" in p                                    # distinct, partly before its exchange
    # one exchange of each side was run; the scalar subquery took that of the subquery side
    lines = plan(df).splitlines()
    run = [below for stage, below in zip(lines, lines[1:]) if "ShuffleQueryStage" in stage and "hashpartitioning" in below]
    assert sum("ReusedExchange" not in x for x in run) == 2 and any("ReusedExchange" in x for x in run)


CANDIDATES = ("query string, position long, id string, kind string, year int, votes int, parent_id string, "
              "itemset_no int, item_no int")


def test_resolution_reads_candidates_once_and_joins_twice(spark):
    titles = spark.range(10).select(F.concat(F.lit("t"), F.col("id")).alias("title"))
    cand = spark.createDataFrame([("t1", 1, "m1", "movie", 2000, 60, None, None, None)], CANDIDATES)
    with no_broadcast(spark):
        p = plan(resolve_titles(titles, cand, assume_distinct=True))
    assert p.count("SortMergeJoin") == 2                       # query lookup, episode lookup
    assert p.count("Exchange hashpartitioning") <= 7


def test_titles_without_an_episode_spread_over_tasks(spark):
    rows = spark.range(20000).select(F.concat(F.lit("t"), F.col("id")).alias("title"), F.lit(None).cast("string").alias("p"),
                                     F.lit(None).cast("int").alias("s"), F.lit(None).cast("int").alias("i"))
    cand = spark.createDataFrame([("q", 1, "e1", "episode", 2000, 60, "t7", 1, 1)], CANDIDATES)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with no_broadcast(spark):
            out = with_episode(rows, cand, "p", "s", "i", spread_by="title")
            sizes = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 7000
    assert out.where("episode_id IS NOT NULL").count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables not present")
@pytest.mark.parametrize("name", ["c1_furthest_view", "w1_latest_per_key", "f3_weekday", "c20_titles_to_match"])
def test_plans_keep_their_shape_as_tables_grow(spark, name):
    import re

    import __spark_entry__ as E

    with no_broadcast(spark):
        small, large = (re.findall(r"\w*(?:Exchange|Join|Aggregate|Sort|Window\w*)\b", plan(E.queries()[name](spark, f"/root/testdata/{sf}")))
                        for sf in ("sf0.01", "sf0.1"))
    assert small == large


def test_upsert_shuffles_the_source_once(spark):
    t = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    s = spark.range(50, 150).select(F.col("id").alias("k"), F.lit("y").alias("v"))
    with no_broadcast(spark):
        p = plan(upsert(t, s, "k"))
    # one exchange for the source's key aggregation (reused by the join), one for the target
    assert p.count("Exchange hashpartitioning") == 2


def test_no_registered_query_pairs_rows(spark):
    """No cross products or nested-loop joins anywhere (broadcasts off)."""
    import __spark_entry__ as E

    bad = []
    with no_broadcast(spark):
        for name, build in sorted(E.queries().items()):
            p = plan(build(spark, "/root/testdata/sf0.001"))
            if "CartesianProduct" in p or "NestedLoopJoin" in p:
                bad.append(name)
    assert bad == []


def test_not_in_reads_and_shuffles_the_subquery_side_once(spark):
    left, right = scratch_path(spark, "t-left"), scratch_path(spark, "t-right")
    spark.range(5000).select(F.col("id").cast("string").alias("k")).write.parquet(left)
    spark.range(0, 9000, 3).select(F.col("id").cast("string").alias("k")).write.parquet(right)
    with no_broadcast(spark):
        df = not_in(spark.read.parquet(left), spark.read.parquet(right), "k")
        assert df.count() == 5000 - 1667
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
    # the scalar subquery reuses the exchange of the join's side
    assert "ReusedExchange" in final and "SortMergeJoin" in final and "LeftAnti" in final
    executed = final.split("== Initial Plan ==")[0]
    assert executed.count(right.rsplit("/", 1)[1]) <= 1
