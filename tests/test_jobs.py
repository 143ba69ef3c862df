"""The three entry-point jobs (E1–E3) end to end on small inputs."""

import datetime as dt
import gzip
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from fernhill.operators.shaping import MissingColumns
from fernhill.plans.jobs import catalogue_snapshot, cdn_view_points, load_reports, match_titles
from fernhill.plans.loads import F_, LoadSpec, Period
from fernhill.session import scratch_path


def local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_load_reports_is_idempotent(spark):
    src = scratch_path(spark, "t-e1")
    os.makedirs(local(src))
    with open(f"{local(src)}/r.csv", "w") as f:
        f.write("date,views\n20220105,1.5\n20220106,2\n")
    spec = LoadSpec("t", (F_("date", "text", "date"), F_("views", "number", "views")),
                    Period("row_date", ("date",), "yyyyMMdd"))
    out = scratch_path(spark, "t-e1-out")
    load_reports(spark, src, spec, out, run_id="r1")
    load_reports(spark, src, spec, out, run_id="r1")
    rows = sorted((r.date, int(r.views), r.end_date) for r in spark.read.parquet(out).collect())
    assert rows == [("20220105", 2, dt.date(2022, 1, 6)), ("20220106", 2, dt.date(2022, 1, 7))]


def test_load_reports_refuses_changed_files(spark):
    spec = LoadSpec("basic", (F_("date", "text", "date"), F_("views", "number", "views", "Views")))
    src = scratch_path(spark, "t-p7") + "/channel-z/basic"
    os.makedirs(local(src))
    with open(f"{local(src)}/r.csv", "w") as f:
        f.write("date,visits\n20220105,1\n")
    out = scratch_path(spark, "t-p7-out")
    with pytest.raises(MissingColumns):
        load_reports(spark, f"{src}/r.csv", {"basic": spec}, out, run_id="r1")
    assert not os.path.exists(local(out))
    load_reports(spark, src, spec, out, run_id="r1", required=())      # absent columns as null, on request
    assert [r.views for r in spark.read.parquet(out).collect()] == [None]
    # the spec and the channel come from the path; another accepted name will do
    with open(f"{local(src)}/r.csv", "w") as f:
        f.write("date, Views\n20220105,1\n")
    spec = LoadSpec("basic", spec.fields, constants=("channel_name",))
    out = scratch_path(spark, "t-p10-out")
    load_reports(spark, f"{src}/r.csv", {"basic": spec}, out, run_id="r1")
    assert [(int(r.views), r.channel_name) for r in spark.read.parquet(out).collect()] == [(1, "channel-z")]
    # a second file with other columns fails the load and leaves nothing behind
    with open(f"{local(src)}/s.csv", "w") as f:
        f.write("Views,date\n7,20220106\n")
    out = scratch_path(spark, "t-p7-mixed")
    with pytest.raises((PySparkException, Py4JJavaError)):
        load_reports(spark, src, spec, out, run_id="r1")
    assert not os.path.exists(f"{local(out)}/_SUCCESS")


def test_cdn_and_catalogue_jobs(spark):
    logs = scratch_path(spark, "t-e2")
    os.makedirs(local(logs))
    line = "2024-01-01\t10:00:0{s}\tGET\t1.1.1.1\tHTTP/1.1\t-\tag\t1\t1\t1\t2.2.2.2\t0.1\t200\t-\t" \
           "/a/b/c/d/e/f1/x/12345678s0000{p}.ts\t-\t-\t-\n"
    with gzip.open(f"{local(logs)}/a.log.gz", "wt") as f:
        f.write("#Fields: ...\n" + line.format(s=1, p=3) + line.format(s=2, p=7))
    out = scratch_path(spark, "t-e2-out")
    cdn_view_points(spark, logs, out)
    r = spark.read.parquet(out).collect()
    assert [(x.file_id, x.content_ts, x.time) for x in r] == [("f1", 7, "10:00:02")]

    feed = scratch_path(spark, "t-feed")
    os.makedirs(local(feed))
    for stamp, v in (("20220105_000000", 1), ("20220112_000000", 2)):
        with gzip.open(f"{local(feed)}/{stamp}_items.json.gz", "wt") as f:
            f.write('{"item_id": "a", "v": %d}\n' % v)
    latest = catalogue_snapshot(spark, feed, scratch_path(spark, "t-cat"), keys="item_id",
                                schema="item_id string, v int")
    assert [r.v for r in latest.collect()] == [2]
    weds = catalogue_snapshot(spark, feed, scratch_path(spark, "t-wed"), schema="item_id string, v int")
    assert sorted(r.v for r in weds.collect()) == [1, 2]


def test_match_titles_job(spark):
    odd = '"odd",\nback\\slash'
    tmap = spark.createDataFrame([("Foo S01E02", None, None), ("Bar", None, None), (odd, None, None)],
                                 "title string, title_id string, itemset_id string")
    matches = spark.createDataFrame([("bar", "tt9", None, False, None)],
                                    "title string, title_id string, itemset_id string, has_match boolean, "
                                    "match_ts timestamp")
    cands = spark.createDataFrame(
        [("foo", 1, "s1", "series", 2000, 300, None, None, None), ("foo", 2, "e1", "episode", 2000, 10, "s1", 1, 2),
         ("bar", 3, "m1", "movie", 2000, 60, None, None, None)],
        "query string, position long, id string, kind string, year int, votes int, parent_id string, "
        "itemset_no int, item_no int")
    out = match_titles(spark, tmap, matches, cands, scratch_path(spark, "t-e3"))
    got = {r.title: (r.title_id, r.itemset_id, r.has_match) for r in out.collect()}
    assert got == {"foo s01e02": ("tte1", "tts1", True), "bar": ("ttm1", None, True),
                   odd: ("No Results", "No Results", True)}
