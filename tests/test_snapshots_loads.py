"""Latest row per key (W1), load projection (P1–P5) and spec rules."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fernhill.operators.snapshots import latest_per_key, weekday_snapshots
from fernhill.plans.loads import F_, LoadSpec, Period, load_projection, spec_for_path
from fernhill.plans.specs import BY_REPORT, SPECS


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.text("ab", max_size=2), st.integers(0, 100)),
                max_size=30))
def test_latest_one_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k1 int, k2 int, f string, n int")
    out = latest_per_key(df, "k1, k2", order=["f"], tie_breaker=["n"]).collect()
    keys = [(r.k1, r.k2) for r in out]
    assert len(keys) == len(set(keys)) == len({(r[0], r[1]) for r in rows})
    for r in out:
        best = max((f, n) for k1, k2, f, n in rows if (k1, k2) == (r.k1, r.k2))
        assert (r.f, r.n) == best


def test_weekday_snapshots(spark):
    df = spark.createDataFrame([("s3://b/feed/20220105_101112_x.json.gz", 1), ("s3://b/feed/20220106_000000.gz", 2)],
                               "source_filename string, v int")
    out = weekday_snapshots(df).collect()
    assert [(r.v, r.report_ts) for r in out] == [(1, dt.datetime(2022, 1, 5, 10, 11, 12))]


SPEC = LoadSpec("t", (
    F_("d", "date:yyyyMMdd", "Day"),
    F_("n", "number", "Views"),
    F_("m", "number?", "Maybe"),
    F_("pct", "percent", "Completion %"),
    F_("share", "float", "Share of Monthly Total", "Share of Monethly Total"),
    F_("gone", "text", "not_in_file"),
), Period("row_date", ("Day",), "yyyyMMdd"), constants=("channel_name",))


def test_load_projection(spark):
    df = spark.createDataFrame([("20220131", "2.5", "x", "95%", "0.5")],
                               "Day string, Views string, Maybe string, `Completion %` string, "
                               "`Share of Monethly Total` string")
    out = load_projection(df, SPEC, run_id="r1", constants={"channel_name": "c"}, source_key=F.lit("s3://b/k"))
    r = out.first()
    assert r.d == dt.date(2022, 1, 31) and int(r.n) == 3 and r.m is None
    assert r.pct == pytest.approx(0.95) and r.share == 0.5 and r.gone is None
    assert (r.start_date, r.end_date) == (dt.date(2022, 1, 31), dt.date(2022, 2, 1))
    assert r.channel_name == "c" and r.run_id == "r1" and r.source_key == "s3://b/k" and r.loaded_ts
    assert out.columns[-5:] == ["source_key", "loaded_ts", "start_date", "end_date", "run_id"]


def test_strict_cast_raises(spark):
    df = spark.createDataFrame([("20220131", "12x")], "Day string, Views string")
    with pytest.raises(PySparkException):
        load_projection(df, SPEC, source_key=F.lit("k")).collect()


def test_names_are_case_sensitive(spark):
    df = spark.createDataFrame([("20220131", "1")], "day string, views string")
    r = load_projection(df, SPEC, source_key=F.lit("k")).first()
    assert r.d is None and r.n is None


def test_spec_refuses_duplicate_targets():
    with pytest.raises(ValueError):
        LoadSpec("bad", (F_("a", "text", "x"), F_("a", "text", "y")))


def test_sixteen_specs_and_path_choice():
    assert len(SPECS) == 16
    spec, channel = spec_for_path("land/channel-9/demographics/file.csv", BY_REPORT)
    assert spec.name == "demographics" and channel == "channel-9"
    assert len(SPECS["c5"].fields) + 1 + 5 == 39
