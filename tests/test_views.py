"""Furthest view point (C1): fixture rows and the three plans agree on random rows."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from fernhill.operators.views import cdn_furthest_view, furthest_view
from fernhill.plans.derive import access_log_rows
from fernhill.sources.readers import ACCESS_LOG_SCHEMA

SCHEMA = "c_ip string, cs_user_agent string, file_id string, content_ts int, date string, time string"


def test_fixture_rows(spark):
    rows = [
        ("ip", "ag", "f", 5, "d2", "t1"),
        ("ip", "ag", "f", 5, "d1", "t9"),
        ("ip", "ag", "f", 3, "d0", "t0"),
        ("ip", None, "f", 9, "d0", "t0"),
        ("ip", "ag", "f", None, "d0", "t0"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for method in ("aggregate", "two_step", "self_join"):
        out = furthest_view(df, method=method).collect()
        assert [tuple(r) for r in out] == [("ip", "ag", "f", 5, "d1", "t1")], method
    paired = furthest_view(df, paired=True).collect()
    assert [tuple(r) for r in paired] == [("ip", "ag", "f", 5, "d1", "t9")]


row = st.tuples(
    st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y"]), st.sampled_from(["f1", "f2", None]),
    st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from(["d1", "d2", "d3"])),
    st.one_of(st.none(), st.sampled_from(["t1", "t2", "t3"])))


@settings(max_examples=15, deadline=None)
@given(st.lists(row, min_size=0, max_size=25))
def test_plans_agree(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for paired in (False, True):
        ref = sorted(tuple(r) for r in furthest_view(df, paired=paired, method="self_join").collect())
        for method in ("aggregate", "two_step"):
            got = sorted(tuple(r) for r in furthest_view(df, paired=paired, method=method).collect())
            assert got == ref, (method, paired)


def test_cdn_job_on_log_rows(spark):
    ev = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 3, 10, 0, 0), 7, "view", 42.0, '{"k": 12}'),
         (2, dt.datetime(2024, 1, 3, 9, 0, 0), 7, "view", 44.0, '{"k": 15}'),
         (3, dt.datetime(2024, 1, 3, 8, 0, 0), 7, "view", 12.0, '{"k": 11}'),
         (4, dt.datetime(2024, 1, 3, 8, 0, 0), 7, "error", 99.0, '{"k": 11}'),
         (5, dt.datetime(2024, 1, 3, 8, 0, 0), 7, "view", 3.0, '{"k": 11}')],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    log = access_log_rows(ev)
    assert log.columns == [f.name for f in ACCESS_LOG_SCHEMA.fields]
    out = cdn_furthest_view(log, "src").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.c_ip, r.cs_user_agent, r.file_id, r.content_ts, r.date, r.time) == \
        ("10.0.0.7", "view", "f1", 4, "2024-01-03", "09:00:00")
    assert r.SOURCE_DIR == "src" and r.RUN_TS is not None
