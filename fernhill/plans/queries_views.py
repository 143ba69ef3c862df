"""Queries for the CDN view-point job (C1 and its parts) and catalogue snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import file_stamp, from_position, path_part, strip_media_suffix, tail, try_int
from ..functions.predicates import on_weekday, suffix_and_status
from ..operators.snapshots import catalogue_latest, latest_per_key, rank_first, weekday_snapshots
from ..operators.views import cdn_furthest_view, group_max, group_min, join_on_keys, view_points
from ..session import scratch_path
from ..sources.readers import read_json_feed, with_source_file
from .derive import access_log_rows, land_stamped_files, snapshot_folder, snapshot_stamp
from .registry import register, table, table_state

# DuckDB: the same log rows as derive.access_log_rows, then the parsed view points.
LOG_CTE = r"""
ev AS (
  SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events
), seg AS (
  SELECT *, 'f' || CAST(k // 10 AS VARCHAR) AS fid,
         CASE WHEN event_type = 'signup' THEN 'short.ts'
              ELSE strftime(ts, '%Y%m%d') || 's' || lpad(CAST(CAST(floor(value / 10) AS INTEGER) AS VARCHAR), 5, '0')
                   || CASE WHEN event_type = 'purchase' THEN '.mp4' ELSE '.ts' END END AS s9
  FROM ev
), log AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M:%S') AS time, 'GET' AS cs_method,
         '10.0.0.' || CAST(user_id AS VARCHAR) AS c_ip, 'HTTP/1.1' AS cs_version, '-' AS cd_referrer,
         event_type AS cs_user_agent, CAST(floor(value) AS INTEGER) AS filesize, 512 AS cs_bytes,
         2048 AS sc_bytes, '192.168.0.1' AS s_ip, value AS time_taken,
         CASE WHEN event_type = 'error' THEN '404' ELSE '200' END AS sc_status, '-' AS cs_uri_query,
         CASE WHEN value < 5 THEN '/vod/' || fid || '.ts' ELSE '/vod/a/b/c/d/' || fid || '/hls/' || s9 END AS cs_uri_stem,
         '-' AS x_byte_range, '-' AS comment, 'HIT' AS sc_x_hw
  FROM seg
), vp AS (
  SELECT date, time, c_ip, cs_user_agent,
         string_split(cs_uri_stem, '/')[7] AS file_id,
         TRY_CAST(substring(regexp_replace(regexp_replace(string_split(cs_uri_stem, '/')[9], '.ts', '', 'g'), 's', '', 'g'), 9) AS INTEGER) AS content_ts
  FROM log WHERE right(cs_uri_stem, 2) = 'ts' AND sc_status = '200'
)"""


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return access_log_rows(table(spark, sf, "events"))


@register("c1_furthest_view", sql=f"""
WITH {LOG_CTE}, mx AS (
  SELECT c_ip, cs_user_agent, file_id, max(content_ts) AS content_ts FROM vp GROUP BY c_ip, cs_user_agent, file_id
)
SELECT vp.c_ip, vp.cs_user_agent, vp.file_id, vp.content_ts, min(vp.date) AS date, min(vp.time) AS time,
       'events' AS SOURCE_DIR
FROM vp JOIN mx ON vp.c_ip = mx.c_ip AND vp.cs_user_agent = mx.cs_user_agent
                AND vp.file_id = mx.file_id AND vp.content_ts = mx.content_ts
GROUP BY vp.c_ip, vp.cs_user_agent, vp.file_id, vp.content_ts
""")
def c1_furthest_view(spark, sf):
    return cdn_furthest_view(_log(spark, sf), source_dir="events", run_ts=False)


@register("a1_group_max", sql=f"""
WITH {LOG_CTE}
SELECT c_ip, cs_user_agent, file_id, max(content_ts) AS content_ts FROM vp GROUP BY c_ip, cs_user_agent, file_id
""")
def a1_group_max(spark, sf):
    return group_max(view_points(_log(spark, sf)), ["c_ip", "cs_user_agent", "file_id"], "content_ts")


@register("a2_group_min", sql="""
SELECT l_returnflag, l_linestatus, l_suppkey, l_linenumber,
       min(l_shipdate) AS l_shipdate, min(l_extendedprice) AS l_extendedprice
FROM lineitem GROUP BY l_returnflag, l_linestatus, l_suppkey, l_linenumber
""")
def a2_group_min(spark, sf):
    li = table(spark, sf, "lineitem")
    return group_min(li, ["l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber"],
                     ["l_shipdate", "l_extendedprice"])


@register("j1_join_on_keys", sql="""
WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, value FROM events),
m AS (SELECT user_id, event_type, day, max(value) AS value FROM e GROUP BY user_id, event_type, day)
SELECT e.user_id, e.event_type, e.day, e.value, e.event_id
FROM e JOIN m ON e.user_id = m.user_id AND e.event_type = m.event_type AND e.day = m.day AND e.value = m.value
""")
def j1_join_on_keys(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type",
                                          F.to_date("ts").alias("day"), "value")
    keys = ["user_id", "event_type", "day"]
    m = group_max(e, keys, "value")
    return join_on_keys(e, m, keys + ["value"]).select(*keys, "value", "event_id")


@register("f1_suffix_status", sql=f"""
WITH {LOG_CTE}
SELECT date, time, c_ip, cs_user_agent, cs_uri_stem FROM log
WHERE right(cs_uri_stem, 2) = 'ts' AND sc_status = '200'
""")
def f1_suffix_status(spark, sf):
    return (_log(spark, sf).where(suffix_and_status("cs_uri_stem", "ts", "sc_status", "200"))
            .select("date", "time", "c_ip", "cs_user_agent", "cs_uri_stem"))


@register("x1_substring", sql=f"""
WITH {LOG_CTE}
SELECT cs_uri_stem, right(cs_uri_stem, 2) AS extension,
       substring(string_split(cs_uri_stem, '/')[9], 9) AS from_ninth
FROM log
""")
def x1_substring(spark, sf):
    log = _log(spark, sf)
    return log.select("cs_uri_stem", tail("cs_uri_stem", 2).alias("extension"),
                      from_position(path_part("cs_uri_stem", 9), 9).alias("from_ninth"))


@register("x2_split_part", sql=f"""
WITH {LOG_CTE}
SELECT cs_uri_stem, string_split(cs_uri_stem, '/')[7] AS part7,
       string_split(cs_uri_stem, '/')[9] AS part9, string_split(cs_uri_stem, '/')[12] AS part12
FROM log
""")
def x2_split_part(spark, sf):
    log = _log(spark, sf)
    return log.select("cs_uri_stem", path_part("cs_uri_stem", 7).alias("part7"),
                      path_part("cs_uri_stem", 9).alias("part9"), path_part("cs_uri_stem", 12).alias("part12"))


@register("x3_regex_replace", sql=f"""
WITH {LOG_CTE}
SELECT cs_uri_stem,
       regexp_replace(regexp_replace(string_split(cs_uri_stem, '/')[9], '.ts', '', 'g'), 's', '', 'g') AS stripped
FROM log
""")
def x3_regex_replace(spark, sf):
    log = _log(spark, sf)
    return log.select("cs_uri_stem", strip_media_suffix(path_part("cs_uri_stem", 9)).alias("stripped"))


@register("n3_try_int", sql=f"""
WITH {LOG_CTE}
SELECT cs_uri_stem, string_split(cs_uri_stem, '/')[9] AS part9, content_ts FROM (
  SELECT cs_uri_stem,
         TRY_CAST(substring(regexp_replace(regexp_replace(string_split(cs_uri_stem, '/')[9], '.ts', '', 'g'), 's', '', 'g'), 9) AS INTEGER) AS content_ts
  FROM log)
""")
def n3_try_int(spark, sf):
    log = _log(spark, sf)
    p9 = path_part("cs_uri_stem", 9)
    return log.select("cs_uri_stem", p9.alias("part9"),
                      try_int(from_position(strip_media_suffix(p9), 9)).alias("content_ts"))


# ------------------------------------------------------------ snapshots

@register("w1_latest_per_key", sql="""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1
""")
def w1_latest_per_key(spark, sf):
    return latest_per_key(table(spark, sf, "events"), "user_id", order=["ts"], tie_breaker=["event_id"])


@register("f2_rank_one", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT l_orderkey, l_linenumber, l_extendedprice,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber DESC) AS rn
  FROM lineitem
) WHERE rn = 1
""")
def f2_rank_one(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rank_first(li, ["l_orderkey"], ["l_extendedprice", "l_linenumber"])


@register("f3_weekday", sql="""
SELECT event_id, ts, user_id FROM events WHERE dayofweek(ts) = 3
""")
def f3_weekday(spark, sf):
    return table(spark, sf, "events").where(on_weekday("ts", 4)).select("event_id", "ts", "user_id")


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
_FEEDS: dict[tuple, str] = {}


def landed_feed(spark: SparkSession, sf: str) -> str:
    """Land ``events`` as a gzip JSON-lines catalogue feed, one folder per day
    (``snap=yyyyMMdd_000000``), under the shared scratch folder; once per state of the table."""
    key = ("folders", *table_state(spark, sf, "events"))
    if key not in _FEEDS:
        path = scratch_path(spark, "feed")
        (table(spark, sf, "events").withColumn("snap", snapshot_folder())
         .write.partitionBy("snap").option("compression", "gzip")
         .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))
        _FEEDS[key] = path
    return _FEEDS[key]


def landed_files(spark: SparkSession, sf: str) -> str:
    """Land ``events`` as files named ``yyyyMMdd_000000_items.json.gz``, below a folder
    that carries a stamp of its own; once per state of the table."""
    key = ("files", *table_state(spark, sf, "events"))
    if key not in _FEEDS:
        path = scratch_path(spark, "feed") + "/20230101_000000"
        events = table(spark, sf, "events")
        land_stamped_files(events.withColumn("snap", snapshot_stamp(events)), "snap", path)
        _FEEDS[key] = path
    return _FEEDS[key]


def _file_feed(spark, sf):
    return with_source_file(read_json_feed(spark, landed_files(spark, sf), schema=EVENTS_SCHEMA, glob="*.gz"))


# the stamp of derive.snapshot_stamp
STAMP_SQL = ("CASE WHEN user_id % 2 = 0 THEN date_trunc('day', ts) ELSE TIMESTAMP '2024-12-31' "
             "- (date_trunc('day', ts) - TIMESTAMP '2024-01-01') END")


def _feed(spark, sf):
    return with_source_file(read_json_feed(spark, landed_feed(spark, sf), schema=EVENTS_SCHEMA))


@register("s2_json_feed", sql="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s2_json_feed(spark, sf):
    return read_json_feed(spark, landed_feed(spark, sf), schema=EVENTS_SCHEMA)


@register("s8_source_file", sql="""
SELECT event_id, strftime(ts, '%Y%m%d_000000') AS snapshot FROM events
""")
def s8_source_file(spark, sf):
    return _feed(spark, sf).select("event_id", F.regexp_extract("source_filename", r"snap=(\d{8}_\d{6})", 1)
                                   .alias("snapshot"))


@register("t5_file_stamp", sql=f"""
SELECT event_id, {STAMP_SQL} AS report_ts, strftime({STAMP_SQL}, '%Y-%m-%d %H:%M:%S') AS report_text
FROM events
""")
def t5_file_stamp(spark, sf):
    ts = file_stamp("source_filename")
    return _file_feed(spark, sf).select("event_id", ts.alias("report_ts"),
                                   F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("report_text"))


C2_SQL = f"""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {STAMP_SQL} DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1
"""


@register("c2_catalogue_latest", sql=C2_SQL)
def c2_catalogue_latest(spark, sf):
    """The newest file (by name) decides, though it may hold older rows."""
    return catalogue_latest(_file_feed(spark, sf), "user_id", tie_breaker=["event_id"]).drop("source_filename")


@register("c2_latest_by_stamp", sql=C2_SQL)
def c2_latest_by_stamp(spark, sf):
    """C2 by the stamp parsed from the file name: the files of one snapshot rank as equals."""
    out = catalogue_latest(_file_feed(spark, sf), "user_id", tie_breaker=["event_id"], by_stamp=True)
    return out.drop("source_filename")


@register("c3_weekday_files", sql=f"""
SELECT event_id, user_id, event_type, value, {STAMP_SQL} AS report_ts
FROM events WHERE dayofweek({STAMP_SQL}) = 3
""")
def c3_weekday_files(spark, sf):
    """The weekday comes from the stamp in the file name."""
    out = weekday_snapshots(_file_feed(spark, sf))
    return out.select("event_id", "user_id", "event_type", "value", "report_ts")


@register("c3_weekday_snapshots", sql="""
SELECT event_id, user_id, event_type, value, date_trunc('day', ts) AS report_ts
FROM events WHERE dayofweek(ts) = 3
""")
def c3_weekday_snapshots(spark, sf):
    """Snapshot folders are a partition column, so the weekday filter prunes folders."""
    feed = read_json_feed(spark, landed_feed(spark, sf), schema=EVENTS_SCHEMA, recursive=False)
    out = weekday_snapshots(feed, stamp_col="snap")
    return out.select("event_id", "user_id", "event_type", "value", "report_ts")
