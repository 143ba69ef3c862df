"""Furthest view point per viewer and file (A1, J1, A2; job C1).

The source job computes it as: max point per (ip, agent, file) -> inner join
back on the four keys -> min date and min time per four keys. As written that
is three shuffles and two scans. ``furthest_view`` gives the same rows with a
single hash-partitioned aggregation:

* rows whose key or point is null are dropped first (they vanish in the
  inner join of the source job too);
* per (ip, agent, file): ``max(point)``, and for each "first" column the
  value of ``min_by(col, (-point, col is null, col))`` -- the smallest
  non-null value among the rows at the maximum point.

Every aggregate is declarative, so Spark combines map-side before the one
shuffle: a key holding a third of all rows still sends one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import from_position, path_part, strip_media_suffix, try_int
from ..functions.predicates import suffix_and_status

VIEW_KEYS = ("c_ip", "cs_user_agent", "file_id")


def group_max(df: DataFrame, keys: Sequence[str], c: str, alias: str | None = None) -> DataFrame:
    """A1: max of ``c`` per keys."""
    return df.groupBy(*keys).agg(F.max(c).alias(alias or c))


def group_min(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A2: independent min of each column per keys."""
    return df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in cols])


def join_on_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on a key list; null keys never match."""
    return df.join(other, on=list(keys), how="inner")


def furthest_view(df: DataFrame, keys: Sequence[str] = VIEW_KEYS, progress: str = "content_ts",
                  firsts: Sequence[str] = ("date", "time"), paired: bool = False,
                  method: str = "aggregate") -> DataFrame:
    """Per ``keys``: the maximum ``progress`` and the minimum of each ``firsts`` column
    among the rows at that maximum.

    ``paired=False`` (parity): the minima are independent, so date and time may
    come from two rows. ``paired=True``: both come from the earliest row.
    Null keys and null progress drop out (as in an inner join).

    ``method``: "aggregate" (one shuffle, default), "two_step" (min per four keys,
    then max per three: two shuffles on pre-aggregated rows) or "self_join" (the
    source job's max / join / min, kept for checking).
    """
    keys = list(keys)
    firsts = list(firsts)
    clean = df.select(*keys, progress, *firsts).dropna(subset=keys + [progress])
    out_cols = keys + [progress] + firsts

    if method == "self_join":
        mx = group_max(clean, keys, progress)
        merged = join_on_keys(clean, mx, keys + [progress])
        if paired:
            agg = merged.groupBy(*keys, progress).agg(F.min(F.struct(*firsts)).alias("_p"))
            return agg.select(*keys, progress, *[F.col(f"_p.{c}").alias(c) for c in firsts])
        return group_min(merged, keys + [progress], firsts).select(*out_cols)

    if method == "two_step":
        if paired:
            step = clean.groupBy(*keys, progress).agg(F.min(F.struct(*firsts)).alias("_p"))
            best = step.groupBy(*keys).agg(F.max(F.struct(progress, F.col("_p"))).alias("_b"))
            return best.select(*keys, F.col(f"_b.{progress}").alias(progress),
                               *[F.col(f"_b._p.{c}").alias(c) for c in firsts])
        step = group_min(clean, keys + [progress], firsts)
        best = step.groupBy(*keys).agg(F.max(F.struct(progress, *firsts)).alias("_b"))
        return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in [progress] + firsts])

    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    dtype = clean.schema[progress].dataType
    if not isinstance(dtype, T.NumericType):
        return furthest_view(df, keys, progress, firsts, paired, method="two_step")
    neg = -F.col(progress)
    if paired:
        pair = F.struct(*firsts)
        aggs = [F.min_by(pair, F.struct(neg, pair)).alias("_p")]
        sel = [F.col(f"_p.{c}").alias(c) for c in firsts]
    else:
        aggs = [F.min_by(F.col(c), F.struct(neg, F.col(c).isNull(), F.col(c))).alias(c) for c in firsts]
        sel = firsts
    return (clean.groupBy(*keys)
            .agg(F.max(progress).alias(progress), *aggs)
            .select(*keys, progress, *sel))


def view_points(log: DataFrame, suffix: str = "ts", status: str = "200",
                file_part: int = 7, point_part: int = 9, point_from: int = 9) -> DataFrame:
    """Log rows -> (date, time, c_ip, cs_user_agent, file_id, content_ts).

    F1 keeps media segments (``.ts``) served with 200; the URI is split on "/";
    the ``file_part``-th part is the file, the ``point_part``-th part holds the
    content time after ``.ts`` and every "s" are removed (X3), from position
    ``point_from`` (X1), as an int (N3). Short URIs give null, never an error.
    """
    seg = path_part("cs_uri_stem", point_part)
    return (log
            .where(suffix_and_status("cs_uri_stem", suffix, "sc_status", status))
            .select("date", "time", "c_ip", "cs_user_agent",
                    path_part("cs_uri_stem", file_part).alias("file_id"),
                    try_int(from_position(strip_media_suffix(seg), point_from)).alias("content_ts")))


def cdn_furthest_view(log: DataFrame, source_dir: str, paired: bool = False,
                      method: str = "aggregate", run_ts: bool = True) -> DataFrame:
    """Furthest view point per (ip, agent, file) with the source folder and run time."""
    out = furthest_view(view_points(log), paired=paired, method=method)
    out = out.withColumn("SOURCE_DIR", F.lit(source_dir))
    if run_ts:
        out = out.withColumn("RUN_TS", F.current_timestamp())
    return out
