"""Latest row per key (W1, F2) and weekday snapshots (F3); jobs C2 and C3."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import file_stamp, folder_stamp
from ..functions.predicates import on_weekday


def _keys(keys: str | Sequence[str]) -> list[str]:
    """A key list may come as comma-separated text, as job arguments do."""
    if isinstance(keys, str):
        return [k.strip() for k in keys.split(",") if k.strip()]
    return list(keys)


def _desc(c: str | Column) -> Column:
    return F.col(c).desc() if isinstance(c, str) else c


def rank_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """W1 + F2: rows with ``row_number() = 1`` over (partition by keys order by ``order``).

    Names in ``order`` sort descending; pass Columns for other directions.
    The ``= 1`` filter turns into a partial WindowGroupLimit before the shuffle,
    so each map task sends at most one row per key: a hot key stays cheap.
    """
    w = Window.partitionBy(*_keys(keys)).orderBy(*[_desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column] = ("source_filename",),
                   tie_breaker: Sequence[str | Column] = ()) -> DataFrame:
    """Latest row per key (largest ``order``, then ``tie_breaker``; all descending
    unless given as Columns). Without a tie breaker, ties inside one file are arbitrary."""
    return rank_first(df, keys, list(order) + list(tie_breaker))


def catalogue_latest(feed: DataFrame, keys: str | Sequence[str], tie_breaker: Sequence[str | Column] = (),
                     path_col: str = "source_filename", by_stamp: bool = False) -> DataFrame:
    """Latest catalogue row per key, newest file first.

    The source job orders by the file name (names start with a
    ``yyyyMMdd_HHmmss`` stamp). With ``by_stamp`` the stamp parsed from the path
    orders instead, so several part files of one snapshot rank as equals and
    the tie breaker decides among them.
    """
    order = [file_stamp(path_col).desc()] if by_stamp else [path_col]
    return latest_per_key(feed, keys, order=order, tie_breaker=tie_breaker)


def weekday_snapshots(feed: DataFrame, day: int = 4, path_col: str = "source_filename",
                      as_text: bool = False, stamp_col: str | None = None) -> DataFrame:
    """Rows of snapshot files stamped on a given weekday (4 = Wednesday).

    ``report_ts`` is parsed from the ``yyyyMMdd_HHmmss`` stamp in the file path
    (T5) and stays a timestamp; ``as_text`` gives the sink's text form instead.
    When snapshots land in folders read as a partition column (``stamp_col``,
    e.g. ``snap=20240103_000000``), the weekday test becomes a partition filter:
    only the matching folders are listed and read.
    """
    stamp = folder_stamp(stamp_col) if stamp_col else file_stamp(path_col)
    out = feed.withColumn("report_ts", stamp).where(on_weekday("report_ts", day))
    if as_text:
        out = out.withColumn("report_ts", F.date_format("report_ts", "yyyy-MM-dd HH:mm:ss"))
    return out


def first_qualifying(df: DataFrame, key: str | Sequence[str], position: str, qualifies: Column) -> DataFrame:
    """Per key, the first row (by ``position``) that qualifies, else the first row of all."""
    return rank_first(df, key, [qualifies.desc(), F.col(position).asc()])
