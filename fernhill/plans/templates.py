"""Query templates with run parameters.

Parameters are bound, not pasted into the text: ``spark.sql(text, args=...)``
with ``:name`` markers and ``IDENTIFIER(:table)`` for names. Values of
parameters whose name ends in ``_date`` / ``_ts`` are normalised to ISO text
first, so callers can pass dates, datetimes or text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def normalise(name: str, value):
    if name.endswith("_date"):
        if isinstance(value, str):
            value = dt.date.fromisoformat(value[:10])
        if isinstance(value, dt.datetime):
            value = value.date()
        return value.isoformat()
    if name.endswith("_ts"):
        if isinstance(value, str):
            value = dt.datetime.fromisoformat(value)
        if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
            value = dt.datetime(value.year, value.month, value.day)
        return value.isoformat(sep=" ")
    return value


def run_template(spark: SparkSession, text: str, **params) -> DataFrame:
    """Run SQL ``text`` with named, typed parameters."""
    return spark.sql(text, args={k: normalise(k, v) for k, v in params.items()})
