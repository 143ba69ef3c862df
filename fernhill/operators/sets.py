"""Distinct values, counts, ordered take and stacking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, *cols: str | Column) -> DataFrame:
    """A3/A4: distinct single column or tuple (hash aggregate, map-side combine)."""
    return df.select(*cols).distinct()


def non_null_distinct(df: DataFrame, c: str) -> DataFrame:
    """A5: unique non-null values."""
    return df.select(c).dropna().distinct()


def count_ids(df: DataFrame, c: str, alias: str = "n_ids") -> DataFrame:
    """A5: how many unique non-null values (one row)."""
    return df.agg(F.count_distinct(F.col(c)).alias(alias))


def take(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """L1: ``n`` rows after ordering (a top-n; Spark keeps a bounded heap per task)."""
    return df.orderBy(*order).limit(n)


def stack(*dfs: DataFrame) -> DataFrame:
    """Stack results by column name; columns missing in a part are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
