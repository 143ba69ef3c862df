"""Anti joins (J2): SQL ``NOT IN`` semantics and plain ``NOT EXISTS``.

``NOT IN (subquery)`` is null-aware: one null in the subquery empties the
result, and a null probe value is dropped unless the subquery is empty.
Spark plans the built-in null-aware anti join only as a broadcast hash join,
which needs the subquery side to fit in memory. ``not_in`` gets the same rows
with a shuffled left-anti join plus one scalar subquery (is it empty, does it hold a
null: one row), so no side has to be broadcast. The subquery side is made
distinct first (combined map-side), nulls included; that one exchange serves both the
scalar subquery and the join, so the subquery side is read and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_anti(df: DataFrame, other: DataFrame, on: str, other_on: str | None = None) -> DataFrame:
    """NOT EXISTS: rows of ``df`` with no equal key in ``other``; null keys are kept."""
    right = other.select(F.col(other_on or on).alias("__k")).dropna().distinct()
    return df.join(right, F.col(on) == F.col("__k"), "left_anti")


def not_in(df: DataFrame, other: DataFrame, on: str, other_on: str | None = None) -> DataFrame:
    """``df WHERE on NOT IN (SELECT other_on FROM other)``, null-aware."""
    # a struct is never null, so the join adds no null filter to the subquery side, and its
    # plan stays the one that the scalar subquery has: both use the same exchange
    keys = other.select(F.struct(F.col(other_on or on).alias("k")).alias("__k")).distinct()
    stats = keys.select(F.struct(F.count(F.lit(1)).alias("n"),
                                 F.count_if(F.col("__k.k").isNull()).alias("nulls"))).scalar()
    kept = df.join(keys, F.struct(F.col(on).alias("k")) == F.col("__k"), "left_anti")
    return kept.where((stats["n"] == 0) | (F.col(on).isNotNull() & (stats["nulls"] == 0)))
