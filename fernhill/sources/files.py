"""Choosing inputs (S9, S11, S12): file manifests, message attachments, unique ids.

A manifest is a DataFrame of file paths (``binaryFile`` with the content
column pruned away), so choosing among millions of landed files is a
distributed filter, not a driver-side loop.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import base_name
from ..functions.predicates import all_given


def file_manifest(spark: SparkSession, path: str, glob: str | None = None,
                  recursive: bool = True) -> DataFrame:
    """Paths, sizes and times of the files under ``path``; file contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "modificationTime", "length")


def full_match_any(c: Column, patterns: Sequence[str]) -> Column:
    """True when ``c`` fully matches one of the regexes."""
    return reduce(lambda a, b: a | b, [c.rlike(f"^(?:{p})$") for p in patterns])


def select_files(manifest: DataFrame, patterns: Sequence[str] | None = None,
                 path_col: str = "path") -> DataFrame:
    """Paths whose base name fully matches any pattern, distinct; no patterns = all, distinct."""
    df = manifest.select(path_col)
    if patterns:
        df = df.where(full_match_any(base_name(path_col), patterns))
    return df.distinct()


def select_attachments(messages: DataFrame, after, before, sender: str | None = None,
                       subject: str | None = None, suffixes: Iterable[str] | None = None,
                       created: str = "created", sender_col: str = "sender",
                       subject_col: str = "subject", attachments: str = "attachments") -> DataFrame:
    """Attachments of messages created strictly between two times, optionally
    from a sender / with a subject containing given text, whose name ends with any
    suffix; distinct (attachment, message fields)."""
    t = F.col(created)
    cond = all_given(
        t > F.lit(after),
        t < F.lit(before),
        F.col(sender_col).contains(sender) if sender else None,
        F.col(subject_col).contains(subject) if subject else None,
    )
    out = messages.where(cond).select(F.explode(F.col(attachments)).alias("attachment"))
    sfx = list(suffixes or [])
    if sfx:
        out = out.where(reduce(lambda a, b: a | b, [F.col("attachment").endswith(s) for s in sfx]))
    return out.distinct()


def unique_ids(dfs: Iterable[DataFrame], column: str) -> DataFrame:
    """Unique non-null values of ``column`` over many inputs (union, drop nulls, distinct).

    Unreadable files are skipped when the session sets ``spark.sql.files.ignoreCorruptFiles``.
    The distinct is a hash aggregate with map-side combine, so a value that fills
    a third of the rows still sends one row per map task.
    """
    parts = [d.select(F.col(column)) for d in dfs]
    return reduce(DataFrame.unionByName, parts).dropna().distinct()
