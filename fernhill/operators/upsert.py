"""Upsert by key (J3, K5) on plain files.

``MERGE INTO`` needs a table format with row-level writes; parquet folders
refuse it. ``upsert`` returns the merged table as a DataFrame -- one full
outer join on the key (one shuffle of each side; with both sides bucketed
by the key on write, none) -- to be written to a new version folder.
A table that does support it takes ``DataFrame.mergeInto`` as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """The merge source holds one key more than once."""


def upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str],
           update: Mapping[str, Column | str] | None = None,
           insert: Mapping[str, Column | str] | None = None, check: bool = True,
           distinct_source: bool = False) -> DataFrame:
    """Merged table: matched target rows get ``update`` (column -> expression over
    source columns, prefixed ``s.``, or target columns ``t.``); unmatched source rows are
    inserted with ``insert``; other target rows stay. Columns and order follow ``target``.

    With no ``update``/``insert`` given every non-key column is taken from the source.

    The source is first aggregated by key (one shuffle, map-side combined); that
    aggregation also counts rows per key, and with ``check`` a key seen twice
    fails the job (``raise_error``) instead of running a separate check job.
    ``distinct_source`` lets identical duplicate source rows count as one. The
    join then finds the source already partitioned by key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = target.columns
    non_keys = [c for c in cols if c not in keys]
    src_vals = [c for c in source.columns if c not in keys]
    update = dict(update) if update is not None else {c: f"s.{c}" for c in non_keys}
    insert = dict(insert) if insert is not None else {c: f"s.{c}" for c in cols}

    def expr(v: Column | str) -> Column:
        return F.col(v) if isinstance(v, str) else v

    row = F.struct(*[F.col(c) for c in src_vals]) if src_vals else F.lit(True)
    agg = source.groupBy(*keys).agg(F.min(row).alias("__lo"), F.max(row).alias("__hi"),
                                    F.count(F.lit(1)).alias("__n"))
    dup = ~F.col("__lo").eqNullSafe(F.col("__hi")) if distinct_source else (F.col("__n") > 1)
    first_key = keys[0]
    guarded = F.col(first_key)
    if check:
        guarded = F.when(dup, F.raise_error(F.lit(f"merge source has duplicate keys on {keys}"))) \
            .otherwise(F.col(first_key))
    src = agg.select(*[guarded.alias(k) if k == first_key else F.col(k) for k in keys],
                     *[F.col(f"__lo.{c}").alias(c) for c in src_vals])

    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = src.withColumn("__s", F.lit(True)).alias("s")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    matched = F.col("t.__t").isNotNull() & F.col("s.__s").isNotNull()
    only_s = F.col("t.__t").isNull()

    out = []
    for c in cols:
        kept = F.col(f"t.{c}")
        upd = expr(update[c]) if c in update else kept
        ins = expr(insert[c]) if c in insert else F.lit(None)
        if c in keys:
            upd, ins = kept, F.col(f"s.{c}")
        out.append(F.when(matched, upd).when(only_s, ins).otherwise(kept).cast(target.schema[c].dataType).alias(c))
    return j.select(out)
