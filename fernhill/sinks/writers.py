"""Writers (K1–K4, K6, S4 on write)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "append", compression: str = "gzip",
                  rows_per_file: int | None = None, partition_by: Sequence[str] | None = None) -> None:
    """Parquet append (gzip by default; files end ``.gz.parquet``);
    ``rows_per_file`` caps rows per output file (the 30,000-row parts)."""
    w = df.write.mode(mode).option("compression", compression)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", int(rows_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_per_sheet(df: DataFrame, path: str, sheet_col: str = "sheet", mode: str = "append") -> None:
    """K3: one output folder per sheet (``sheet=<name>/``)."""
    write_parquet(df, path, mode=mode, partition_by=[sheet_col])


def append_load(df: DataFrame, path: str, columns: Sequence[str] | None = None,
                run_id: str | None = None, idempotent: bool = False, run_col: str = "run_id") -> None:
    """K4: append rows to a table folder, matching columns by name.

    ``idempotent=True`` partitions by the run id and overwrites only that run's
    partition (dynamic partition overwrite), so reloading a run leaves one copy.
    """
    out = df
    if run_id is not None:
        out = out.withColumn(run_col, F.lit(run_id))
    if columns is not None:
        out = out.select(*[F.col(f"`{c}`") for c in columns])
    w = out.write
    if idempotent:
        if run_col not in out.columns:
            raise ValueError("idempotent load needs a run id column")
        (w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(run_col).parquet(path))
    else:
        w.mode("append").parquet(path)


def write_report_csv(df: DataFrame, path: str, mode: str = "append", rows_per_file: int | None = None,
                     compression: str | None = None) -> None:
    """CSV with a header and standard quoting (quotes doubled, blanks kept),
    in parts of at most ``rows_per_file`` rows when given. ``compression`` (as "gzip", at its
    quickest level) suits files that are read whole: a compressed one is not split."""
    w = (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if rows_per_file:
        w = w.option("maxRecordsPerFile", int(rows_per_file))
    if compression:
        w = w.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    w.csv(path)


def write_matches_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K6: CSV with a header of (title, title id, itemset id). An export: an empty
    text is written as ``""``, which readers commonly take for null."""
    write_report_csv(df, path, mode=mode)
