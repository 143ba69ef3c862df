"""Report files of which some cannot be read (S12): all good rows, and a ledger of every file.

Each file is opened, unpacked and parsed as a whole inside one task before any of its
rows leaves it, so a truncated or garbled file gives no rows at all and one entry in the ledger with the
reason. The outcome of every expected file is written once to a folder; rows, ledger and rejects are
read from there. No session flag is involved, and a file is never skipped in silence.

A file is one task's work, as gzip files are in any reader, and must fit it; plain files of
many GB are for ``read_split_csv``.
"""

from __future__ import annotations

import csv
import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows of a file that travel together.
BATCH_ROWS = 10_000
OUTCOMES = "path string, row bigint, cells map<string,string>, n_rows bigint, reason string"


class UnreadableFile(ValueError):
    """Why a file is set aside."""


def report_rows(path: str, content: bytes, required: tuple[str, ...] = ()) -> list[dict[str, str | None]]:
    """Records of one CSV file, plain or gzip by its name, by header name; empty fields are null."""
    if path.lower().endswith(".gz"):
        try:
            content = gzip.decompress(content)
        except EOFError:
            raise UnreadableFile("truncated gzip") from None
        except (OSError, zlib.error):
            raise UnreadableFile("not gzip") from None
    if b"\0" in content:
        raise UnreadableFile("binary data")
    try:
        text = content.decode("utf-8-sig")
    except UnicodeDecodeError:
        raise UnreadableFile("not UTF-8") from None
    try:
        records = [r for r in csv.reader(io.StringIO(text, newline=""), strict=True, skipinitialspace=True) if r]
    except csv.Error as e:
        raise UnreadableFile(f"not CSV: {e}") from None
    if not records:
        raise UnreadableFile("no header")
    header = [h.strip() for h in records[0]]
    missing = [c for c in required if c not in header]
    if missing:
        raise UnreadableFile(f"no column {', '.join(missing)}")
    if len(set(header)) < len(header):
        raise UnreadableFile("a column name twice")
    long = next((n for n, r in enumerate(records) if len(r) > len(header)), None)
    if long is not None:
        raise UnreadableFile(f"record {long} has more fields than the header")
    return [{h: v or None for h, v in zip(header, r)} for r in records[1:]]


def read_outcomes(spark: SparkSession, files: str | DataFrame, glob: str | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """Written outcomes: row 0 of each file tells its number of rows or the reason it is set aside; rows from 1 on are its records.

    ``files`` is a folder or a DataFrame of (path, content)."""
    if isinstance(files, str):
        r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        files = (r.option("pathGlobFilter", glob) if glob else r).load(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("row", pa.int64()), ("cells", pa.map_(pa.string(), pa.string())), ("n_rows", pa.int64()), ("reason", pa.string())])
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                path = path.as_py()
                try:
                    rows, reason = report_rows(path, content.as_py() or b"", required), None
                except UnreadableFile as e:
                    rows, reason = [], str(e)
                yield pa.RecordBatch.from_pylist([{"path": path, "row": 0, "cells": None, "n_rows": len(rows), "reason": reason}], schema)
                for at in range(0, len(rows), BATCH_ROWS):
                    part = rows[at:at + BATCH_ROWS]
                    yield pa.RecordBatch.from_pylist(
                        [{"path": path, "row": at + n + 1, "cells": list(c.items()), "n_rows": None, "reason": None} for n, c in enumerate(part)], schema)

    where = scratch_path(spark, "file-outcomes")
    files.select("path", "content").mapInArrow(run, OUTCOMES).write.parquet(where)
    return spark.read.schema(OUTCOMES).parquet(where)


def file_ledger(outcomes: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """path, status (``read``, ``rejected`` or ``missing``), n_rows, reason: one row per file.

    ``expected`` (path) are the files that should have been there. Spark's readers do not
    list files without a byte; those show as missing."""
    told = outcomes.where("row = 0").select(
        "path", F.when(F.col("reason").isNull(), "read").otherwise("rejected").alias("status"), "n_rows", "reason")
    if expected is None:
        return told
    return expected.select("path").distinct().join(told, "path", "full_outer").withColumns(
        {"status": F.coalesce("status", F.lit("missing")), "n_rows": F.coalesce("n_rows", F.lit(0))})


def rejects(outcomes: DataFrame) -> DataFrame:
    """path, reason of the files that were set aside."""
    return outcomes.where("row = 0 AND reason IS NOT NULL").select("path", "reason")


def good_rows(outcomes: DataFrame, columns: list[str]) -> DataFrame:
    """path, row and the named columns (text; null where a file lacks the column) of all records of good files."""
    return outcomes.where("row > 0").select("path", "row", *(F.try_element_at("cells", F.lit(c)).alias(c) for c in columns))


def unique_report_ids(spark: SparkSession, files: str | DataFrame, column: str, glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct non-null values of ``column`` over all readable files, and the ledger of all files."""
    outcomes = read_outcomes(spark, files, glob, required=(column,))
    ids = good_rows(outcomes, [column]).select(column).dropna().distinct()
    return ids, file_ledger(outcomes)
