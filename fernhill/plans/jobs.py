"""The reference's three entry points as Spark jobs: path in, path out.

E1 ``load_reports``: landed partner reports -> typed rows appended to a table.
E2 ``cdn_view_points`` / ``catalogue_snapshot``: logs or feeds -> parquet.
E3 ``match_titles``: title map + match table + candidates -> new match table.

Each is a handful of lines over the operators: the point is that every stage
of the reference's hand-over chain (file keys, payloads, rendered SQL) becomes
one lazy plan, with one written table where a stage's output is reused.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.resolve import record_matches, resolve_titles, titles_to_match
from ..operators.snapshots import catalogue_latest, weekday_snapshots
from ..operators.views import cdn_furthest_view
from ..session import scratch_path
from ..operators.shaping import require_columns, require_names
from ..sinks.writers import append_load, write_matches_csv, write_parquet
from ..sources.dynamic import read_dynamic_csv
from ..sources.files import file_manifest
from ..sources.readers import read_access_log, read_json_feed, read_report_csv, with_source_file
from ..sources.split_csv import read_split_csv
from .loads import LoadSpec, load_dynamic, load_projection, spec_for_path


def load_reports(spark: SparkSession, path: str, spec: LoadSpec | Mapping[str, LoadSpec], table_path: str,
                 run_id: str, start=None, end=None, constants: dict | None = None, idempotent: bool = True,
                 na_values=(), required: Sequence[str] | None = None, multiline: bool = True, any_header: bool = False) -> None:
    """CSV reports under ``path`` -> typed by ``spec`` -> appended to ``table_path``.

    ``spec`` may be specs by report name: the one for ``.../<channel>/<report>/<file>``
    is taken and the channel joins the constants (P10). ``required`` columns
    (default: one accepted name of each field, and the period's columns; ``()``
    loads absent columns as null, P2) must be in the files or nothing is written
    (P7); every file must carry the same header, or the load fails and commits nothing.
    With ``any_header`` files may differ: each row is read by the names of its own file (P2), all of whose headers must have the required columns.

    ``idempotent`` replaces this run's partition, so re-running a run after a
    failure leaves one copy (the reference's forced reload would double it)."""
    if not isinstance(spec, LoadSpec):
        spec, channel = spec_for_path(path, spec)
        constants = {"channel_name": channel, **(constants or {})}
    if any_header:
        rows, headers = read_dynamic_csv(spark, path)
        for names in headers:
            require_names(names, spec.required(names) if required is None else required)
        typed = load_dynamic(rows, spec, run_id=run_id, start=start, end=end, constants=constants, na_values=na_values)
        append_load(typed, table_path, idempotent=idempotent)
        return
    if multiline:
        raw, file = read_split_csv(spark, path, na_values=na_values, source_col="landed file", same_header=True), F.col("`landed file`")
    else:
        raw, file = read_report_csv(spark, path, na_values=na_values, enforceSchema=False), None
    require_columns(raw, spec.required(raw.columns) if required is None else required)
    typed = load_projection(raw, spec, run_id=run_id, start=start, end=end, constants=constants, source_key=file)
    append_load(typed, table_path, idempotent=idempotent)


def csv_to_parquet(spark: SparkSession, path: str, out: str, threshold: int = 31_457_280, rows_per_part: int = 30_000,
                   force: bool = False, glob: str | None = None, **options) -> None:
    """CSV files under ``path`` -> text parquet, appended to ``out``.

    Files of at least ``threshold`` bytes, or all with ``force``, go to parts of at most
    ``rows_per_part`` rows; the others keep what a read task gives them. Either kind
    is read by byte ranges, so a file of any size is many tasks' work."""
    files = file_manifest(spark, path, glob).withColumn("big", (F.col("length") >= threshold) | F.lit(force))
    by_size = {r.big: r.paths for r in files.groupBy("big").agg(F.collect_list("path").alias("paths")).collect()}   # the names that the reader lists anyway
    for big, paths in sorted(by_size.items()):
        rows = read_split_csv(spark, paths, same_header=True, **options)
        write_parquet(rows, out, rows_per_file=rows_per_part if big else None)


def cdn_view_points(spark: SparkSession, logs: str, out: str, paired: bool = False) -> None:
    """``*.log.gz`` access logs -> furthest view point per viewer and file, appended."""
    log = read_access_log(spark, logs, glob="*.log.gz")
    write_parquet(cdn_furthest_view(log, source_dir=logs, paired=paired), out, mode="append")


def catalogue_snapshot(spark: SparkSession, feed: str, out: str, keys: str | None = None,
                       schema=None, tie_breaker=()) -> DataFrame:
    """Catalogue feed -> latest row per ``keys`` (comma-separated), or the
    Wednesday snapshots when ``keys`` is None; appended to ``out``."""
    df = with_source_file(read_json_feed(spark, feed, schema=schema, glob="*.gz"))
    res = catalogue_latest(df, keys, tie_breaker=tie_breaker) if keys else weekday_snapshots(df)
    write_parquet(res, out, mode="append")
    return res


def match_titles(spark: SparkSession, title_map: DataFrame, matches: DataFrame, candidates: DataFrame,
                 out: str, limit: int | None = None, export: str | None = None, **rules) -> DataFrame:
    """Worklist (C20) -> resolution (C21) -> match file (K6) -> upsert.

    The resolved titles are written once, in parquet, to a fresh folder under
    the shared checkpoint directory and the merge reads them back: every
    character survives, the merge does not recompute the resolution, and a lost
    executor during the merge does not send it back through the search.
    ``export`` also writes the match file (K6). The merged table is written
    to ``out`` (a new version; parquet has no in-place MERGE) and returned as read
    from there.
    """
    work = titles_to_match(title_map, matches, limit=limit)
    found = resolve_titles(work, candidates, assume_distinct=True, **rules)   # the worklist is distinct
    handed = scratch_path(spark, "title-matches")
    found.write.parquet(handed)
    written = spark.read.schema(found.schema).parquet(handed)
    if export is not None:
        write_matches_csv(written, export)
    merged = record_matches(matches, written)
    merged.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out).select(*[F.col(c) for c in matches.columns])
