"""Queries for sources (S1, S3–S7, S9–S12), sinks (K1–K4, K6), incremental
pickup (I1), templates (P9) and path-driven spec choice (P10).

Writers land their files in fresh folders under the shared checkpoint
directory; each query then reads them back, so what is compared is what a
later job would see.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.resolve import resolve_titles
from ..session import scratch_path
from ..sinks.writers import append_load, write_matches_csv, write_parquet, write_per_sheet, write_report_csv
from ..sources.archive import read_archive_members
from ..sources.files import select_attachments, select_files, unique_ids
from ..sources.readers import read_access_log, read_report_csv, read_staged, schema_profile
from ..sources.workbook import read_workbook_cells, sheet_rows, workbook_errors
from ..streaming.incremental import load_new_files
from .derive import access_log_rows, messages, order_workbooks, page_archives, title_candidates
from .loads import channel_of, spec_for_path
from .queries_views import LOG_CTE
from .registry import register, table
from .specs import BY_REPORT
from .templates import run_template

# ------------------------------------------------------------------ sources


@register("s1_access_log", sql=f"""
WITH {LOG_CTE}
SELECT date, time, cs_method, c_ip, cs_version, cd_referrer, cs_user_agent, filesize, cs_bytes, sc_bytes,
       s_ip, time_taken, sc_status, cs_uri_query, cs_uri_stem, x_byte_range, comment, sc_x_hw
FROM log
""")
def s1_access_log(spark, sf):
    """Log rows landed as tab-separated ``.log.gz`` files and read back with the fixed schema."""
    path = scratch_path(spark, "cdn-logs")
    (access_log_rows(table(spark, sf, "events")).write.option("sep", "\t").option("compression", "gzip")
     .csv(path))
    return read_access_log(spark, path, glob="*.gz")


@register("s3_report_csv", sql="""
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'NA' WHEN 'P' THEN NULL
       ELSE 'a "' || o_orderpriority || '", b' || chr(10) || chr(92) || o_orderkey END AS note
FROM orders
""")
def s3_report_csv(spark, sf):
    """S3: header names with a leading blank are trimmed, "NA" is kept, empty is null;
    quotes, commas, line breaks and backslashes inside a field survive."""
    o = table(spark, sf, "orders")
    note = F.when(F.col("o_orderstatus") == "F", "NA").when(F.col("o_orderstatus") == "P", "") \
        .otherwise(F.expr("'a \"' || o_orderpriority || '\", b' || chr(10) || chr(92) || o_orderkey"))
    path = scratch_path(spark, "report-csv")
    write_report_csv(o.select(F.col("o_orderkey").alias(" o_orderkey"), F.col("o_orderstatus").alias("  o_orderstatus"),
                              note.alias("note")), path, rows_per_file=30_000)
    r = read_report_csv(spark, path, multiline=True)
    return r.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus", "note")


@register("s4_split_parts", sql="""
SELECT o_orderkey, o_totalprice, true AS part_within_limit FROM orders
""")
def s4_split_parts(spark, sf):
    """A big CSV written in parts of at most 30,000 rows, read back whole."""
    path = scratch_path(spark, "split-csv")
    write_report_csv(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path, rows_per_file=30_000)
    r = read_report_csv(spark, path).withColumn("_f", F.col("_metadata.file_path"))
    # rows per part: one row a file after the map-side count
    parts = r.groupBy("_f").agg(F.count(F.lit(1)).alias("n"))
    return r.join(parts, "_f").select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                    F.col("o_totalprice").cast("double").alias("o_totalprice"),
                    (F.col("n") <= 30_000).alias("part_within_limit"))


@register("s5_workbook", sql="""
SELECT strftime(o_orderdate, '%m.%Y') AS sheet, CAST(o_orderkey AS VARCHAR) AS "Order Key",
       o_orderstatus AS "Status", o_orderpriority AS "Priority",
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "Order Date",
       CAST(o_custkey // 1000 AS VARCHAR) || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') AS "Customer"
FROM orders
""")
def s5_workbook(spark, sf):
    """Month sheets chosen by regex, 2 rows skipped, header, 2 footer rows dropped,
    columns "A:C,E:F", thousands marks removed; date cells come back as timestamps text."""
    books = order_workbooks(table(spark, sf, "orders"))
    cells = read_workbook_cells(spark, books, header_row=2)
    rows = sheet_rows(cells, sheet_regex=r"\d{2}\.\d{4}", skip=2, skip_footer=2, usecols="A:C,E:F",
                      thousands=",", names=["Order Key", "Status", "Priority", "Order Date", "Customer"])
    return rows.drop("path", "row")


@register("s5_workbook_errors", sql="""
SELECT 'bad-' || CAST(page_id AS VARCHAR) || '.xlsx' AS path FROM pages
""")
def s5_workbook_errors(spark, sf):
    """Unreadable workbooks (page bodies posing as .xlsx) go to a separate
    errors output; the real workbooks built from orders produce no error rows."""
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("bad-"), F.col("page_id").cast("string"), F.lit(".xlsx")).alias("path"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("content"))
    files = order_workbooks(table(spark, sf, "orders")).unionByName(pages)
    return workbook_errors(spark, files).select("path")


@register("s6_archive_members", sql="""
SELECT 'pages/' || CAST(page_id AS VARCHAR) || '.html' AS member, CAST(strlen(coalesce(html, '')) AS BIGINT) AS size,
       md5(coalesce(html, '')) AS content_md5
FROM pages
""")
def s6_archive_members(spark, sf):
    """Members of zip and tar.gz archives, kind from the suffix."""
    arch = page_archives(table(spark, sf, "pages"))
    m = read_archive_members(spark, arch)
    return m.select("member", "size", F.md5("content").alias("content_md5"))


@register("s7_staged_parquet", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_returnflag = 'R' THEN l_tax END AS l_tax FROM lineitem
""")
def s7_staged_parquet(spark, sf):
    """A staged prefix whose parts differ in schema, read with merged schemas."""
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "staged")
    li.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax") \
        .write.parquet(f"{path}/part=a")
    li.where(F.col("l_returnflag") != "R").select("l_orderkey", "l_linenumber", "l_quantity") \
        .write.parquet(f"{path}/part=b")
    return read_staged(spark, path).drop("part")


@register("s9_select_files", sql="""
SELECT DISTINCT url AS path FROM pages
WHERE regexp_full_match(string_split(url, '/')[-1], '[0-9]+\\.html')
   OR regexp_full_match(string_split(url, '/')[-1], '[0-9]+#top')
""")
def s9_select_files(spark, sf):
    """Paths whose base name fully matches any pattern, distinct (page urls as a manifest)."""
    manifest = table(spark, sf, "pages").select(F.col("url").alias("path"))
    return select_files(manifest, [r"[0-9]+\.html", r"[0-9]+#top"])


@register("s9_all_files", sql="SELECT DISTINCT url AS path FROM pages")
def s9_all_files(spark, sf):
    """No patterns: every path, distinct."""
    return select_files(table(spark, sf, "pages").select(F.col("url").alias("path")))


@register("s10_schema_profile", sql="""
SELECT p.position, p.column_name, p.data_type, p.nullable,
       CASE p.column_name WHEN 'event_id' THEN c1 WHEN 'ts' THEN c2 WHEN 'user_id' THEN c3
            WHEN 'event_type' THEN c4 WHEN 'value' THEN c5 ELSE c6 END AS filled
FROM (VALUES (1, 'event_id', 'bigint', true), (2, 'ts', 'timestamp_ntz', true), (3, 'user_id', 'bigint', true),
             (4, 'event_type', 'string', true), (5, 'value', 'double', true), (6, 'props', 'string', true)
     ) AS p(position, column_name, data_type, nullable),
     (SELECT count(event_id) AS c1, count(ts) AS c2, count(nullif(user_id, 7)) AS c3, count(event_type) AS c4,
             count(nullif(value, 0)) AS c5, count(props) AS c6 FROM events) AS n
""")
def s10_schema_profile(spark, sf):
    """Schema and filled rows per column, counted in one pass (some cells blanked)."""
    e = table(spark, sf, "events")
    return schema_profile(e.withColumns({"user_id": F.nullif("user_id", F.lit(7)),
                                         "value": F.nullif("value", F.lit(0.0))}))


@register("s11_select_attachments", sql="""
WITH m AS (
  SELECT ts AS created, 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS sender,
         event_type || ' report' AS subject,
         ['report_' || CAST(event_id AS VARCHAR) || '.xlsx', 'note_' || CAST(event_id AS VARCHAR) || '.txt',
          'data_' || regexp_extract(props, '(\\d+)', 1) || '.csv'] AS attachments
  FROM events
)
SELECT DISTINCT attachment FROM (SELECT unnest(attachments) AS attachment FROM m
  WHERE created > TIMESTAMP '2024-01-05 00:00:00' AND created < TIMESTAMP '2024-01-20 00:00:00'
    AND contains(sender, '@example') AND contains(subject, 'purchase'))
WHERE suffix(attachment, '.xlsx') OR suffix(attachment, '.csv')
""")
def s11_select_attachments(spark, sf):
    msgs = messages(table(spark, sf, "events"))
    after = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    before = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return select_attachments(msgs, after, before, sender="@example", subject="purchase",
                              suffixes=[".xlsx", ".csv"])


@register("s12_unique_ids", sql="""
SELECT DISTINCT id FROM (SELECT l_partkey AS id FROM lineitem UNION ALL SELECT p_partkey FROM part) WHERE id IS NOT NULL
""")
def s12_unique_ids(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    return unique_ids([li, p], "id")


# -------------------------------------------------------------------- sinks


@register("k1_append_parquet", sql="SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def k1_append_parquet(spark, sf):
    """K1: appending the same rows twice doubles the table."""
    path = scratch_path(spark, "append")
    s = table(spark, sf, "supplier")
    write_parquet(s, path, mode="append")
    write_parquet(s, path, mode="append")
    return spark.read.parquet(path)


@register("k2_gzip_parquet", sql="SELECT *, true AS gz_file FROM nation")
def k2_gzip_parquet(spark, sf):
    """K2: gzip-compressed parquet; files are named ``*.gz.parquet``."""
    path = scratch_path(spark, "gzip")
    write_parquet(table(spark, sf, "nation"), path, mode="overwrite", compression="gzip")
    r = spark.read.parquet(path)
    return r.select("*", F.col("_metadata.file_name").endswith(".gz.parquet").alias("gz_file"))


@register("k3_per_sheet", sql="SELECT l_orderkey, l_linenumber, l_returnflag AS sheet FROM lineitem")
def k3_per_sheet(spark, sf):
    """K3: one output folder per sheet (here per return flag), read back with the folder as a column."""
    path = scratch_path(spark, "per-sheet")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("sheet"))
    write_per_sheet(li, path)
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", F.col("sheet").cast("string"))


@register("k4_append_load", sql="""
SELECT o_orderkey, o_orderstatus, run_id FROM (
  SELECT o_orderkey, o_orderstatus, 'run-1' AS run_id FROM orders
  UNION ALL SELECT o_orderkey, o_orderstatus, 'run-2' AS run_id FROM orders)
""")
def k4_append_load(spark, sf):
    """K4, idempotent mode: run-1 loaded twice leaves one copy; run-2 adds its own."""
    path = scratch_path(spark, "load-idem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    append_load(o, path, run_id="run-1", idempotent=True)
    append_load(o, path, run_id="run-1", idempotent=True)
    append_load(o, path, run_id="run-2", idempotent=True)
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", F.col("run_id").cast("string"))


@register("k4_append_twice", sql="""
SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders
""")
def k4_append_twice(spark, sf):
    """K4, append mode (the source's FORCE reload): loading the same file twice keeps both copies."""
    path = scratch_path(spark, "load-append")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    append_load(o, path, columns=["o_orderkey", "o_orderstatus"])
    append_load(o, path, columns=["o_orderkey", "o_orderstatus"])
    return spark.read.parquet(path)


def _titles_csv_sql() -> str:
    from .queries_titles import RAW_TITLES_CTE, resolved_sql

    return f"WITH {RAW_TITLES_CTE}, {resolved_sql('raw_titles')} SELECT title, title_id, itemset_id FROM resolved"


@register("k6_matches_csv", sql=_titles_csv_sql())
def k6_matches_csv(spark, sf):
    """K6: resolved titles written as CSV with a header, read back."""
    from .queries_titles import _raw_titles

    found = resolve_titles(_raw_titles(spark, sf), title_candidates(table(spark, sf, "part")))
    path = scratch_path(spark, "matches-csv")
    write_matches_csv(found, path)
    return read_report_csv(spark, path)


# -------------------------------------------------------- incremental


@register("i1_incremental_pickup", sql="""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
""")
def i1_incremental_pickup(spark, sf):
    """Files land in two drops; three pickup runs load each file exactly once."""
    root = scratch_path(spark, "incremental")
    landing, sink, ckpt = f"{root}/landing", f"{root}/sink", f"{root}/_checkpoint"
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                                          "o_orderstatus", "o_orderpriority")
    schema = "o_orderkey string, o_orderstatus string, o_orderpriority string"
    o.where(F.col("o_orderstatus") != "O").write.option("header", True).csv(f"{landing}/drop=1")
    opts = {"header": "true", "recursiveFileLookup": "true"}
    load_new_files(spark, landing, schema, sink, ckpt, options=opts)
    load_new_files(spark, landing, schema, sink, ckpt, options=opts)   # nothing new: adds nothing
    o.where(F.col("o_orderstatus") == "O").write.option("header", True).csv(f"{landing}/drop=2")
    load_new_files(spark, landing, schema, sink, ckpt, options=opts)
    return spark.read.schema(schema).parquet(sink).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus", "o_orderpriority")


# ------------------------------------------------------------- P9 and P10


@register("p9_run_template", sql="""
SELECT event_id, event_type, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00' AND event_type = 'view'
""")
def p9_run_template(spark, sf):
    """Typed parameters and a table name bound by IDENTIFIER(); ``_date``/``_ts`` values normalised."""
    import datetime as dt

    view = "fernhill_events_src"
    table(spark, sf, "events").createOrReplaceTempView(view)
    text = ("SELECT event_id, event_type, ts FROM IDENTIFIER(:events_table) "
            "WHERE ts >= CAST(:start_date AS TIMESTAMP_NTZ) AND ts < CAST(:end_ts AS TIMESTAMP_NTZ) "
            "AND event_type = :kind")
    return run_template(spark, text, events_table=view, start_date=dt.datetime(2024, 1, 10, 7, 30),
                        end_ts="2024-01-12", kind="view")


@register("p10_path_segments", sql="""
SELECT page_id, string_split(url, '/')[-3] AS channel FROM pages
""")
def p10_path_segments(spark, sf):
    """P10: the channel is a path segment (3rd from the end) as a column."""
    return table(spark, sf, "pages").select("page_id", channel_of(F.col("url"), -3).alias("channel"))


@register("p10_spec_for_path", sql="""
SELECT 'channel-a' AS channel, 'basic_metrics' AS spec, 33 AS n_fields, count(*) AS n_rows FROM lineitem
""")
def p10_spec_for_path(spark, sf):
    """P10: the load spec chosen from ``.../<channel>/<report>/<file>``, applied to rows landed there."""
    from .loads import load_projection
    from .queries_loads import report_columns

    spec, channel = spec_for_path("landing/channel-a/basic_metrics/report_20220105.csv", BY_REPORT)
    root = scratch_path(spark, "landing")
    path = f"{root}/{channel}/{spec.name}"
    li = table(spark, sf, "lineitem")
    write_report_csv(li.select([F.expr(e).alias(n) for n, e in report_columns(spec)]), path, rows_per_file=30_000, compression="gzip")
    typed = load_projection(read_report_csv(spark, path, multiline=True), spec, run_id="run-1")
    got = typed.select(channel_of(F.col("source_key"), -3).alias("channel"))
    return got.groupBy("channel").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "channel", F.lit(spec.name).alias("spec"), F.lit(len(spec.fields)).alias("n_fields"), "n_rows")
