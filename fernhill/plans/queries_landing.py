"""Queries for landed files as they come: big ones, broken ones, and tables that
change in place (S3, S4, S6, S12, K5, C22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.resolve import record_matches_bucketed
from ..session import scratch_path
from ..sinks.bucketed import create_bucketed, read_bucketed, upsert_bucketed
from ..sinks.ledger import load_once, read_loads
from ..sinks.writers import write_report_csv
from ..sources.archive import archive_errors, read_archive_members
from ..sources.dynamic import read_dynamic_csv
from ..sources.quarantine import file_ledger, good_rows, read_outcomes
from ..sources.readers import read_report_csv
from ..sources.schema_registry import read_registered
from ..sources.split_csv import read_split_csv
from ..streaming.latest import keep_latest, read_latest
from .derive import page_archives, part_reports
from .jobs import csv_to_parquet
from .loads import F_, LoadSpec, Period, load_dynamic
from .queries_titles import RECORD_MATCHES_SQL, UPSERT_SQL, _match_rows, _upsert_source
from .registry import register, table, table_state


FILE_BYTES = 64 * 1024 * 1024   # parquet bytes of lineitem behind one landed CSV file (some 200 MB of text)


def land_big_csv(spark, sf, rows, path):
    """``rows`` of lineitem as big CSV files, one for each ``FILE_BYTES`` of the table: one task writes a
    file, so their number, not their size, grows with the table."""
    write_report_csv(rows.coalesce(max(1, table_state(spark, sf, "lineitem")[2] // FILE_BYTES)), path)


@register("s3_split_multiline", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CASE WHEN l_linenumber = 3 THEN NULL
            ELSE 'line "' || l_linestatus || '",' || chr(10) || chr(10) || repeat(l_returnflag || chr(10), l_linenumber) || chr(92) END AS note
FROM lineitem
""")
def s3_split_multiline(spark, sf):
    """S3: big CSV files with line breaks in fields, read by byte ranges cut at record ends."""
    note = F.expr("""CASE WHEN l_linenumber = 3 THEN '' ELSE 'line "' || l_linestatus || '",' || chr(10) || chr(10)
                     || repeat(l_returnflag || chr(10), cast(l_linenumber AS int)) || chr(92) END""")
    path = scratch_path(spark, "one-csv")
    land_big_csv(spark, sf, table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", note.alias("note")), path)
    r = read_split_csv(spark, path)
    return r.select(*(F.col(c).cast(t).alias(c) for c, t in (("l_orderkey", "bigint"), ("l_linenumber", "bigint"), ("l_extendedprice", "double"))), "note")


@register("s4_split_big_csv", sql="""
SELECT l_orderkey, l_linenumber, l_comment, true AS within_limit, true AS enough_parts
FROM (SELECT l_orderkey, l_linenumber, l_linestatus || chr(10) || l_returnflag AS l_comment FROM lineitem)
""")
def s4_split_big_csv(spark, sf):
    """Big CSV files of more than 30,000 rows (from sf0.01 on), split by force into parts of at most 30,000 rows."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr("l_linestatus || chr(10) || l_returnflag").alias("l_comment"))
    path, out = scratch_path(spark, "big-csv"), scratch_path(spark, "big-parts")
    land_big_csv(spark, sf, li, path)
    csv_to_parquet(spark, path, out, force=True, glob="*.csv")
    r = spark.read.parquet(out).withColumn("_f", F.col("_metadata.file_path"))
    parts = r.groupBy("_f").agg(F.count(F.lit(1)).alias("n"))
    whole = parts.agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("rows"))
    enough = whole.select(F.col("parts") >= F.ceil(F.col("rows") / 30_000)).scalar()
    return r.join(parts, "_f").select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"), F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                                      "l_comment", (F.col("n") <= 30_000).alias("within_limit"), enough.alias("enough_parts"))


@register("s6_bad_archives", sql="""
SELECT 'pages/' || CAST(page_id AS VARCHAR) || '.html' AS name, NULL AS rejected FROM pages
UNION ALL
SELECT 'bad-' || CAST(page_id AS VARCHAR) || CASE WHEN page_id % 2 = 0 THEN '.zip' ELSE '.tar.gz' END, true FROM pages
""")
def s6_bad_archives(spark, sf):
    """Page bodies posing as archives among good ones: all members of the good, an error row for each bad one."""
    pages = table(spark, sf, "pages")
    bad = pages.select(F.concat(F.lit("bad-"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".zip").otherwise(".tar.gz")).alias("path"),
                       F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("content"))
    files = page_archives(pages).unionByName(bad)
    members = read_archive_members(spark, files, skip_bad=True).select(F.col("member").alias("name"), F.lit(None).cast("boolean").alias("rejected"))
    return members.unionByName(archive_errors(spark, files).select(F.col("path").alias("name"), F.lit(True).alias("rejected")))


@register("s12_unreadable_files", sql="""
SELECT DISTINCT l_orderkey * 8 + l_linenumber AS id FROM lineitem WHERE (l_orderkey // 64) % 5 > 1 AND l_linenumber <> 2
""")
def s12_unreadable_files(spark, sf):
    """Unique ids over gzip reports, of which every fifth is truncated and every fifth no gzip file."""
    outcomes = read_outcomes(spark, part_reports(table(spark, sf, "lineitem")), required=("id",))
    return good_rows(outcomes, ["id"]).select(F.col("id").cast("bigint").alias("id")).dropna().distinct()


@register("s12_file_ledger", sql="""
SELECT 'report-' || CAST(f AS VARCHAR) || '.csv.gz' AS path, CASE WHEN f % 5 > 1 THEN 'read' ELSE 'rejected' END AS status,
       CASE WHEN f % 5 > 1 THEN n ELSE 0 END AS n_rows, CASE f % 5 WHEN 0 THEN 'truncated gzip' WHEN 1 THEN 'not gzip' END AS reason
FROM (SELECT l_orderkey // 64 AS f, count(*) AS n FROM lineitem GROUP BY f)
""")
def s12_file_ledger(spark, sf):
    """What became of every file: rows read, or why it was set aside."""
    return file_ledger(read_outcomes(spark, part_reports(table(spark, sf, "lineitem")), required=("id",)))


@register("k5_upsert_buckets", sql=UPSERT_SQL)
def k5_upsert_buckets(spark, sf):
    """K5: the upsert on a table in hash buckets; only buckets with a source key are rewritten."""
    root = scratch_path(spark, "bucketed")
    create_bucketed(table(spark, sf, "supplier"), root, "s_suppkey", buckets=32)
    upsert_bucketed(_upsert_source(spark, sf), root)
    return read_bucketed(spark, root)


@register("c22_record_matches_buckets", sql=RECORD_MATCHES_SQL)
def c22_record_matches_buckets(spark, sf):
    """Found ids merged into a match table kept in buckets by title."""
    matches, found = _match_rows(spark, sf)
    root, handed = scratch_path(spark, "match-table"), scratch_path(spark, "title-matches")
    create_bucketed(matches, root, "title", buckets=32)
    found.write.parquet(handed)
    record_matches_bucketed(spark, root, spark.read.schema(found.schema).parquet(handed))
    return read_bucketed(spark, root).drop("match_ts")


#: A report whose partner moved, renamed and dropped columns over time.
DRIFTING = LoadSpec("drifting", (F_("l_orderkey", "bigint", "Order Key"), F_("l_linenumber", "int", "Line No."), F_("discount", "percent", "Discount %", "Disc %"),
                                 F_("tax", "float", "tax/line"), F_("note", "text", "it's a note")), Period("row_date", ("Ship Date",), "yyyy-MM-dd"))


@register("p2_dynamic_rows", sql="""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_linenumber % 3 <> 2 THEN l_linenumber * 7 * 0.01::DOUBLE END AS discount,
       CASE WHEN l_linenumber % 3 <> 1 THEN l_tax::DOUBLE END AS tax, CASE WHEN l_linenumber % 3 = 1 THEN 'a "b"' || chr(10) || l_returnflag END AS note,
       CASE WHEN l_linenumber % 3 <> 0 THEN l_shipdate::DATE END AS start_date
FROM lineitem
""")
def p2_dynamic_rows(spark, sf):
    """Files with different headers, in other orders and spellings, load in one plan by exact name."""
    li, root = table(spark, sf, "lineitem"), scratch_path(spark, "drifting")
    columns = {"Order Key": "l_orderkey", "Line No.": "l_linenumber", "Discount %": "concat(l_linenumber * 7, '%')", "Disc %": "concat(l_linenumber * 7, '%')",
               "tax/line": "l_tax", "TAX/LINE": "l_linestatus", "it's a note": "concat('a \"b\"', chr(10), l_returnflag)", "Ship Date": "cast(cast(l_shipdate AS date) AS string)"}
    layouts = (("Order Key", "Line No.", "tax/line", "Disc %"), ("Ship Date", "Discount %", "it's a note", "Line No.", "Order Key", "TAX/LINE"),
               ("tax/line", "Line No.", "Ship Date", "Order Key"))
    for k, names in enumerate(layouts):
        write_report_csv(li.where(F.col("l_linenumber") % 3 == k).select(*(F.expr(columns[n]).alias(n) for n in names)), f"{root}/layout-{k}")
    rows, _ = read_dynamic_csv(spark, [f"{root}/layout-{k}" for k in range(len(layouts))])
    return load_dynamic(rows, DRIFTING, run_id="run-1").select("l_orderkey", "l_linenumber", "discount", "tax", "note", "start_date")


@register("k4_load_once", sql="""
SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
""")
def k4_load_once(spark, sf):
    """K4: a ledger of loaded files: a second run adds nothing, a new drop adds its files, a forced load doubles what it takes."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    landing, out, schema = scratch_path(spark, "landing-once"), scratch_path(spark, "loaded-once"), "o_orderkey string, o_orderstatus string"
    read = lambda names: read_report_csv(spark, names, schema=schema)
    write_report_csv(o.where("o_orderstatus = 'O'"), f"{landing}/drop-1")
    load_once(spark, landing, out, read, glob="*.csv")
    load_once(spark, landing, out, read, glob="*.csv")
    write_report_csv(o.where("o_orderstatus NOT IN ('O', 'F')"), f"{landing}/drop-2")
    load_once(spark, landing, out, read, glob="*.csv")
    load_once(spark, landing, out, read, force=True, glob="*.csv")
    write_report_csv(o.where("o_orderstatus = 'F'"), f"{landing}/drop-3")
    load_once(spark, landing, out, read, glob="*.csv")
    return read_loads(spark, out, schema).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus")


@register("c2_kept_latest", sql="""
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def c2_kept_latest(spark, sf):
    """C2 over I1: three drops of the feed, the newest first, each merged into the kept table; the feed is read once."""
    e, root = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value"), scratch_path(spark, "kept-latest")
    for k in (2, 0, 1):
        e.where(F.dayofmonth("ts") % 3 == k).write.parquet(f"{root}/landing/drop-{k}")
        keep_latest(spark, f"{root}/landing", e.schema, f"{root}/table", f"{root}/_checkpoint", ["user_id"], ["ts", "event_id"],
                    fmt="parquet", options={"recursiveFileLookup": "true"}, buckets=16)
    return read_latest(spark, f"{root}/table")


@register("s7_registered_schema", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_returnflag = 'R' THEN l_tax END AS l_tax FROM lineitem
""")
def s7_registered_schema(spark, sf):
    """Staged parts that differ in columns and types, read under the schema that a registry keeps."""
    li, root = table(spark, sf, "lineitem"), scratch_path(spark, "registered")
    drops = (("l_returnflag = 'A'", ["l_orderkey", F.col("l_linenumber").cast("smallint").alias("l_linenumber"), "l_quantity"]),
             ("l_returnflag = 'R'", ["l_tax", "l_orderkey", "l_linenumber", "l_quantity"]), ("l_returnflag NOT IN ('A', 'R')", ["l_orderkey", "l_linenumber", "l_quantity"]))
    for k, (which, columns) in enumerate(drops):
        li.where(which).select(*columns).write.parquet(f"{root}/staged/drop-{k}")
        out = read_registered(spark, f"{root}/staged", f"{root}/registry")
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
