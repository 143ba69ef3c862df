"""Queries for scalar functions (N, T, X) and row predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import casts as X
from ..functions.predicates import all_given, candidate_qualifies, flag_true, non_blank, year_matches
from ..operators.shaping import blank_nulls
from .registry import register, table

# ------------------------------------------------------------------ numbers


@register("n1_whole_number", sql="""
SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,0)) AS price_whole,
       CAST(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,0)) AS BIGINT) AS price_long
FROM lineitem
""")
def n1_whole_number(spark, sf):
    li = table(spark, sf, "lineitem")
    txt = F.col("l_extendedprice").cast("string")
    return li.select("l_orderkey", "l_linenumber", X.whole_number(txt).alias("price_whole"),
                     X.whole_long(txt).alias("price_long"))


@register("n2_try_number", sql="""
SELECT p_partkey, TRY_CAST(p_name AS DECIMAL(38,0)) AS name_number,
       TRY_CAST(CAST(p_retailprice / 7 AS DECIMAL(18,9)) AS DECIMAL(10,5)) AS price_5,
       TRY_CAST(CAST(p_size AS VARCHAR) || 'x' AS DECIMAL(38,0)) AS junk
FROM part
""")
def n2_try_number(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.try_whole_number("p_name").alias("name_number"),
                    X.try_whole_number((F.col("p_retailprice") / 7).cast("decimal(18,9)"), 10, 5).alias("price_5"),
                    X.try_whole_number(F.concat(F.col("p_size").cast("string"), F.lit("x"))).alias("junk"))


# -------------------------------------------------------------------- dates


@register("t1_date_format", sql="""
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS d_iso,
       CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS d_compact
FROM orders
""")
def t1_date_format(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey",
                    X.date_from(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("d_iso"),
                    X.date_from(F.date_format("o_orderdate", "yyyyMMdd"), "yyyyMMdd").alias("d_compact"))


@register("t2_try_date", sql="""
SELECT o_orderkey,
       CAST(TRY_STRPTIME(CASE WHEN o_orderstatus = 'F' THEN '' WHEN o_orderstatus = 'P' THEN 'n/a'
                         ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS d,
       TRY_STRPTIME(CASE WHEN o_orderstatus = 'F' THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END,
                    '%Y-%m-%d %H:%M:%S') AS ts
FROM orders
""")
def t2_try_date(spark, sf):
    o = table(spark, sf, "orders")
    st = F.col("o_orderstatus")
    dtxt = F.when(st == "F", "").when(st == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    ttxt = F.when(st == "F", "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select("o_orderkey", X.try_date(dtxt, "yyyy-MM-dd").alias("d"),
                    X.try_timestamp(ttxt, "yyyy-MM-dd HH:mm:ss").alias("ts"))


@register("t3_timestamp_text_date", sql="""
SELECT event_id, CAST(CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS DATE) AS d FROM events
""")
def t3_timestamp_text_date(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", X.timestamp_text_date(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("d"))


@register("t4_next_day_month", sql="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate + INTERVAL 1 DAY AS DATE) AS next_day,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month
FROM orders
""")
def t4_next_day_month(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select("o_orderkey", "d", X.next_day("d").alias("next_day"), X.next_month("d").alias("next_month"))


@register("t6_quarter_period", sql="""
WITH f AS (
  SELECT o_orderkey, 'reports/' || strftime(o_orderdate, '%Y') || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR)
         || '_TRC.xlsx' AS file_name FROM orders
)
SELECT o_orderkey, file_name,
       make_date(CAST(regexp_extract(file_name, '(\\d{4})_Q(\\d)_TRC', 1) AS INTEGER),
                 CAST(regexp_extract(file_name, '(\\d{4})_Q(\\d)_TRC', 2) AS INTEGER) * 3 - 2, 1) AS start_date,
       CAST(make_date(CAST(regexp_extract(file_name, '(\\d{4})_Q(\\d)_TRC', 1) AS INTEGER),
                 CAST(regexp_extract(file_name, '(\\d{4})_Q(\\d)_TRC', 2) AS INTEGER) * 3 - 2, 1)
            + INTERVAL 3 MONTH AS DATE) AS end_date
FROM f
""")
def t6_quarter_period(spark, sf):
    o = table(spark, sf, "orders")
    name = F.concat(F.lit("reports/"), F.date_format("o_orderdate", "yyyy"), F.lit("_Q"),
                    F.quarter("o_orderdate").cast("string"), F.lit("_TRC.xlsx"))
    start, end = X.quarter_period(F.col("file_name"))
    return o.select("o_orderkey", name.alias("file_name")).select(
        "o_orderkey", "file_name", start.alias("start_date"), end.alias("end_date"))


@register("t7_month_period", sql="""
WITH s AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Summary' ELSE strftime(o_orderdate, '%m.%Y') END AS sheet
  FROM orders
)
SELECT o_orderkey, sheet, CAST(TRY_STRPTIME(sheet, '%m.%Y') AS DATE) AS start_date,
       CAST(CAST(TRY_STRPTIME(sheet, '%m.%Y') AS DATE) + INTERVAL 1 MONTH AS DATE) AS end_date
FROM s WHERE TRY_STRPTIME(sheet, '%m.%Y') IS NOT NULL
""")
def t7_month_period(spark, sf):
    o = table(spark, sf, "orders")
    sheet = F.when(F.col("o_orderstatus") == "P", "Summary").otherwise(F.date_format("o_orderdate", "MM.yyyy"))
    start, end = X.month_period(F.col("sheet"))
    return (o.select("o_orderkey", sheet.alias("sheet"))
            .select("o_orderkey", "sheet", start.alias("start_date"), end.alias("end_date"))
            .where(F.col("start_date").isNotNull()))


@register("t8_day_window", sql="""
SELECT event_id, ts FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-20' - INTERVAL 7 DAY
  AND CAST(ts AS DATE) < DATE '2024-01-20' - INTERVAL 7 DAY + INTERVAL 3 DAY
""")
def t8_day_window(spark, sf):
    e = table(spark, sf, "events")
    return e.where(X.day_window("ts", F.lit("2024-01-20").cast("date"), days_back=7, length=3)).select("event_id", "ts")


@register("t9_run_clock", sql="""
SELECT o_orderkey AS id, true AS stamped, true AS one_clock FROM orders UNION ALL SELECT s_suppkey, true, true FROM supplier
""")
def t9_run_clock(spark, sf):
    """Two tables loaded in one run: every row has the load time, after the query was built, and both tables the same."""
    built = F.lit(dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=1))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), X.run_clock().alias("loaded_ts"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), X.run_clock().alias("loaded_ts"))
    loaded = orders.unionByName(suppliers)
    first = loaded.select(F.min("loaded_ts")).scalar()
    return loaded.select("id", F.coalesce(F.col("loaded_ts") >= built, F.lit(False)).alias("stamped"), (F.col("loaded_ts") == first).alias("one_clock"))


# ------------------------------------------------------------------ strings


@register("x4_regex_extract", sql="""
SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages
""")
def x4_regex_extract(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.extract("url", r"^https?://([^/?#]+)").alias("host"))


COMMA_TEXT_SQL = ("CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || ',' || "
                  "lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || '.' || "
                  "lpad(CAST(CAST(round((o_totalprice - floor(o_totalprice)) * 100) AS BIGINT) AS VARCHAR), 2, '0')")


@register("x5_comma_number", sql=f"""
SELECT o_orderkey, {COMMA_TEXT_SQL} AS price_text,
       CAST(replace({COMMA_TEXT_SQL}, ',', '') AS DOUBLE) AS price
FROM orders
""")
def x5_comma_number(spark, sf):
    o = table(spark, sf, "orders")
    p = F.col("o_totalprice")
    txt = F.concat(F.floor(p / 1000).cast("string"), F.lit(","),
                   F.lpad((F.floor(p) % 1000).cast("string"), 3, "0"), F.lit("."),
                   F.lpad(F.round((p - F.floor(p)) * 100).cast("bigint").cast("string"), 2, "0"))
    return o.select("o_orderkey", txt.alias("price_text")).select(
        "o_orderkey", "price_text", X.comma_number("price_text").alias("price"))


@register("x6_percent_ratio", sql="""
SELECT l_orderkey, l_linenumber, CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) || '%' AS pct,
       CAST(CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) AS DOUBLE) * 0.01 AS ratio
FROM lineitem
""")
def x6_percent_ratio(spark, sf):
    li = table(spark, sf, "lineitem")
    pct = F.concat(F.round(F.col("l_discount") * 100).cast("bigint").cast("string"), F.lit("%"))
    return li.select("l_orderkey", "l_linenumber", pct.alias("pct")).select(
        "l_orderkey", "l_linenumber", "pct", X.percent_ratio("pct").alias("ratio"))


@register("x7_norm_title", sql="""
SELECT p_partkey, trim(lower('  ' || upper(p_name) || ' ')) AS title FROM part
""")
def x7_norm_title(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.norm_title(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))).alias("title"))


@register("x8_base_name", sql="""
SELECT page_id, string_split(url, '/')[-1] AS base,
       regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/', '') AS object_key
FROM pages
""")
def x8_base_name(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.base_name("url").alias("base"), X.key_without_bucket("url").alias("object_key"))


@register("x11_as_array", sql="""
SELECT p_partkey, CASE WHEN p_size > 25 THEN string_split(p_name, ' ') ELSE [p_type] END AS tags FROM part
""")
def x11_as_array(spark, sf):
    p = table(spark, sf, "part")
    txt = F.when(F.col("p_size") > 25, F.to_json(F.split("p_name", " "))).otherwise(F.col("p_type"))
    return p.select("p_partkey", X.as_string_array(txt).alias("tags"))


@register("x12_tt_id", sql="""
SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL WHEN p_size > 45 THEN 'No Results'
                       ELSE 'tt' || CAST(p_partkey AS VARCHAR) END AS title_id
FROM part
""")
def x12_tt_id(spark, sf):
    p = table(spark, sf, "part")
    raw = F.when(F.col("p_size") < 5, F.lit(None).cast("string")) \
        .when(F.col("p_size") > 45, F.lit(X.NO_RESULTS)).otherwise(F.col("p_partkey").cast("string"))
    return p.select("p_partkey", X.tt_id(raw).alias("title_id"))


@register("x13_shorten_title", sql="""
WITH t AS (SELECT p_partkey, p_name || ': ' || p_type || ' - ' || p_brand AS title FROM part),
s AS (SELECT p_partkey, title, string_split_regex(title, '[:-]') AS parts FROM t)
SELECT p_partkey, title,
       array_to_string(list_transform(list_slice(parts, 1, len(parts) - 1), lambda x: trim(x)), ': ') AS short_title
FROM s
""")
def x13_shorten_title(spark, sf):
    p = table(spark, sf, "part")
    t = F.concat_ws("", "p_name", F.lit(": "), "p_type", F.lit(" - "), "p_brand")
    return p.select("p_partkey", t.alias("title")).select("p_partkey", "title",
                                                          X.shorten_title("title").alias("short_title"))


# --------------------------------------------------------------- predicates


@register("f4_non_blank", sql="""
WITH t AS (SELECT p_partkey, CASE WHEN p_size < 3 THEN '   ' WHEN p_size > 48 THEN NULL ELSE p_name END AS title FROM part)
SELECT p_partkey, title FROM t WHERE title IS NOT NULL AND length(trim(title)) > 0
""")
def f4_non_blank(spark, sf):
    p = table(spark, sf, "part")
    t = F.when(F.col("p_size") < 3, F.lit("   ")).when(F.col("p_size") > 48, F.lit(None).cast("string")) \
        .otherwise(F.col("p_name"))
    return p.select("p_partkey", t.alias("title")).where(non_blank("title"))


@register("f5_flag_true", sql="SELECT doc_id, toxic FROM labels WHERE quality = 1")
def f5_flag_true(spark, sf):
    return table(spark, sf, "labels").where(flag_true("quality")).select("doc_id", "toxic")


@register("f6_all_given", sql="""
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000
""")
def f6_all_given(spark, sf):
    c = table(spark, sf, "customer")
    segment, nation, min_balance = "BUILDING", None, 1000
    cond = all_given(
        F.col("c_mktsegment") == segment if segment else None,
        F.col("c_nationkey") == nation if nation is not None else None,
        F.col("c_acctbal") > min_balance if min_balance is not None else None,
    )
    return c.where(cond).select("c_custkey", "c_name")


@register("f7_candidate_filter", sql="""
WITH p AS (SELECT *, CASE WHEN p_size > 40 THEN NULL ELSE 1990 + p_size // 10 END AS wanted_year,
                      1990 + p_size // 12 AS cand_year FROM part)
SELECT p_partkey, p_type, wanted_year, cand_year FROM p
WHERE p_type IN ('ECONOMY', 'PROMO', 'SMALL') AND (wanted_year IS NULL OR wanted_year = cand_year)
  AND (p_retailprice > 950 OR (p_type = 'SMALL' AND p_retailprice > 920))
""")
def f7_candidate_filter(spark, sf):
    p = table(spark, sf, "part")
    p = p.select("p_partkey", "p_type", "p_retailprice",
                 F.when(F.col("p_size") > 40, F.lit(None)).otherwise(1990 + F.floor(F.col("p_size") / 10))
                 .cast("int").alias("wanted_year"),
                 (1990 + F.floor(F.col("p_size") / 12)).cast("int").alias("cand_year"))
    kinds = F.array(*[F.lit(k) for k in ("ECONOMY", "PROMO", "SMALL")])
    cond = year_matches("wanted_year", "cand_year") & candidate_qualifies(
        "p_type", "p_retailprice", kinds, min_votes=950, low_votes=920, low_votes_kind="SMALL")
    return p.where(cond).select("p_partkey", "p_type", "wanted_year", "cand_year")


@register("p11_blank_nulls", sql="""
SELECT n_nationkey, coalesce(nullif(n_name, 'CHINA'), '') AS n_name, n_regionkey FROM nation
""")
def p11_blank_nulls(spark, sf):
    n = table(spark, sf, "nation")
    n = n.select("n_nationkey", F.when(F.col("n_name") != "CHINA", F.col("n_name")).alias("n_name"), "n_regionkey")
    return blank_nulls(n)
