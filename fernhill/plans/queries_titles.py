"""Queries for title matching (C20–C22, M1–M6, J2–J5, W2, X14) and the set
operators it uses (A3–A5, L1, U1, J3/K5 upsert)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import display_title, norm_title
from ..functions.predicates import candidate_qualifies
from ..functions.titles import ITEM_ITEMSET_PATTERN, ITEMSET_ONLY_PATTERN, YEAR_PATTERN, parse_titles
from ..operators.joins import left_anti, not_in
from ..operators.resolve import (
    SECOND_CHAIN, record_matches, resolve_titles, search_attempts, titles_to_match, with_episode,
)
from ..operators.sets import count_ids, distinct_values, non_null_distinct, stack
from ..operators.snapshots import first_qualifying
from ..operators.upsert import upsert
from .derive import match_table, raw_title, title_candidates, title_map
from .registry import register, table

# ------------------------------------------------------------- DuckDB pieces

BNO = "CAST(CAST(substring(p_brand, 7) AS INTEGER) AS VARCHAR)"
RAW_SQL = f"""CASE p_type
  WHEN 'ECONOMY' THEN p_name || ' S' || lpad(CAST(p_size AS VARCHAR), 2, '0') || 'E' || lpad({BNO}, 2, '0') || ' - ' || p_type || ': ' || p_brand
  WHEN 'SMALL' THEN p_name || ' itemset ' || CAST(p_size AS VARCHAR) || ' item ' || {BNO}
  WHEN 'MEDIUM' THEN p_name || ' (' || CAST(1880 + p_size * 3 AS VARCHAR) || ')'
  WHEN 'LARGE' THEN p_name || ' itemset ' || CAST(p_size AS VARCHAR)
  WHEN 'PROMO' THEN replace(p_name, ' ', '_') || '_S' || CAST(p_size AS VARCHAR) || '_E' || {BNO} || '_Part_' || CAST(p_size AS VARCHAR)
  ELSE upper(p_name) || ' [' || CAST(1950 + p_size AS VARCHAR) || ']' END"""

M2, M3, YR = ITEM_ITEMSET_PATTERN, ITEMSET_ONLY_PATTERN, YEAR_PATTERN


def parse_sql(src: str) -> str:
    """CTEs p0..parsed over ``src`` (column ``title``): the M1–M3 rules in SQL."""
    return f"""
p0 AS (SELECT title, replace(title, '_', ' ') AS s0 FROM {src}),
p1 AS (SELECT *, TRY_CAST(substring(regexp_extract(s0, '{YR}', 1), 2, 4) AS INTEGER) AS yn FROM p0),
p2 AS (SELECT *, CASE WHEN yn BETWEEN 1900 AND year(current_date) THEN yn END AS year,
              CASE WHEN yn BETWEEN 1900 AND year(current_date) THEN regexp_replace(s0, '{YR}', '', 'g') ELSE s0 END AS s1
       FROM p1),
p3 AS (SELECT *, regexp_matches(s1, '{M2}') AS m2, regexp_matches(s1, '{M3}') AS m3 FROM p2),
parsed AS (
  SELECT title, year,
    CASE WHEN m2 THEN TRY_CAST(regexp_extract(s1, '{M2}', 1) AS INTEGER)
         WHEN m3 THEN TRY_CAST(regexp_extract(s1, '{M3}', 1) AS INTEGER) END AS itemset,
    CASE WHEN m2 THEN TRY_CAST(regexp_extract(s1, '{M2}', 2) AS INTEGER) END AS item,
    CASE WHEN m2 AND length(regexp_extract(s1, '{M2}', 3)) > 1
         THEN nullif(trim(substring(regexp_extract(s1, '{M2}', 3), 2)), '') END AS item_title,
    trim(CASE WHEN m2 THEN regexp_replace(s1, '{M2}', '', 'g')
              WHEN m3 THEN regexp_replace(s1, '{M3}', '', 'g') ELSE s1 END) AS ptitle
  FROM p3)"""


CAND_SQL = f"""
cand AS (
  SELECT p_name AS query, min(p_partkey) * 2 AS position, 'ser-' || replace(p_name, ' ', '-') AS id,
         'series' AS kind, CAST(1950 + min(p_size) AS INTEGER) AS year, CAST(max(p_size) * 5 AS INTEGER) AS votes,
         CAST(NULL AS VARCHAR) AS parent_id, CAST(NULL AS INTEGER) AS itemset_no, CAST(NULL AS INTEGER) AS item_no
  FROM part GROUP BY p_name
  UNION ALL
  SELECT p_name, p_partkey * 2 + 1, CAST(p_partkey AS VARCHAR),
         CASE WHEN p_size <= 30 THEN 'episode' ELSE 'movie' END, CAST(1950 + p_size AS INTEGER),
         CAST(CAST(floor(p_retailprice) AS INTEGER) - 900 + p_size * 4 AS INTEGER),
         CASE WHEN p_size <= 30 THEN 'ser-' || replace(p_name, ' ', '-') END,
         CASE WHEN p_size <= 30 THEN p_size END,
         CASE WHEN p_size <= 30 THEN CAST(substring(p_brand, 7) AS INTEGER) END
  FROM part
)"""

MAP_SQL = f"""
tmap AS (
  SELECT CASE WHEN p_size = 1 THEN '  ' ELSE {RAW_SQL} END AS title,
         CASE WHEN p_size > 44 THEN 'tt' || CAST(p_partkey AS VARCHAR) END AS title_id,
         CASE WHEN p_size > 47 THEN 'tt' || CAST(p_partkey AS VARCHAR) END AS itemset_id
  FROM part
),
matches AS (
  SELECT title, min(tid) AS title_id, CAST(NULL AS VARCHAR) AS itemset_id, max(p_size) > 25 AS has_match,
         TIMESTAMP '2024-01-01 00:00:00' AS match_ts
  FROM (SELECT trim(lower({RAW_SQL})) AS title, 'tt' || CAST(p_partkey AS VARCHAR) AS tid, p_size
        FROM part WHERE p_type = 'LARGE')
  GROUP BY title
),
worklist AS (
  SELECT DISTINCT trim(lower(title)) AS title FROM tmap
  WHERE title_id IS NULL AND itemset_id IS NULL AND title IS NOT NULL AND length(trim(title)) > 0
    AND trim(lower(title)) NOT IN (SELECT title FROM matches WHERE has_match)
)"""


def attempts_sql(src: str = "parsed") -> str:
    """CTEs a0, chains: the ordered search attempts of every parsed title."""
    split = "string_split_regex({b}, '[:-]')"

    def chain(base: str, start: int, cond: str) -> str:
        parts = split.format(b=base)
        return f"""
  SELECT title, {start} + CAST(j AS BIGINT) AS rank,
         array_to_string(list_transform({parts}[1:len({parts}) - j], lambda x: trim(x)), ': ') AS q, true AS is_tv
  FROM (SELECT *, unnest(range(1, len({parts}))) AS j FROM a0 WHERE {cond} AND regexp_matches({base}, '[:-]'))"""

    return f"""
a0 AS (
  SELECT title, year, itemset, item, ptitle, item_title IS NOT NULL AS has_rest,
         coalesce(itemset > 0 AND item > 0, false) AS tv,
         CASE WHEN item_title IS NOT NULL THEN ptitle || ' ' || item_title ELSE ptitle END AS prim
  FROM {src} WHERE title IS NOT NULL
),
chains AS (
  SELECT title, CAST(0 AS BIGINT) AS rank, prim AS q, CASE WHEN has_rest THEN true ELSE tv END AS is_tv FROM a0
  UNION ALL {chain('prim', 0, 'true')}
  UNION ALL SELECT title, {SECOND_CHAIN}, ptitle, true FROM a0 WHERE has_rest
  UNION ALL {chain('ptitle', SECOND_CHAIN, 'has_rest')}
)"""


HIT_SQL = """
cn AS (SELECT *, trim(lower(query)) AS qn FROM cand),
firsts AS (SELECT DISTINCT qn FROM cn),
hit AS (
  SELECT title, qn, is_tv, rank FROM (
    SELECT c.title, f.qn, c.is_tv, c.rank, row_number() OVER (PARTITION BY c.title ORDER BY c.rank) AS rn
    FROM chains c JOIN firsts f ON trim(lower(c.q)) = f.qn)
  WHERE rn = 1
)"""

CHOSEN_SQL = """
ranked AS (
  SELECT h.title, cn.id, cn.kind, cn.parent_id,
         row_number() OVER (PARTITION BY h.title ORDER BY
           CASE WHEN (a.year IS NULL OR a.year = 0 OR cn.year = a.year)
                 AND list_contains(CASE WHEN h.is_tv THEN ['series', 'episode'] ELSE ['movie', 'series'] END, cn.kind)
                 AND (coalesce(cn.votes, 0) > 200 OR (cn.kind = 'movie' AND coalesce(cn.votes, 0) > 50))
                THEN 0 ELSE 1 END, cn.position) AS rn
  FROM hit h JOIN a0 a ON a.title = h.title JOIN cn ON cn.qn = h.qn
),
chosen AS (SELECT * FROM ranked WHERE rn = 1),
eps AS (SELECT parent_id, itemset_no, item_no, min(id) AS episode_id FROM cand
        WHERE parent_id IS NOT NULL GROUP BY parent_id, itemset_no, item_no)"""


def resolved_sql(src: str) -> str:
    """CTEs up to ``resolved`` (title, title_id, itemset_id) for the titles in ``src``."""
    return f"""{parse_sql(src)},
{CAND_SQL},
{attempts_sql()},
{HIT_SQL},
{CHOSEN_SQL},
resolved AS (
  SELECT p.title,
    CASE WHEN p.title IS NULL THEN NULL WHEN ch.id IS NULL THEN 'No Results'
         WHEN ch.kind = 'series' AND coalesce(p.itemset > 0 AND p.item > 0, false) THEN 'tt' || e.episode_id
         WHEN ch.kind = 'series' THEN NULL ELSE 'tt' || ch.id END AS title_id,
    CASE WHEN p.title IS NULL THEN NULL WHEN ch.id IS NULL THEN 'No Results'
         WHEN ch.kind = 'series' THEN 'tt' || ch.id WHEN ch.kind = 'episode' THEN 'tt' || ch.parent_id
         ELSE NULL END AS itemset_id
  FROM parsed p LEFT JOIN chosen ch ON ch.title = p.title
  LEFT JOIN eps e ON ch.kind = 'series' AND e.parent_id = ch.id AND e.itemset_no = p.itemset AND e.item_no = p.item
)"""


RAW_TITLES_CTE = f"raw_titles AS (SELECT DISTINCT {RAW_SQL} AS title FROM part)"


def _part(spark, sf):
    return table(spark, sf, "part")


def _raw_titles(spark, sf):
    p = _part(spark, sf)
    return p.select(raw_title(p).alias("title")).distinct()


def _parsed(spark, sf):
    return parse_titles(_raw_titles(spark, sf), "title", "p")


# ------------------------------------------------------------------- parsing

@register("m1_parse_year", sql=f"""
WITH {RAW_TITLES_CTE}, {parse_sql('raw_titles')}
SELECT title, year, ptitle FROM parsed
""")
def m1_parse_year(spark, sf):
    return _parsed(spark, sf).select("title", F.col("p.year").alias("year"), F.col("p.title").alias("ptitle"))


@register("m2_parse_itemset_item", sql=f"""
WITH {RAW_TITLES_CTE}, {parse_sql('raw_titles')}
SELECT title, ptitle, itemset, item, item_title FROM parsed WHERE item IS NOT NULL
""")
def m2_parse_itemset_item(spark, sf):
    return (_parsed(spark, sf).where(F.col("p.item").isNotNull())
            .select("title", F.col("p.title").alias("ptitle"), F.col("p.itemset").alias("itemset"),
                    F.col("p.item").alias("item"), F.col("p.item_title").alias("item_title")))


@register("m3_parse_itemset_only", sql=f"""
WITH {RAW_TITLES_CTE}, {parse_sql('raw_titles')}
SELECT title, ptitle, itemset FROM parsed WHERE item IS NULL AND itemset IS NOT NULL
""")
def m3_parse_itemset_only(spark, sf):
    return (_parsed(spark, sf).where(F.col("p.item").isNull() & F.col("p.itemset").isNotNull())
            .select("title", F.col("p.title").alias("ptitle"), F.col("p.itemset").alias("itemset")))


@register("x14_display_title", sql=f"""
WITH {RAW_TITLES_CTE}, {parse_sql('raw_titles')}
SELECT title,
  '"' || ptitle || '"' || CASE WHEN item_title IS NOT NULL AND item_title <> '' THEN ' ' || item_title ELSE '' END ||
  CASE WHEN coalesce(year, 0) <> 0 OR coalesce(itemset, 0) <> 0 OR coalesce(item, 0) <> 0 THEN
    ', ' || CASE WHEN coalesce(itemset, 0) <> 0 THEN 'itemset ' || CAST(itemset AS VARCHAR) ELSE '' END
         || CASE WHEN coalesce(item, 0) <> 0 THEN ' item ' || CAST(item AS VARCHAR) ELSE '' END
         || CASE WHEN coalesce(year, 0) <> 0 THEN ' (' || CAST(year AS VARCHAR) || ')' ELSE '' END
  ELSE '' END AS display
FROM parsed
""")
def x14_display_title(spark, sf):
    p = _parsed(spark, sf)
    return p.select("title", display_title("p.title", "p.year", "p.itemset", "p.item", "p.item_title").alias("display"))


# ---------------------------------------------------------------- resolution

def _worklist(spark, sf):
    p = _part(spark, sf)
    return titles_to_match(title_map(p), match_table(p))


@register("c20_titles_to_match", sql=f"WITH {MAP_SQL} SELECT title FROM worklist")
def c20_titles_to_match(spark, sf):
    return _worklist(spark, sf)


@register("l1_take", sql=f"WITH {MAP_SQL} SELECT title FROM worklist ORDER BY title LIMIT 50")
def l1_take(spark, sf):
    """L1: the hourly batch of 50 titles (a limit is the feature here), in title order."""
    p = _part(spark, sf)
    return titles_to_match(title_map(p), match_table(p), limit=50)


@register("j4_title_lookup", sql=f"""
WITH {RAW_TITLES_CTE}, {parse_sql('raw_titles')}, {CAND_SQL}, {attempts_sql()}, {HIT_SQL}
SELECT title, qn AS query, rank FROM hit
""")
def j4_title_lookup(spark, sf):
    """Which search (main, shortened, bare title) first finds candidates, per title."""
    return _first_hits(parse_titles(_raw_titles(spark, sf), "title", "parsed"), _part(spark, sf))


def _first_hits(parsed, part):
    """(title, query, rank) of the first search with candidates, for titles that are parsed already."""
    cand = title_candidates(part).select(norm_title("query").alias("qn")).distinct()
    hits = search_attempts(parsed, key="title").join(cand, "qn")
    return (hits.groupBy("title").agg(F.min(F.struct("rank", "qn")).alias("w"))
            .select("title", F.col("w.qn").alias("query"), F.col("w.rank").alias("rank")))


@register("m6_rest_title_search", sql=f"""
WITH {RAW_TITLES_CTE}, {parse_sql('raw_titles')}, {CAND_SQL}, {attempts_sql()}, {HIT_SQL}
SELECT h.title, h.qn AS query, h.rank >= {SECOND_CHAIN} AS bare_title_used
FROM hit h JOIN a0 ON a0.title = h.title WHERE a0.has_rest
""")
def m6_rest_title_search(spark, sf):
    """M6: titles with a rest-title: did the "title rest" search or the bare title find candidates?"""
    # titles are parsed once; only those with a rest-title go on to the search
    parsed = parse_titles(_raw_titles(spark, sf), "title", "parsed").where(F.col("parsed.item_title").isNotNull())
    return _first_hits(parsed, _part(spark, sf)).select("title", "query", (F.col("rank") >= SECOND_CHAIN).alias("bare_title_used"))


@register("m5_ids_by_kind", sql=f"""
WITH {RAW_TITLES_CTE}, {resolved_sql('raw_titles')}
SELECT title, title_id, itemset_id FROM resolved
""")
def m5_ids_by_kind(spark, sf):
    """M5 (with M4, M6, J4, J5): ids for every raw partner title."""
    return resolve_titles(_raw_titles(spark, sf), title_candidates(_part(spark, sf)))


@register("c21_resolve_titles", sql=f"""
WITH {MAP_SQL}, {resolved_sql('worklist')}
SELECT title, title_id, itemset_id FROM resolved
""")
def c21_resolve_titles(spark, sf):
    return resolve_titles(_worklist(spark, sf), title_candidates(_part(spark, sf)), assume_distinct=True)


RECORD_MATCHES_SQL = f"""
WITH {MAP_SQL}, {resolved_sql('worklist')},
src AS (SELECT DISTINCT trim(lower(title)) AS title, title_id, itemset_id FROM resolved)
SELECT coalesce(m.title, s.title) AS title,
       CASE WHEN s.title IS NOT NULL THEN s.title_id ELSE m.title_id END AS title_id,
       CASE WHEN s.title IS NOT NULL THEN s.itemset_id ELSE m.itemset_id END AS itemset_id,
       CASE WHEN s.title IS NOT NULL THEN true ELSE m.has_match END AS has_match
FROM matches m FULL OUTER JOIN src s ON m.title = s.title
"""


def _match_rows(spark, sf):
    """The match table and the titles found for it."""
    return match_table(_part(spark, sf)), c21_resolve_titles(spark, sf)


@register("c22_record_matches", sql=RECORD_MATCHES_SQL)
def c22_record_matches(spark, sf):
    return record_matches(*_match_rows(spark, sf)).drop("match_ts")


@register("m4_candidate_choice", sql=f"""
WITH {CAND_SQL},
ranked AS (
  SELECT trim(lower(query)) AS query, id, kind,
         row_number() OVER (PARTITION BY trim(lower(query)) ORDER BY
           CASE WHEN kind IN ('movie', 'series') AND (coalesce(votes, 0) > 200 OR (kind = 'movie' AND coalesce(votes, 0) > 50))
                THEN 0 ELSE 1 END, position) AS rn
  FROM cand)
SELECT query, id, kind FROM ranked WHERE rn = 1
""")
def m4_candidate_choice(spark, sf):
    """M4: per search query, the candidate a non-series search without a year would take."""
    c = title_candidates(_part(spark, sf)).withColumn("query", norm_title("query"))
    q = candidate_qualifies("kind", "votes", F.array(F.lit("movie"), F.lit("series")))
    return first_qualifying(c, "query", "position", q).select("query", "id", "kind")


@register("w2_first_qualifying", sql="""
SELECT p_name, p_partkey FROM (
  SELECT p_name, p_partkey, row_number() OVER (PARTITION BY p_name ORDER BY
         CASE WHEN p_retailprice > 990 THEN 0 ELSE 1 END, p_partkey) AS rn FROM part)
WHERE rn = 1
""")
def w2_first_qualifying(spark, sf):
    p = _part(spark, sf)
    return first_qualifying(p, "p_name", "p_partkey", F.col("p_retailprice") > 990).select("p_name", "p_partkey")


@register("j5_parent_lookup", sql=f"""
WITH {CAND_SQL},
wanted AS (SELECT position, parent_id, itemset_no, item_no + CASE WHEN position % 5 = 0 THEN 1 ELSE 0 END AS item_no FROM cand),
e AS (SELECT parent_id, itemset_no, item_no, min(id) AS episode_id FROM cand WHERE parent_id IS NOT NULL GROUP BY ALL)
SELECT w.position, w.parent_id, e.episode_id FROM wanted w
LEFT JOIN e ON w.parent_id = e.parent_id AND w.itemset_no = e.itemset_no AND w.item_no = e.item_no
""")
def j5_parent_lookup(spark, sf):
    """Episode under a parent by its numbers; some numbers are off, series and movies look nothing up."""
    cand = title_candidates(_part(spark, sf))
    wanted = cand.select("position", "parent_id", "itemset_no",
                         (F.col("item_no") + F.when(F.col("position") % 5 == 0, 1).otherwise(0)).alias("item_no"))
    return with_episode(wanted, cand, "parent_id", "itemset_no", "item_no",
                        spread_by="position").select("position", "parent_id", "episode_id")


# -------------------------------------------------------------- anti joins

@register("j2_not_in", sql="""
SELECT p_partkey, p_name FROM part
WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size > 45)
""")
def j2_not_in(spark, sf):
    p = _part(spark, sf)
    return not_in(p.select("p_partkey", "p_name"), p.where(F.col("p_size") > 45), "p_name")


@register("j2_not_in_with_null", sql="""
SELECT p_partkey, p_name FROM part
WHERE p_name NOT IN (SELECT CASE WHEN p_size = 50 THEN NULL ELSE p_name END FROM part WHERE p_size > 45)
""")
def j2_not_in_with_null(spark, sf):
    """NOT IN with a null in the subquery: empty whenever the subquery holds a null."""
    p = _part(spark, sf)
    sub = p.where(F.col("p_size") > 45).select(
        F.when(F.col("p_size") == 50, F.lit(None)).otherwise(F.col("p_name")).alias("p_name"))
    return not_in(p.select("p_partkey", "p_name"), sub, "p_name")


@register("j2_left_anti", sql="""
SELECT p_partkey, p_name FROM part p
WHERE NOT EXISTS (SELECT 1 FROM part q WHERE q.p_size > 45 AND q.p_size < 50 AND q.p_name = p.p_name)
""")
def j2_left_anti(spark, sf):
    p = _part(spark, sf)
    sub = p.where((F.col("p_size") > 45) & (F.col("p_size") < 50))
    return left_anti(p.select("p_partkey", "p_name"), sub, "p_name")


# --------------------------------------------------------- sets and upsert

@register("a3_distinct", sql="SELECT DISTINCT p_name FROM part")
def a3_distinct(spark, sf):
    return distinct_values(_part(spark, sf), "p_name")


@register("a4_distinct_tuple", sql="SELECT DISTINCT p_name, p_brand, p_type FROM part")
def a4_distinct_tuple(spark, sf):
    return distinct_values(_part(spark, sf), "p_name", "p_brand", "p_type")


@register("a5_unique_ids", sql="SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL")
def a5_unique_ids(spark, sf):
    return non_null_distinct(table(spark, sf, "orders"), "o_custkey")


@register("a5_count_ids", sql="SELECT count(DISTINCT o_custkey) AS n_ids FROM orders")
def a5_count_ids(spark, sf):
    return count_ids(table(spark, sf, "orders"), "o_custkey")


@register("u1_stack", sql="""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance_s
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier
""")
def u1_stack(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                            F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                            F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance_s"))
    return stack(c, s)


UPSERT_SQL = """
WITH src AS (
  SELECT s_suppkey, s_name || ' (new)' AS s_name, s_nationkey, s_acctbal + 1 AS s_acctbal
  FROM supplier WHERE s_nationkey < 12
  UNION ALL
  SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_nationkey >= 20
)
SELECT coalesce(t.s_suppkey, s.s_suppkey) AS s_suppkey,
       CASE WHEN s.s_suppkey IS NOT NULL THEN s.s_name ELSE t.s_name END AS s_name,
       CASE WHEN s.s_suppkey IS NOT NULL THEN s.s_nationkey ELSE t.s_nationkey END AS s_nationkey,
       CASE WHEN s.s_suppkey IS NOT NULL THEN s.s_acctbal ELSE t.s_acctbal END AS s_acctbal
FROM supplier t FULL OUTER JOIN src s ON t.s_suppkey = s.s_suppkey
"""


def _upsert_source(spark, sf):
    s = table(spark, sf, "supplier")
    changed = s.where(F.col("s_nationkey") < 12).select(
        "s_suppkey", F.concat("s_name", F.lit(" (new)")).alias("s_name"), "s_nationkey",
        (F.col("s_acctbal") + 1).alias("s_acctbal"))
    new = s.where(F.col("s_nationkey") >= 20).select(
        (F.col("s_suppkey") + 1000000000).alias("s_suppkey"), "s_name", "s_nationkey", "s_acctbal")
    return changed.unionByName(new)


@register("k5_upsert", sql=UPSERT_SQL)
def k5_upsert(spark, sf):
    return upsert(table(spark, sf, "supplier"), _upsert_source(spark, sf), "s_suppkey")


@register("j3_merge_update_insert", sql=f"""
SELECT s_suppkey, s_name FROM ({UPSERT_SQL.replace('WITH src AS', 'WITH src AS', 1)})
WHERE s_name LIKE '%(new)' OR s_suppkey >= 1000000000
""")
def j3_merge_update_insert(spark, sf):
    """The update and insert branches of the merge (changed and new rows)."""
    out = upsert(table(spark, sf, "supplier"), _upsert_source(spark, sf), "s_suppkey")
    return out.where(F.col("s_name").endswith("(new)") | (F.col("s_suppkey") >= 1000000000)).select("s_suppkey", "s_name")
