"""Title matching: worklist (C20), resolution against a catalogue (C21, M4–M6,
J4, J5) and the match upsert (C22).

The source resolved titles one at a time against a web search. Here the
"search" is a candidates table (query, position, id, kind, year, votes,
parent_id, itemset_no, item_no) and resolution is a handful of joins and
aggregations over all titles at once:

1. every title is parsed (M1–M3) and turned into its ordered list of search
   attempts -- the main query, each shortened form (X13), then for titles
   with a rest-title the bare title and its shortened forms (M6);
2. the first attempt that has any candidate wins (J4);
3. among that query's candidates the first in position order that qualifies
   (kind, year, votes: M4) is chosen, else the first of all (W2);
4. ids follow from the chosen kind (J5, M5) and get the "tt" form (X12).

Candidates are pre-aggregated per (query) and per (query, kind, year) before
any join, so a query with millions of candidates sends one row per map task
for each of its (kind, year) groups; titles are de-duplicated first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import NO_RESULTS, norm_title, tt_id
from ..functions.predicates import candidate_qualifies, non_blank, year_matches
from ..functions.titles import parse_titles
from ..sinks.bucketed import Manifest, read_bucketed, upsert_bucketed
from .joins import not_in
from .sets import take
from .upsert import upsert

# own kind names (the source's were scrubbed): a series has episodes, a movie stands alone
TV_KINDS = ("series", "episode")
OTHER_KINDS = ("movie", "series")

CANDIDATE_FIELDS = ("position", "id", "kind", "year", "parent_id")


def titles_to_match(title_map: DataFrame, matches: DataFrame, limit: int | None = None,
                    title_col: str = "title") -> DataFrame:
    """C20: normalised titles still without ids that were never matched.

    ``title_map`` has (title, title_id, itemset_id); ``matches`` has (title,
    has_match). ``NOT IN`` is null-aware, as in SQL: one null title among the
    matched rows empties the worklist. With ``limit`` the first titles in
    order are taken (the source took any ``limit`` titles).
    """
    todo = (title_map
            .where(F.col("title_id").isNull() & F.col("itemset_id").isNull() & non_blank(title_col))
            .select(norm_title(title_col).alias("title")).distinct())
    done = matches.where(F.col("has_match") == F.lit(True)).select("title")
    out = not_in(todo, done, "title")
    if limit is not None:
        out = take(out, limit, ["title"])
    return out


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


_SEP = "\u0001"
# ranks of the bare title's searches start here: a text has fewer characters, so
# no chain of shortenings reaches it
SECOND_CHAIN = 1 << 31


def _shortened(base: Column, keep_parts: Column) -> Column:
    """X13 applied repeatedly: the first ``keep_parts`` parts of ``base`` (split on
    ':' or '-'), each trimmed, joined with ': '. Built-ins only (no lambdas)."""
    marked = F.regexp_replace(base, "[:-]", _SEP)
    prefix = F.call_function("substring_index", marked, F.lit(_SEP), keep_parts)
    return _strip(F.regexp_replace(prefix, r"(?U)\s*" + _SEP + r"\s*", ": "))


def search_attempts(parsed: DataFrame, key: str = "tid", keep: Sequence[str] = ()) -> DataFrame:
    """(key, rank, qn, is_tv, *keep) for every search a title would make, in order:
    the main query (title + rest-title, or the title), then each shorter form
    while ':' / '-' remain; for titles with a rest-title, then the bare title and
    its shorter forms (ranks from ``SECOND_CHAIN``). A null title keeps one row with a null
    query (``explode_outer``), so every title reaches the aggregation that follows.
    """
    p = F.col("parsed")
    rest = p["item_title"]
    bare = _strip(p["title"])
    has_rest = rest.isNotNull() & (rest != "")
    tv = F.coalesce((p["itemset"] > 0) & (p["item"] > 0), F.lit(False))
    primary = F.when(has_rest, F.concat(bare, F.lit(" "), _strip(rest))).otherwise(bare)
    chains = F.when(has_rest, F.array(
        F.struct(F.lit(0).cast("bigint").alias("start"), primary.alias("base"), F.lit(True).alias("is_tv")),
        F.struct(F.lit(SECOND_CHAIN).cast("bigint").alias("start"), bare.alias("base"), F.lit(True).alias("is_tv")))) \
        .otherwise(F.array(F.struct(F.lit(0).cast("bigint").alias("start"), primary.alias("base"), tv.alias("is_tv"))))
    chains = F.when(p.isNull(), F.lit(None)).otherwise(chains)
    c = parsed.select(key, *keep, F.explode_outer(chains).alias("c")).select(
        key, *keep, F.col("c.start").alias("start"), F.col("c.base").alias("base"), F.col("c.is_tv").alias("tv0"))
    base = F.col("base")
    n_sep = F.length(base) - F.length(F.regexp_replace(base, "[:-]", ""))
    steps = c.select(key, *keep, "start", "base", "tv0",
                     F.explode_outer(F.sequence(F.lit(0), F.coalesce(n_sep, F.lit(0)))).alias("j"))
    j = F.col("j")
    q = F.when(j == 0, base).otherwise(_shortened(base, n_sep + 1 - j))
    return steps.select(key, (F.col("start") + j).alias("rank"), norm_title(q).alias("qn"),
                        F.when(j == 0, F.col("tv0")).otherwise(F.lit(True)).alias("is_tv"), *keep)


def _cand_struct() -> Column:
    return F.struct(*[F.col(c) for c in CANDIDATE_FIELDS])


def with_episode(df: DataFrame, candidates: DataFrame, parent: str, itemset: str, item: str,
                 spread_by: str, where: Column | None = None) -> DataFrame:
    """Add ``episode_id``, the smallest candidate id under the row's parent with
    its numbers; null where there is none or ``where`` does not hold.

    Rows that look nothing up ("No Results" and un-numbered titles may be most of
    a table) take ``spread_by`` for their join key: it is no parent's id under
    the condition, and spreads them over all tasks where nulls would fill one.
    """
    episodes = (candidates.where(F.col("parent_id").isNotNull())
                .groupBy("parent_id", "itemset_no", "item_no")
                .agg(F.min("id").alias("episode_id"))
                .select(F.col("parent_id").alias("_p"), F.col("itemset_no").alias("_s"), F.col("item_no").alias("_i"),
                        "episode_id"))
    known = F.col(parent).isNotNull() & F.col(itemset).isNotNull() & F.col(item).isNotNull()
    looks = F.coalesce(known if where is None else known & where, F.lit(False))
    rows = df.withColumn("_looks", looks).withColumn(
        "_key", F.when(F.col("_looks"), F.col(parent)).otherwise(F.col(spread_by).cast("string")))
    return (rows.join(episodes, F.col("_looks") & (F.col("_key") == F.col("_p")) & (F.col(itemset) == F.col("_s"))
                      & (F.col(item) == F.col("_i")), "left")
            .drop("_looks", "_key", "_p", "_s", "_i"))


def resolve_titles(titles: DataFrame, candidates: DataFrame, title_col: str = "title",
                   min_votes: int = 200, low_votes: int = 50, low_votes_kind: str = "movie",
                   tv_kinds: Sequence[str] = TV_KINDS, other_kinds: Sequence[str] = OTHER_KINDS,
                   assume_distinct: bool = False) -> DataFrame:
    """(title, title_id, itemset_id) for every distinct title.

    ``assume_distinct``: the titles are already distinct (e.g. the C20
    worklist), so the de-duplicating shuffle is skipped.

    No candidate in any attempt -> both ids "No Results"; a null title -> both null.
    Plan: titles are parsed once and exploded into attempts; candidates are read
    once and pre-aggregated, per (query, kind, year) and then per query, to the
    first candidate of all and the first with enough votes of each kind and year
    (a list no longer than kinds times years); one join on the query, one
    aggregation per title and the episode lookup follow.
    """
    uniq = titles.select(F.col(title_col).alias("title"))
    if not assume_distinct:
        uniq = uniq.distinct()
    parsed = parse_titles(uniq, "title", "parsed")
    fields = ["year", "itemset", "item"]
    attempts = search_attempts(
        parsed.select("title", "parsed", *[F.col(f"parsed.{f}").alias(f) for f in fields],
                      F.col("parsed").isNull().alias("null_title")),
        key="title", keep=fields + ["null_title"])

    cand = candidates.withColumn("qn", norm_title("query"))
    usable = F.array(*[F.lit(k) for k in dict.fromkeys([*tv_kinds, *other_kinds])])
    passes = candidate_qualifies("kind", "votes", usable, min_votes, low_votes, low_votes_kind)
    per_query = (cand.groupBy("qn", "kind", "year")
                 .agg(F.min(_cand_struct()).alias("first"), F.min(F.when(passes, _cand_struct())).alias("best"))
                 .groupBy("qn").agg(F.min("first").alias("first"), F.collect_list("best").alias("bests")))

    # First attempt (in order) with any candidate; titles without one keep a row with no hit
    hit = (attempts.join(per_query, "qn", "left")
           .groupBy("title")
           .agg(F.min_by(F.struct("is_tv", *fields, "null_title", "first", "bests"),
                         F.struct(F.col("first").isNull().alias("miss"), "rank")).alias("w"))
           .select("title", "w.*"))

    # First qualifying candidate of the winning query
    allowed = F.when(F.col("is_tv"), F.array(*[F.lit(k) for k in tv_kinds])) \
        .otherwise(F.array(*[F.lit(k) for k in other_kinds]))
    fits = F.filter("bests", lambda b: F.array_contains(allowed, b["kind"]) & year_matches(F.col("year"), b["year"]))
    chosen = hit.select("title", "itemset", "item", "null_title",
                        F.coalesce(F.array_min(fits), F.col("first")).alias("c"))

    # Ids by kind; a series with itemset and item numbers looks up its episode
    numbered = F.coalesce((F.col("itemset") > 0) & (F.col("item") > 0), F.lit(False))
    r = with_episode(chosen, candidates, "c.id", "itemset", "item", spread_by="title",
                     where=(F.col("c.kind") == "series") & numbered)
    kind = F.col("c.kind")
    none = F.col("c").isNull()
    item_id = (F.when(F.col("null_title"), F.lit(None))
               .when(none, F.lit(NO_RESULTS))
               .when((kind == "series") & numbered, F.col("episode_id"))
               .when(kind == "series", F.lit(None))
               .otherwise(F.col("c.id")))
    itemset_id = (F.when(F.col("null_title"), F.lit(None))
                  .when(none, F.lit(NO_RESULTS))
                  .when(kind == "series", F.col("c.id"))
                  .when(kind == "episode", F.col("c.parent_id"))
                  .otherwise(F.lit(None)))
    return r.select("title", tt_id(item_id).alias("title_id"), tt_id(itemset_id).alias("itemset_id"))


def record_matches(matches: DataFrame, found: DataFrame, check: bool = True) -> DataFrame:
    """Upsert found ids into the match table by normalised title.

    Source = distinct (normalised title, title id, itemset id); it must hold each
    title once (raises otherwise). Matched rows get the new ids, ``has_match``
    true and the run time; new titles are inserted the same way ("No Results"
    counts as a match, as in the source, so such titles are not tried again).
    """
    src, update, insert = _match_merge(found, matches.schema["match_ts"].dataType)
    return upsert(matches, src, "title", update=update, insert=insert, check=check, distinct_source=True)


def _match_merge(found: DataFrame, ts_type: T.DataType) -> tuple[DataFrame, dict, dict]:
    """Merge source, update and insert expressions."""
    src = found.select(norm_title("title").alias("title"), "title_id", "itemset_id")
    now = F.current_timestamp().cast(ts_type)
    setters = {"title_id": F.col("s.title_id"), "itemset_id": F.col("s.itemset_id"),
               "has_match": F.lit(True), "match_ts": now}
    return src, setters, dict(setters, title=F.col("s.title"))


def record_matches_bucketed(spark: SparkSession, root: str, found: DataFrame, check: bool = True) -> Manifest:
    """C22 on a match table kept in buckets by title: only buckets that hold a found title are
    read and written. ``found`` is read twice: hand over a written table."""
    ts_type = read_bucketed(spark, root).schema["match_ts"].dataType
    src, update, insert = _match_merge(found, ts_type)
    return upsert_bucketed(src, root, update, insert, check, distinct_source=True)
