"""Title parsing (M1–M3) as column expressions.

A raw title such as ``My_Show_S01E02_Pilot (2004)`` is split into the bare
title, a release year, itemset (season) and item (episode) numbers and the
rest-title. Everything is ``regexp_extract`` / ``regexp_replace`` so the work
stays in the JVM; no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the three title patterns (Python `re` syntax; Java accepts them
# unchanged). "(?U)" makes \W, \s and \d Unicode-aware in Java as they are in Python.
ITEM_ITEMSET_PATTERN = r"(?:^|\W)(?i:s|itemset)\W?\s?(\d{1,2})\s?[_\W]?\s?(?i:e|item)\W?\s?(\d{1,3})(\W.*|$)"
ITEMSET_ONLY_PATTERN = r"(?:^|\W)(?i:itemset)\s?(\d{1,2})(?:\W|$)"
YEAR_PATTERN = r"(\(\d{4}\)|\[\d{4}\]|\{\d{4}\})"
# fixed value: years outside [FIRST_YEAR, this year] are not years
FIRST_YEAR = 1900

_U = "(?U)"

PARSED_TYPE = "struct<title:string,year:int,itemset:int,item:int,item_title:string>"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def parse_titles(df, c: str = "title", into: str = "parsed"):
    """M1–M3: add ``struct(title, year, itemset, item, item_title)`` of column ``c`` as column
    ``into``; null title -> null struct.

    M1: "_" becomes a blank; the first bracketed 4-digit number is the year when
    it lies in [1900, this year], and then every bracketed year is removed.
    M2: "S01E02" / "itemset 1 item 2" gives two numbers and a rest-title (its
    first character dropped, then trimmed; empty -> null); the match to the
    end of the title is removed.
    M3: only when M2 fails, "itemset 4" gives the itemset number.

    It is computed in stages: each regex runs once per row and the
    generated code stays small. Catalyst keeps the stages apart because it
    does not inline a non-trivial expression into several consumers. The struct
    leaves through ``explode`` of a one-element array: a filter on its fields stays
    above that, where it would else be pushed below the stages (and a preceding
    ``distinct``) with every regex written out in it dozens of times."""
    keep = [F.col(f"`{x}`") for x in df.columns]
    col = F.col(f"`{c}`")
    s = df.select(*keep, F.replace(col, F.lit("_"), F.lit(" ")).alias("__t0"))
    s = s.select(*keep, "__t0",
                 F.substring(F.regexp_extract("__t0", _U + YEAR_PATTERN, 1), 2, 4).try_cast("int").alias("__yn"))
    s = s.select(*keep, "__t0",
                 F.when(F.col("__yn").between(F.lit(FIRST_YEAR), F.year(F.current_date())), F.col("__yn"))
                 .alias("__year"))
    s = s.select(*keep, "__year",
                 F.when(F.col("__year").isNotNull(), F.regexp_replace("__t0", _U + YEAR_PATTERN, ""))
                 .otherwise(F.col("__t0")).alias("__t1"))
    t1 = F.col("__t1")
    s = s.select(*keep, "__year", "__t1", t1.rlike(_U + ITEM_ITEMSET_PATTERN).alias("__m2"),
                 t1.rlike(_U + ITEMSET_ONLY_PATTERN).alias("__m3any"))
    m2 = F.col("__m2")
    m3 = ~m2 & F.col("__m3any")
    s = s.select(
        *keep, "__year", "__t1", "__m2", m3.alias("__m3"),
        F.when(m2, F.regexp_extract(t1, _U + ITEM_ITEMSET_PATTERN, 1)).try_cast("int").alias("__g1"),
        F.when(m2, F.regexp_extract(t1, _U + ITEM_ITEMSET_PATTERN, 2)).try_cast("int").alias("__g2"),
        F.when(m2, F.regexp_extract(t1, _U + ITEM_ITEMSET_PATTERN, 3)).alias("__g3"),
        F.when(m3, F.regexp_extract(t1, _U + ITEMSET_ONLY_PATTERN, 1)).try_cast("int").alias("__h1"),
        F.when(m2, F.regexp_replace(t1, _U + ITEM_ITEMSET_PATTERN, ""))
        .when(m3, F.regexp_replace(t1, _U + ITEMSET_ONLY_PATTERN, "")).otherwise(t1).alias("__t2"))
    g3 = F.col("__g3")
    rest = F.when(F.length(g3) > 1, _strip(F.substr(g3, F.lit(2))))
    parsed = F.struct(
        _strip(F.col("__t2")).alias("title"),
        F.col("__year").alias("year"),
        F.coalesce(F.col("__g1"), F.col("__h1")).alias("itemset"),
        F.col("__g2").alias("item"),
        F.when(rest != "", rest).alias("item_title"),
    )
    return s.select(*keep, F.explode(F.array(F.when(col.isNotNull(), parsed))).alias(into))
