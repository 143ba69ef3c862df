"""Row predicates (F1–F7). Each returns a boolean ``Column`` the scan can push down
where the source supports it."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import ColumnOrName, _c


def suffix_and_status(c: ColumnOrName, suffix: str, status_c: ColumnOrName, status: str) -> Column:
    """the last ``len(suffix)`` characters equal ``suffix`` and the status equals ``status``."""
    n = len(suffix)
    return (F.substring(_c(c), -n, n) == F.lit(suffix)) & (_c(status_c) == F.lit(status))


def on_weekday(c: ColumnOrName, day: int = 4) -> Column:
    """Spark's ``dayofweek`` (Sunday = 1): 4 = Wednesday."""
    return F.dayofweek(_c(c)) == F.lit(day)


def non_blank(c: ColumnOrName) -> Column:
    """not null and not only blanks (Spark ``trim`` strips spaces)."""
    col = _c(c)
    return col.isNotNull() & (F.length(F.trim(col)) > 0)


def flag_true(c: ColumnOrName) -> Column:
    """boolean (or 0/1) flag is true; null is not."""
    return F.coalesce(_c(c).cast("boolean"), F.lit(False))


def all_given(*conditions: Column | None) -> Column:
    """AND of the conditions that were given; none given -> keep every row."""
    given = [c for c in conditions if c is not None]
    return reduce(and_, given) if given else F.lit(True)


def year_matches(year: ColumnOrName, candidate_year: ColumnOrName) -> Column:
    """equal years when the wanted year is known; any year otherwise."""
    y = _c(year)
    return y.isNull() | (y == 0) | (_c(candidate_year) == y)


def candidate_qualifies(kind: ColumnOrName, votes: ColumnOrName, allowed_kinds: Column,
                        min_votes: int = 200, low_votes: int = 50,
                        low_votes_kind: str = "movie") -> Column:
    """Kind in the allowed list and enough votes (a lower bar for one kind)."""
    k, v = _c(kind), F.coalesce(_c(votes), F.lit(0))
    return F.array_contains(allowed_kinds, k) & (
        (v > min_votes) | ((k == F.lit(low_votes_kind)) & (v > low_votes)))
