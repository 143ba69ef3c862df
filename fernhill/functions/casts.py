"""Scalar column expressions: numbers (N), dates and periods (T), strings (X).

Every helper returns a ``Column`` built from Spark built-ins only, so it stays
inside whole-stage codegen. Strict helpers use ``cast`` (ANSI on: bad input
raises); lenient ones use the ``try_*`` family (bad input gives null).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- numbers (N)

def whole_number(c: ColumnOrName) -> Column:
    """Strict whole number, half-up (1.5 -> 2, -1.5 -> -2); raises on junk."""
    return _c(c).cast("string").cast("decimal(38,0)")


def try_whole_number(c: ColumnOrName, precision: int = 38, scale: int = 0) -> Column:
    """Lenient number with the given precision/scale; junk -> null."""
    return (_c(c).cast("string")).try_cast(f"decimal({precision},{scale})")


def whole_long(c: ColumnOrName) -> Column:
    """Strict int/bigint: round half-up through decimal(38,0), then bigint."""
    return whole_number(c).cast("bigint")


def try_whole_long(c: ColumnOrName) -> Column:
    return (try_whole_number(c)).try_cast("bigint")


def try_int(c: ColumnOrName) -> Column:
    """Lenient int from text ("00042" -> 42, "x" -> null)."""
    return (_c(c).cast("string")).try_cast("int")


def strict_int(c: ColumnOrName) -> Column:
    return _c(c).cast("string").cast("int")


def to_double(c: ColumnOrName) -> Column:
    return _c(c).cast("double")


def try_double(c: ColumnOrName) -> Column:
    return (_c(c).cast("string")).try_cast("double")


def comma_number(c: ColumnOrName) -> Column:
    """X5: "1,234.5" -> 1234.5 (thousands marks removed, then double)."""
    return F.replace(_c(c).cast("string"), F.lit(","), F.lit("")).cast("double")


def percent_ratio(c: ColumnOrName) -> Column:
    """X6: "95%" -> 0.95."""
    return F.replace(_c(c).cast("string"), F.lit("%"), F.lit("")).cast("double") * F.lit(0.01)


# ------------------------------------------------------------------ dates (T)

def date_from(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Strict date by format (``yyyy-MM-dd`` or ``yyyyMMdd``)."""
    return F.to_date(_c(c).cast("string"), fmt)


def try_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Lenient date; bad or empty text -> null."""
    s = _c(c).cast("string")
    return F.try_to_date(s, fmt) if fmt else F.try_to_date(s)


def try_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Lenient zone-free timestamp; bad or empty text -> null."""
    s = _c(c).cast("string")
    ts = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    return ts.cast("timestamp_ntz")


def timestamp_text_date(c: ColumnOrName) -> Column:
    """Timestamp text -> its date (strict)."""
    return F.to_date(F.to_timestamp(_c(c).cast("string")))


def next_day(d: ColumnOrName) -> Column:
    """T4: the day after."""
    return F.date_add(_c(d), 1)


def next_month(d: ColumnOrName) -> Column:
    """T4: one month on, clamped to month end (31 Jan -> 28/29 Feb)."""
    return F.add_months(_c(d), 1)


# fixed values: stamp of a catalogue snapshot, yyyyMMdd_HHmmss, at the start of
# the last path segment that starts with one, and as a folder value
FILE_STAMP_PATTERN = r".*/(\d{8}_\d{6})[^/]*"
FOLDER_STAMP_PATTERN = r"(\d{8}_\d{6})"


def file_stamp(path: ColumnOrName, pattern: str = FILE_STAMP_PATTERN) -> Column:
    """T5: zone-free timestamp from the ``yyyyMMdd_HHmmss`` stamp that the file name
    in a path starts with (of nested stamps the last one counts); none -> null."""
    return try_timestamp(F.regexp_extract(_c(path), pattern, 1), "yyyyMMdd_HHmmss")


def folder_stamp(folder: ColumnOrName) -> Column:
    """T5: the same stamp read from a folder's value, e.g. a partition column."""
    return file_stamp(folder, FOLDER_STAMP_PATTERN)


def stamp_text(ts: ColumnOrName) -> Column:
    """T5: the text form used at the sink."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


# fixed value: quarterly report file names look like 2022_Q3_TRC
QUARTER_PATTERN = r"(\d{4})_Q(\d)_TRC"


def quarter_period(name: ColumnOrName) -> tuple[Column, Column]:
    """(first day of the quarter, three months on) from ``YYYY_Qn_TRC``; no match -> nulls."""
    base = F.element_at(F.split(_c(name), "/"), -1)
    year = (F.regexp_extract(base, QUARTER_PATTERN, 1)).try_cast("int")
    quarter = (F.regexp_extract(base, QUARTER_PATTERN, 2)).try_cast("int")
    month = F.when(quarter.between(1, 4), quarter * 3 - 2)
    start = F.make_date(year, month, F.lit(1))
    return start, F.add_months(start, 3)


def month_period(sheet: ColumnOrName) -> tuple[Column, Column]:
    """(first of month, first of next month) from a ``MM.yyyy`` sheet name; others -> nulls."""
    start = F.try_to_date(_c(sheet).cast("string"), "MM.yyyy")
    return start, F.add_months(start, 1)


def day_window(d: ColumnOrName, run_date: ColumnOrName, days_back: int = 7,
               length: int = 1) -> Column:
    """Rows whose day falls in [run_date - days_back, that + length)."""
    start = F.date_sub(_c(run_date), days_back)
    day = _c(d).cast("date")
    return (day >= start) & (day < F.date_add(start, length))


def run_clock() -> Column:
    """The load time of this run."""
    return F.current_timestamp()


# ---------------------------------------------------------------- strings (X)

def tail(c: ColumnOrName, n: int) -> Column:
    """Last ``n`` characters."""
    return F.substring(_c(c), -n, n)


def from_position(c: ColumnOrName, pos: int) -> Column:
    """Characters from 1-based position ``pos`` to the end."""
    return F.substr(_c(c), F.lit(pos))


def path_part(c: ColumnOrName, n: int, sep: str = "/") -> Column:
    """``n``-th part (1-based, negative from the end) of ``c`` split on ``sep``; null when short."""
    return F.try_element_at(F.split(_c(c), sep), F.lit(n))


def strip_media_suffix(c: ColumnOrName) -> Column:
    """Drop ``.ts`` (an open-dot regex, as in the source job) and then every ``s``."""
    # fixed values: the two patterns of the source job, applied in this order
    return F.regexp_replace(F.regexp_replace(_c(c), ".ts", ""), "s", "")


def extract(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """Regex group; no match -> empty string (Spark and SQL agree)."""
    return F.regexp_extract(_c(c), pattern, group)


def norm_title(c: ColumnOrName) -> Column:
    """Trim of lower."""
    return F.trim(F.lower(_c(c)))


def base_name(c: ColumnOrName) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(_c(c), "/"), -1)


def key_without_bucket(c: ColumnOrName) -> Column:
    """Object key: ``scheme://bucket/`` dropped; other text kept."""
    return F.regexp_replace(_c(c), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/", "")


def as_string_array(c: ColumnOrName, dtype=None) -> Column:
    """X11: value -> array<string>; a JSON array text is parsed, a lone value becomes [value]."""
    col = _c(c)
    if dtype is not None and dtype.typeName() == "array":
        return col.cast("array<string>")
    s = col.cast("string")
    parsed = F.from_json(s, "array<string>")
    return F.when(s.isNull(), F.lit(None).cast("array<string>")) \
        .when(F.ltrim(s).startswith("["), parsed) \
        .otherwise(F.array(s))


# fixed value: the mark stored when a title search had no candidates
NO_RESULTS = "No Results"


def tt_id(c: ColumnOrName) -> Column:
    """X12: "tt" prefix; null and "No Results" stay as they are."""
    col = _c(c).cast("string")
    return F.when(col.isNull() | (col == ""), F.lit(None).cast("string")) \
        .when(col == NO_RESULTS, col) \
        .otherwise(F.concat(F.lit("tt"), col))


def _strip_ws(c: Column) -> Column:
    # Python's str.strip(): all leading/trailing whitespace, not blanks only
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def shorten_title(c: ColumnOrName) -> Column:
    """Split on ':' or '-', drop the last part, trim each, join with ': '.

    Only titles holding ':' or '-' are shortened; others give null (no retry).
    """
    col = _c(c)
    parts = F.split(col, "[:-]")
    kept = F.slice(parts, 1, F.size(parts) - 1)
    joined = F.array_join(F.transform(kept, _strip_ws), ": ")
    return F.when(col.rlike("[:-]"), joined)


def display_title(title: ColumnOrName, year: ColumnOrName, itemset: ColumnOrName,
                  item: ColumnOrName, item_title: ColumnOrName) -> Column:
    """Display form ``"title" rest, itemset N item M (year)``; zero/empty parts count as absent."""
    t, y, s, e, r = (_c(x) for x in (title, year, itemset, item, item_title))

    def given(x: Column) -> Column:
        return x.isNotNull() & (x != 0)

    head = F.concat(F.lit('"'), F.coalesce(t, F.lit("None")), F.lit('"'),
                    F.when(r.isNotNull() & (r != ""), F.concat(F.lit(" "), r)).otherwise(F.lit("")))
    tail_ = F.concat(
        F.lit(", "),
        F.when(given(s), F.concat(F.lit("itemset "), s.cast("string"))).otherwise(F.lit("")),
        F.when(given(e), F.concat(F.lit(" item "), e.cast("string"))).otherwise(F.lit("")),
        F.when(given(y), F.concat(F.lit(" ("), y.cast("string"), F.lit(")"))).otherwise(F.lit("")),
    )
    return F.when(given(y) | given(s) | given(e), F.concat(head, tail_)).otherwise(head)


def blank_if_null(c: ColumnOrName) -> Column:
    """Null text -> empty string."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))
