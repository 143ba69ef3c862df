"""Typed loads (P1–P5, P10): a load spec is data -- a list of (target, kind,
accepted source names) -- and ``load_projection`` turns it into ONE ``select``
over the staged rows: no per-column ``withColumn`` chains, no UDFs, every cast a
built-in expression inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts as X
from ..operators.shaping import q
from ..sources.dynamic import FILE, ROW, by_name
from ..sources.readers import source_file_column
from ..sources.workbook import sheet_rows

# kind -> (cast builder over a text Column, Spark type of the result)
_KINDS = {
    "text": (lambda c: c.cast("string"), T.StringType()),
    "number": (X.whole_number, T.DecimalType(38, 0)),
    "number?": (X.try_whole_number, T.DecimalType(38, 0)),
    "int": (X.whole_long, T.LongType()),
    "bigint": (X.whole_long, T.LongType()),
    "float": (X.to_double, T.DoubleType()),
    "comma_float": (X.comma_number, T.DoubleType()),
    "percent": (X.percent_ratio, T.DoubleType()),
    "array": (X.as_string_array, T.ArrayType(T.StringType())),
    "decimal(10,5)?": (lambda c: X.try_whole_number(c, 10, 5), T.DecimalType(10, 5)),
    "date?": (lambda c: X.try_date(c, "yyyy-MM-dd"), T.DateType()),
    "timestamp?": (X.try_timestamp, T.TimestampNTZType()),
    "timestamp": (lambda c: c.cast("string").cast("timestamp_ntz"), T.TimestampNTZType()),
    "ts_date": (X.timestamp_text_date, T.DateType()),
}


def kind_type(kind: str) -> T.DataType:
    if kind.startswith("date:"):
        return T.DateType()
    return _KINDS[kind][1]


def cast_kind(c: Column, kind: str) -> Column:
    """Apply a spec kind to a (text) column."""
    if kind.startswith("date:"):
        return X.date_from(c, kind.split(":", 1)[1])
    return _KINDS[kind][0](c)


@dataclass(frozen=True)
class Field:
    target: str
    kind: str
    sources: tuple[str, ...]


@dataclass(frozen=True)
class Period:
    """How the report period is found: ``params`` (run window), ``row_date``
    (one date column, end = next day), ``row_pair`` (two date columns),
    ``row_ts_pair`` (two timestamp-text columns), ``row_ts_month`` (timestamp
    text, end = next month), ``sheet_month`` (``MM.yyyy`` sheet name),
    ``file_quarter`` (``YYYY_Qn_TRC`` in the file path) or ``none``."""

    how: str = "none"
    cols: tuple[str, ...] = ()
    fmt: str | None = None


@dataclass(frozen=True)
class LoadSpec:
    name: str
    fields: tuple[Field, ...]
    period: Period = Period()
    constants: tuple[str, ...] = ()          # target names of run constants (channel, report type)
    audit: tuple[str, ...] = ("source_key", "loaded_ts", "start_date", "end_date", "run_id")
    extra: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        names = [f.target for f in self.fields] + list(self.constants)
        dup = {n for n in names if names.count(n) > 1}
        if dup:
            raise ValueError(f"spec {self.name}: target named twice: {sorted(dup)}")

    def required(self, have: Sequence[str]) -> list[str]:
        """Per field the accepted name found among ``have``, else its usual one; then the period's columns."""
        names = [next((s for s in f.sources if s in have), f.sources[0]) for f in self.fields]
        return list(dict.fromkeys([*names, *self.period.cols]))

    def source_names(self) -> list[str]:
        return [f.sources[0] for f in self.fields]


def F_(target: str, kind: str, *sources: str) -> Field:
    """Spec entry: target column, kind, accepted source names (first is the usual one)."""
    return Field(target, kind, tuple(sources) if sources else (target,))


def resolve_source(df_columns: Sequence[str], f: Field, kind: str | None = None) -> Column:
    """The first accepted source name present in the file (exact, case-sensitive
    match); none present -> a typed null, never an error."""
    have = set(df_columns)
    for s in f.sources:
        if s in have:
            return F.col(q(s))
    return F.lit(None).cast("string")


def _period(df_columns: Sequence[str], spec: LoadSpec, start, end,
            path: Column) -> tuple[Column, Column]:
    p = spec.period
    lit_date = (lambda v: F.lit(v).cast("date") if v is not None else F.lit(None).cast("date"))
    col = (lambda name: F.col(q(name)) if name in df_columns else F.lit(None).cast("string"))
    if p.how == "params":
        return lit_date(start), lit_date(end)
    if p.how == "row_date":
        d = X.date_from(col(p.cols[0]), p.fmt or "yyyy-MM-dd")
        return d, X.next_day(d)
    if p.how == "row_pair":
        return (X.date_from(col(p.cols[0]), p.fmt or "yyyy-MM-dd"),
                X.date_from(col(p.cols[1]), p.fmt or "yyyy-MM-dd"))
    if p.how == "row_ts_pair":
        return X.timestamp_text_date(col(p.cols[0])), X.timestamp_text_date(col(p.cols[1]))
    if p.how == "row_ts_month":
        d = X.timestamp_text_date(col(p.cols[0]))
        return d, X.next_month(d)
    if p.how == "sheet_month":
        return X.month_period(col(p.cols[0]))
    if p.how == "file_quarter":
        return X.quarter_period(F.regexp_extract(path, X.QUARTER_PATTERN, 0))
    return lit_date(None), lit_date(None)


def load_projection(df: DataFrame, spec: LoadSpec, run_id: str | None = None, start=None, end=None,
                    constants: Mapping[str, str] | None = None, source_key: Column | None = None,
                    drop_unperiodised: bool = True) -> DataFrame:
    """Staged text rows -> the typed table of ``spec``, in one projection.

    P2 absent source names give typed nulls; P3 names are matched exactly;
    P4 run constants; P5 audit envelope (source file, load time, period, run id).
    For ``sheet_month`` specs, rows of sheets whose name is not a month are
    skipped, as the source skipped such sheets.
    """
    cols = df.columns
    consts = dict(constants or {})
    path = source_key if source_key is not None else source_file_column()
    out: list[Column] = []
    for f in spec.fields:
        out.append(cast_kind(resolve_source(cols, f), f.kind).cast(kind_type(f.kind)).alias(f.target))
    for name in spec.constants:
        out.append(F.lit(consts.get(name)).cast("string").alias(name))
    start_c, end_c = _period(cols, spec, start, end, path)
    audit = {
        "source_key": path.cast("string"),
        "loaded_ts": F.current_timestamp(),
        "start_date": start_c,
        "end_date": end_c,
        "run_id": F.lit(run_id).cast("string"),
    }
    out.extend(audit[a].alias(a) for a in spec.audit)
    typed = df.select(out)
    if spec.period.how == "sheet_month" and drop_unperiodised:
        typed = typed.where(F.col("start_date").isNotNull())
    return typed


def load_sheets(cells: DataFrame, spec: LoadSpec, run_id: str | None = None, start=None, end=None,
                constants: Mapping[str, str] | None = None, **options) -> DataFrame:
    """S5 + P1: sheets of a cells table -> the typed table of ``spec``.

    ``options`` are those of ``sheet_rows``. Every accepted header name is looked for
    in every sheet; of two spellings of one field the first that holds a value is taken.
    The workbook's path is the source file and its sheet the ``sheet`` column.
    """
    wanted = [s.strip() for f in spec.fields for s in f.sources] + [c for c in spec.period.cols if c != "sheet"]
    rows = sheet_rows(cells, names=list(dict.fromkeys(wanted)), **options)
    by_name = {f.sources[0]: F.coalesce(*[F.col(q(s.strip())) for s in f.sources]).alias(f.sources[0]) for f in spec.fields}
    for c in spec.period.cols:
        by_name.setdefault(c, F.col(q(c)))
    book = F.col("path").alias("workbook path")
    return load_projection(rows.select(book, *by_name.values()), spec, run_id=run_id, start=start, end=end,
                           constants=constants, source_key=F.col("`workbook path`"))


def load_dynamic(rows: DataFrame, spec: LoadSpec, run_id: str | None = None, start=None, end=None,
                 constants: Mapping[str, str] | None = None, na_values: Sequence[str] = ()) -> DataFrame:
    """P2/P3 + P1: dynamic rows (``sources.dynamic``) -> the typed table of ``spec``.

    Each row is asked for every accepted name; of two spellings of one field the first
    that holds a value is taken, and a row without any of them has a null.
    """
    na = [v for v in na_values if v != ""]

    def value(name: str) -> Column:
        v = by_name(ROW, name)
        return F.when(~v.isin(na), v) if na else v

    columns = {f.sources[0]: F.coalesce(*[value(s) for s in f.sources]).alias(f.sources[0]) for f in spec.fields}
    for c in spec.period.cols:
        columns.setdefault(c, value(c).alias(c))
    return load_projection(rows.select(q(FILE), *columns.values()), spec, run_id=run_id, start=start, end=end,
                           constants=constants, source_key=F.col(q(FILE)))


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Run constants as columns."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in values.items()])


def with_audit(df: DataFrame, run_id: str, start=None, end=None, source_key: Column | None = None) -> DataFrame:
    """P5: audit envelope on any DataFrame read from files."""
    path = source_key if source_key is not None else source_file_column()
    return df.select("*", path.cast("string").alias("source_key"), F.current_timestamp().alias("loaded_ts"),
                     F.lit(start).cast("date").alias("start_date"), F.lit(end).cast("date").alias("end_date"),
                     F.lit(run_id).cast("string").alias("run_id"))


def spec_for_path(path: str, specs: Mapping[str, LoadSpec], channel_part: int = -3,
                  report_part: int = -2) -> tuple[LoadSpec, str]:
    """P10: choose the spec from the path layout ``.../<channel>/<report>/<file>``;
    returns (spec, channel). Driver-side: one lookup per landed prefix, not per row."""
    parts = path.rstrip("/").split("/")
    report, channel = parts[report_part], parts[channel_part]
    if report not in specs:
        raise KeyError(f"no load spec for report {report!r} (path {path})")
    return specs[report], channel


def channel_of(path_col: Column, n: int = -3) -> Column:
    """P10: the channel path segment as a column (null when the path is short)."""
    return F.try_element_at(F.split(path_col, "/"), F.lit(n))
