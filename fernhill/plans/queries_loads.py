"""Queries for the typed loads (C4–C19) and the load projection pieces.

Each load query lands a partner-style report derived from ``lineitem`` (every
source column of the spec rendered as text, by a rule on its kind) as CSV in
the shared scratch folder, reads it back with the report reader (S3) and types
it with ``load_projection``. The text-rendering rule is one SQL expression per
column that Spark and DuckDB both run; the typing is Spark's on one side and
plain SQL casts on the other. Load time and source path are left out of the
compared columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.shaping import keep_columns, q, require_columns, shape
from ..session import scratch_path
from ..sinks.writers import write_report_csv
from ..sources.readers import read_report_csv
from ..sources.workbook import parse_usecols
from .loads import F_, LoadSpec, load_projection, load_sheets, with_audit, with_constants
from .registry import register, table, table_state
from .specs import SPECS

RUN_ID = "run-1"
RUN_START, RUN_END = "2024-01-01", "2024-01-08"
CONSTANTS = {"channel_name": "channel-a", "report_type": "vod"}
QUARTER_FOLDER = "2022_Q3_TRC"
PART_ROWS = 30_000   # rows of a report part (S4): parts are read in parallel

_ATOMS = ("l_orderkey", "l_partkey", "l_suppkey", "CAST(l_quantity AS BIGINT)", "l_linenumber")
_DATE = "CAST(CAST(l_shipdate AS DATE) AS STRING)"


def _text_sql(kind: str, i: int) -> str:
    """Text of a report column of ``kind`` (the i-th of its spec), over lineitem."""
    a = f"CAST({_ATOMS[i % len(_ATOMS)]} AS STRING)"
    whole = f"{a} || '.' || CAST(l_linenumber AS STRING)"
    if kind == "text":
        # quotes, commas, line breaks and backslashes, as free text has them
        return (f"CASE l_linenumber WHEN 2 THEN l_returnflag || ' \"' || {a} || '\", x' "
                f"WHEN 3 THEN l_returnflag || chr(10) || {a} WHEN 4 THEN l_returnflag || chr(92) || {a} "
                f"ELSE l_returnflag || '-' || {a} END")
    if kind in ("number", "int", "bigint"):
        return whole
    if kind == "number?":
        return f"CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE {whole} END"
    if kind == "float":
        return f"{a} || '.' || lpad(CAST(l_linenumber AS STRING), 2, '0')"
    if kind == "comma_float":
        return f"{a} || ',' || lpad(CAST(l_linenumber * 37 AS STRING), 3, '0') || '.5'"
    if kind == "percent":
        return "CAST(l_linenumber * 7 AS STRING) || '%'"
    if kind == "array":
        return ("CASE WHEN l_linenumber > 4 THEN l_returnflag "
                "ELSE '[\"' || l_returnflag || '\",\"' || l_linestatus || '\"]' END")
    if kind == "decimal(10,5)?":
        return (f"CASE WHEN l_linenumber = 6 THEN 'x' ELSE CAST({_ATOMS[i % len(_ATOMS)]} % 10000 AS STRING) || '.' || "
                "lpad(CAST(l_linenumber * 12345 AS STRING), 6, '0') END")
    if kind == "date:yyyy-MM-dd":
        return _DATE
    if kind == "date:yyyyMMdd":
        return f"replace({_DATE}, '-', '')"
    if kind == "date?":
        return f"CASE WHEN l_linenumber = 7 THEN 'bad' ELSE {_DATE} END"
    if kind in ("timestamp", "ts_date"):
        return "CAST(l_shipdate AS STRING)"
    if kind == "timestamp?":
        return "CASE WHEN l_linenumber = 7 THEN 'bad' ELSE CAST(l_shipdate AS STRING) END"
    raise ValueError(kind)


def _period_text(spec: LoadSpec) -> dict[str, str]:
    """Columns the period is read from get period-shaped text."""
    p = spec.period
    if p.how == "row_date":
        return {p.cols[0]: f"replace({_DATE}, '-', '')"}
    if p.how == "row_pair":
        return {c: _DATE for c in p.cols}
    if p.how in ("row_ts_pair", "row_ts_month"):
        return {c: "CAST(l_shipdate AS STRING)" for c in p.cols}
    if p.how == "sheet_month":
        return {p.cols[0]: "CASE WHEN l_linenumber = 1 THEN 'Summary' "
                           "ELSE lpad(CAST(l_linenumber AS STRING), 2, '0') || '.2022' END"}
    return {}


def report_columns(spec: LoadSpec) -> list[tuple[str, str]]:
    """(file column name, SQL text expression) for a spec's derived report.

    The file carries each column under its last accepted name (partners'
    misspellings and stray blanks included)."""
    over = _period_text(spec)
    cols: dict[str, str] = {}
    for i, f in enumerate(spec.fields):
        name = f.sources[-1]
        if name not in cols:
            cols[name] = over.get(name, _text_sql(f.kind, i))
    for name, expr in over.items():
        cols.setdefault(name, expr)
    return list(cols.items())


_LANDED: dict[tuple, str] = {}


def land_report(spark: SparkSession, sf: str, job: str) -> str:
    """Write the derived report of ``job`` as gzip CSV (once per session and state of the table).

    The parts are read whole in any case (line breaks in fields), so compression costs no parallelism."""
    key = (job, *table_state(spark, sf, "lineitem"))
    if key not in _LANDED:
        spec = SPECS[job]
        li = table(spark, sf, "lineitem")
        exprs = [F.expr(sql).alias(name) for name, sql in report_columns(spec)]
        name = QUARTER_FOLDER if spec.period.how == "file_quarter" else job
        path = scratch_path(spark, f"report-{name}")
        write_report_csv(li.select(exprs), path, rows_per_file=PART_ROWS, compression="gzip")
        _LANDED[key] = path
    return _LANDED[key]


def typed_load(spark: SparkSession, sf: str, job: str) -> DataFrame:
    """S3 + P1–P5: read the landed report and type it by its spec."""
    spec = SPECS[job]
    raw = read_report_csv(spark, land_report(spark, sf, job), multiline=True)
    return load_projection(raw, spec, run_id=RUN_ID, start=RUN_START, end=RUN_END, constants=CONSTANTS)


# ------------------------------------------------------------- DuckDB side

def _duck_cast(x: str, kind: str) -> str:
    if kind == "text":
        return x
    if kind == "number":
        return f"CAST({x} AS DECIMAL(38,0))"
    if kind == "number?":
        return f"TRY_CAST({x} AS DECIMAL(38,0))"
    if kind in ("int", "bigint"):
        return f"CAST(CAST({x} AS DECIMAL(38,0)) AS BIGINT)"
    if kind == "float":
        return f"CAST({x} AS DOUBLE)"
    if kind == "comma_float":
        return f"CAST(replace({x}, ',', '') AS DOUBLE)"
    if kind == "percent":
        return f"CAST(replace({x}, '%', '') AS DOUBLE) * 0.01"
    if kind == "array":
        return (f"CASE WHEN {x} IS NULL THEN NULL WHEN ltrim({x}) LIKE '[%' "
                f"THEN CAST(CAST({x} AS JSON) AS VARCHAR[]) ELSE [{x}] END")
    if kind == "decimal(10,5)?":
        return f"TRY_CAST({x} AS DECIMAL(10,5))"
    if kind == "date:yyyy-MM-dd":
        return f"CAST(strptime({x}, '%Y-%m-%d') AS DATE)"
    if kind == "date:yyyyMMdd":
        return f"CAST(strptime({x}, '%Y%m%d') AS DATE)"
    if kind == "date?":
        return f"CAST(TRY_STRPTIME({x}, '%Y-%m-%d') AS DATE)"
    if kind == "timestamp?":
        return f"TRY_CAST({x} AS TIMESTAMP)"
    if kind == "timestamp":
        return f"CAST({x} AS TIMESTAMP)"
    if kind == "ts_date":
        return f"CAST(CAST({x} AS TIMESTAMP) AS DATE)"
    raise ValueError(kind)


def _dq(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def load_oracle_sql(job: str) -> str:
    spec = SPECS[job]
    cols = report_columns(spec)
    derived = ",\n    ".join(f"{sql} AS {_dq(name)}" for name, sql in cols)
    # the reader trims blanks before header names
    names = {name: name.lstrip() for name, _ in cols}
    out = []
    for f in spec.fields:
        src = f.sources[-1]
        out.append(f"{_duck_cast(_dq(names[src]), f.kind)} AS {_dq(f.target)}")
    for c in spec.constants:
        out.append(f"'{CONSTANTS[c]}' AS {_dq(c)}")
    p = spec.period
    where = ""
    if p.how == "params":
        start, end = f"DATE '{RUN_START}'", f"DATE '{RUN_END}'"
    elif p.how == "row_date":
        start = _duck_cast(_dq(p.cols[0]), "date:yyyyMMdd")
        end = f"CAST({start} + INTERVAL 1 DAY AS DATE)"
    elif p.how == "row_pair":
        start, end = (_duck_cast(_dq(c), "date:yyyy-MM-dd") for c in p.cols)
    elif p.how == "row_ts_pair":
        start, end = (_duck_cast(_dq(c), "ts_date") for c in p.cols)
    elif p.how == "row_ts_month":
        start = _duck_cast(_dq(p.cols[0]), "ts_date")
        end = f"CAST({start} + INTERVAL 1 MONTH AS DATE)"
    elif p.how == "sheet_month":
        start = f"CAST(TRY_STRPTIME({_dq(p.cols[0])}, '%m.%Y') AS DATE)"
        end = f"CAST({start} + INTERVAL 1 MONTH AS DATE)"
        where = f"WHERE {start} IS NOT NULL"
    elif p.how == "file_quarter":
        start, end = "DATE '2022-07-01'", "DATE '2022-10-01'"
    else:
        start = end = None
    if "start_date" in spec.audit:
        out.append(f"{start} AS start_date")
        out.append(f"{end} AS end_date")
    out.append(f"'{RUN_ID}' AS run_id")
    body = ",\n  ".join(out)
    renamed = ", ".join(f"{_dq(n)} AS {_dq(names[n])}" for n, _ in cols)
    return (f"WITH rep AS (SELECT {renamed} FROM (SELECT\n    {derived}\n  FROM lineitem))\n"
            f"SELECT\n  {body}\nFROM rep {where}")


COMPARED_DROP = ("source_key", "loaded_ts")

_JOB_NAMES = {
    "c4": "asset_report", "c5": "basic_metrics", "c6": "demographics", "c7": "device_type",
    "c8": "traffic_source", "c9": "finance", "c10": "revenue_v3", "c11": "revenue_v4",
    "c12": "monetization_v5", "c13": "finance_v6", "c14": "revenue_v7", "c15": "catalogue_items",
    "c16": "catalogue_shows", "c17": "catalogue_sources", "c18": "catalogue_item_sources",
    "c19": "catalogue_availability",
}


def _make(job: str):
    def build(spark, sf):
        return typed_load(spark, sf, job).drop(*COMPARED_DROP)

    build.__name__ = f"{job}_{_JOB_NAMES[job]}"
    build.__doc__ = f"{job.upper()}: typed load '{SPECS[job].name}' ({len(SPECS[job].fields)} columns + audit)."
    return build


for _job in SPECS:
    register(f"{_job}_{_JOB_NAMES[_job]}", sql=load_oracle_sql(_job))(_make(_job))


# ------------------------------------------- workbook-shaped loads (S5 + P1)

# job -> (sheet name or None for the month sheets, file columns in use, sheet options)
SHEETS = {
    "c11": ("Sheet1", None, {"sheet": 0, "skip_footer": 4}),
    "c12": (None, "B:H", {"sheet_regex": [r"\d{2}\.\d{4}"], "skip": 4, "thousands": ",", "usecols": "B:H"}),
    "c13": ("Sheet1", None, {"sheet": 0}),
    "c14": ("VOD by Asset", "A:G,I,K,M", {"sheet": "VOD by Asset", "thousands": ",", "usecols": "A:G,I,K,M"}),
}
_BOOK_KEYS = 4096   # order keys a workbook: the number of books grows with the table


def report_cells(spark: SparkSession, sf: str, job: str) -> DataFrame:
    """The derived report of ``job`` as a cells table: books by order key, with skipped
    rows, unused columns, footer rows, thousands marks and a sheet that is not wanted.

    Rows are numbered within their sheet as lineitem's own columns; the wide cells are written out after that shuffle."""
    spec = SPECS[job]
    sheet, usecols, options = SHEETS[job]
    cols = [(n, sql) for n, sql in report_columns(spec) if n != "sheet"]
    marked = {s for f in spec.fields if f.kind == "int" for s in f.sources} if options.get("thousands") else set()
    used = parse_usecols(usecols) if usecols else list(range(len(cols)))

    def laid_out(values):
        at = dict(zip(used, values))
        return F.array(*[at.get(i, F.lit("unused")) for i in range(max(used) + 1)])

    def text(name, sql):
        return F.regexp_replace(F.expr(sql), r"^(\d+)(\d{3})\.", "$1,$2.") if name in marked else F.expr(sql)

    sheet_sql = F.lit(sheet) if sheet else F.expr(dict(report_columns(spec))["sheet"])
    folder = f"{QUARTER_FOLDER}/" if spec.period.how == "file_quarter" else ""
    li = table(spark, sf, "lineitem").select("*", F.floor(F.col("l_orderkey") / _BOOK_KEYS).alias("book"), sheet_sql.alias("sheet"))
    within = Window.partitionBy("book", "sheet")
    skip, footer = options.get("skip", 0), options.get("skip_footer", 0)
    li = li.select("*", F.row_number().over(within.orderBy("l_orderkey", "l_linenumber")).alias("n"),
                   F.count("*").over(within).cast("int").alias("size"))
    li = li.select(
        "n", "size", F.format_string(f"{folder}book-%d.xlsx", F.col("book")).alias("path"), "sheet",
        (F.lit(0) if sheet else F.col("l_linenumber").cast("int")).alias("sheet_index"), laid_out([text(n, sql) for n, sql in cols]).alias("cells"))

    def line(row, cells, of=None):
        return F.struct(F.lit(of).cast("string").alias("sheet") if of else F.col("sheet"),
                        (F.lit(9) if of else F.col("sheet_index")).alias("sheet_index"), row.cast("int").alias("row"),
                        (F.lit(1) if of else F.col("size") + skip + footer).cast("int").alias("last_row"), cells.alias("cells"))

    head = laid_out([F.lit(n) for n, _ in cols])
    own = line(F.col("n") + skip, F.col("cells"))
    around = [*(line(F.lit(i), F.array(F.lit("note"))) for i in range(skip)), line(F.lit(skip), head),
              *(line(F.col("size") + skip + 1 + i, F.array(F.lit("Total"))) for i in range(footer)),
              line(F.lit(0), head, "Notes"), line(F.lit(1), F.array(F.lit("not a report row")), "Notes")]
    lines = F.when(F.col("n") == 1, F.array(own, *around)).otherwise(F.array(own))
    return li.select("path", F.explode(lines).alias("line")).select("path", "line.*")


def _make_sheets(job: str):
    def build(spark, sf):
        options = SHEETS[job][2]
        return load_sheets(report_cells(spark, sf, job), SPECS[job], run_id=RUN_ID, start=RUN_START, end=RUN_END,
                           constants=CONSTANTS, **options).drop(*COMPARED_DROP)

    build.__name__ = f"{job}_sheet_{_JOB_NAMES[job]}"
    build.__doc__ = f"{job.upper()}: typed load '{SPECS[job].name}' from the sheets of a cells table."
    return build


for _job in SHEETS:
    register(f"{_job}_sheet_{_JOB_NAMES[_job]}", sql=load_oracle_sql(_job))(_make_sheets(_job))


# --------------------------------------------------- projection pieces (P*)

@register("p1_load_projection", sql=load_oracle_sql("c5"))
def p1_load_projection(spark, sf):
    """The 39-column metrics spec applied in one projection (same as C5)."""
    return typed_load(spark, sf, "c5").drop(*COMPARED_DROP)


@register("p2_absent_is_null", sql="""
SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS missing_text, CAST(NULL AS DECIMAL(38,0)) AS missing_number
FROM part
""")
def p2_absent_is_null(spark, sf):
    from .loads import cast_kind, kind_type, resolve_source
    p = table(spark, sf, "part")
    fields = [F_("p_partkey", "text", "p_partkey"), F_("p_name", "text", "p_name"),
              F_("missing_text", "text", "no_such_column"), F_("missing_number", "number", "nor_this")]
    out = p.select([cast_kind(resolve_source(p.columns, f), f.kind).cast(kind_type(f.kind)).alias(f.target)
                    for f in fields])
    return out.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@register("p3_exact_names", sql="""
SELECT "Completion %", "Title/ItemSet ID", "Pre-order Flag" FROM (
  SELECT l_discount AS "Completion %", l_returnflag AS "Title/ItemSet ID", l_linestatus AS "Pre-order Flag"
  FROM lineitem)
""")
def p3_exact_names(spark, sf):
    li = table(spark, sf, "lineitem")
    renamed = shape(li, keep=["l_discount", "l_returnflag", "l_linestatus"],
                    rename={"l_discount": "Completion %", "l_returnflag": "Title/ItemSet ID",
                            "l_linestatus": "Pre-order Flag"})
    return renamed.select(F.col(q("Completion %")), F.col(q("Title/ItemSet ID")), F.col(q("Pre-order Flag")))


@register("p4_constants", sql="""
SELECT event_id, event_type, 'channel-a' AS channel_name, 'vod' AS report_type, 'run-1' AS run_id FROM events
""")
def p4_constants(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    return with_constants(e, channel_name="channel-a", report_type="vod", run_id=RUN_ID)


@register("p5_audit", sql=f"""
SELECT o_orderkey, o_orderstatus, DATE '{RUN_START}' AS start_date, DATE '{RUN_END}' AS end_date,
       '{RUN_ID}' AS run_id, true AS has_source
FROM orders
""")
def p5_audit(spark, sf):
    o = spark.read.parquet(f"{sf.rstrip('/')}/orders.parquet")
    a = with_audit(o, RUN_ID, RUN_START, RUN_END)
    return a.select("o_orderkey", "o_orderstatus", "start_date", "end_date", "run_id",
                    F.col("source_key").endswith("orders.parquet").alias("has_source"))


@register("p6_shape", sql="""
SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment FROM customer
""")
def p6_shape(spark, sf):
    c = table(spark, sf, "customer")
    return shape(c, rename={"c_custkey": "customer_id", "c_name": "name"}, drop=["c_nationkey", "c_acctbal"])


@register("p7_require_columns", sql="SELECT p_partkey, p_name, p_size FROM part")
def p7_require_columns(spark, sf):
    """The check passes for present columns (a missing one raises before any job)."""
    p = table(spark, sf, "part")
    require_columns(p, ["p_partkey", "p_name", "p_size"])
    return p.select("p_partkey", "p_name", "p_size")


@register("p8_keep_columns", sql="SELECT p_size, p_name, p_partkey FROM part")
def p8_keep_columns(spark, sf):
    return keep_columns(table(spark, sf, "part"), ["p_size", "p_name", "p_partkey"])


# ----------------------------------------------------- C23: report pages


def _metric_pages(spark, sf):
    """Partner metric pages (one per return flag, each with its own column set)."""
    li = table(spark, sf, "lineitem")
    a = li.where(F.col("l_returnflag") == "A").select(F.col("l_partkey").alias("item_id"), "l_orderkey",
                                                      F.col("l_quantity").alias("views"))
    n = li.where(F.col("l_returnflag") == "N").select(F.col("l_partkey").alias("item_id"), "l_orderkey",
                                                      F.col("l_quantity").alias("views"),
                                                      F.col("l_discount").alias("likes"))
    r = li.where(F.col("l_returnflag") == "R").select(F.col("l_partkey").alias("item_id"), "l_orderkey",
                                                      F.col("l_tax").alias("likes"))
    return a, n, r


@register("c23_unique_item_ids", sql="SELECT DISTINCT l_partkey AS item_id FROM lineitem WHERE l_partkey IS NOT NULL")
def c23_unique_item_ids(spark, sf):
    """Unique non-null item ids over all report pages."""
    from ..sources.files import unique_ids

    return unique_ids(_metric_pages(spark, sf), "item_id")


@register("c23_stamped_metrics", sql=f"""
SELECT l_partkey AS item, l_orderkey AS order_key,
       CASE WHEN l_returnflag IN ('A', 'N') THEN l_quantity END AS views,
       CASE WHEN l_returnflag = 'N' THEN l_discount WHEN l_returnflag = 'R' THEN l_tax END AS likes,
       DATE '{RUN_START}' AS start_date, DATE '{RUN_END}' AS end_date, 'channel-a' AS channel
FROM lineitem
""")
def c23_stamped_metrics(spark, sf):
    """Pages stacked by name (U1), stamped with start, end and channel (P4), renamed."""
    from ..operators.sets import stack

    pages = stack(*_metric_pages(spark, sf))
    stamped = with_constants(pages, start_date=RUN_START, end_date=RUN_END, channel="channel-a")
    stamped = stamped.withColumn("start_date", F.col("start_date").cast("date")) \
        .withColumn("end_date", F.col("end_date").cast("date"))
    return shape(stamped, rename={"item_id": "item", "l_orderkey": "order_key"})
