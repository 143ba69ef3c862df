"""Inputs of the reference's jobs, derived by Spark from the given tables.

The reference reads CDN logs, catalogue feeds and partner reports; the test
tables are TPC-H-like. Each function here re-shapes a given table into the
input a job expects, so every registered query's work grows with the tables.
The DuckDB oracle in ``registry.py`` builds the same rows in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.readers import ACCESS_LOG_SCHEMA


def access_log_rows(events: DataFrame) -> DataFrame:
    """CDN log rows (18 fields) from ``events``.

    ip from the user, agent from the event type, file from the ``k`` value in
    ``props`` (tens), the segment name from the day and the value (tens);
    errors are served 404, purchases are ``.mp4`` (not media segments), signups
    hit a segment without a content time, values under 5 hit a short URI.
    """
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    file_id = F.concat(F.lit("f"), F.floor(k / 10).cast("string"))
    point = F.lpad(F.floor(F.col("value") / 10).cast("int").cast("string"), 5, "0")
    day = F.date_format("ts", "yyyyMMdd")
    ext = F.when(F.col("event_type") == "purchase", F.lit(".mp4")).otherwise(F.lit(".ts"))
    seg = F.when(F.col("event_type") == "signup", F.lit("short.ts")) \
        .otherwise(F.concat(day, F.lit("s"), point, ext))
    stem = F.when(F.col("value") < 5, F.concat(F.lit("/vod/"), file_id, F.lit(".ts"))) \
        .otherwise(F.concat(F.lit("/vod/a/b/c/d/"), file_id, F.lit("/hls/"), seg))
    cols = {
        "date": F.date_format("ts", "yyyy-MM-dd"),
        "time": F.date_format("ts", "HH:mm:ss"),
        "cs_method": F.lit("GET"),
        "c_ip": F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")),
        "cs_version": F.lit("HTTP/1.1"),
        "cd_referrer": F.lit("-"),
        "cs_user_agent": F.col("event_type"),
        "filesize": F.floor("value").cast("int"),
        "cs_bytes": F.lit(512),
        "sc_bytes": F.lit(2048),
        "s_ip": F.lit("192.168.0.1"),
        "time_taken": F.col("value"),
        "sc_status": F.when(F.col("event_type") == "error", F.lit("404")).otherwise(F.lit("200")),
        "cs_uri_query": F.lit("-"),
        "cs_uri_stem": stem,
        "x_byte_range": F.lit("-"),
        "comment": F.lit("-"),
        "sc_x_hw": F.lit("HIT"),
    }
    return events.select([cols[f.name].cast(f.dataType).alias(f.name) for f in ACCESS_LOG_SCHEMA.fields])


def snapshot_stamp(events: DataFrame) -> F.Column:
    """Stamp of the snapshot file an event lands in: its own day for even users; for
    the others the days run backwards, so their later files hold older rows."""
    day = F.to_date("ts")
    back = F.date_sub(F.to_date(F.lit("2024-12-31")), F.date_diff(day, F.to_date(F.lit("2024-01-01"))))
    return F.date_format(F.when(F.col("user_id") % 2 == 0, day).otherwise(back), "yyyyMMdd_000000")


def land_stamped_files(feed: DataFrame, stamp_col: str, path: str) -> None:
    """Write ``feed`` as gzip JSON lines, one ``<stamp>_items.json.gz`` a stamp, under ``path``.

    Spark writes one folder a stamp; its files are then renamed (names only, no rows)."""
    spark = feed.sparkSession
    staged = f"{path}-staged"
    (feed.repartition(stamp_col).write.partitionBy(stamp_col).option("compression", "gzip")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(staged))
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = jpath(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jpath(path))
    for folder in fs.listStatus(jpath(staged)):
        if folder.isDirectory():
            stamp = folder.getPath().getName().split("=", 1)[1]
            for i, part in enumerate(p for p in fs.listStatus(folder.getPath()) if p.getPath().getName().startswith("part-")):
                fs.rename(part.getPath(), jpath(f"{path}/{stamp}_items{f'-{i}' if i else ''}.json.gz"))


def snapshot_folder(ts_col: str = "ts") -> F.Column:
    """Folder stamp ``yyyyMMdd_000000`` of the day a catalogue row was landed."""
    return F.date_format(F.col(ts_col), "yyyyMMdd_000000")


# ------------------------------------------------------------------ titles

def brand_number(c: str = "p_brand") -> F.Column:
    return F.substring(F.col(c), 7, 10).cast("int")


def raw_title(part: DataFrame) -> F.Column:
    """A partner-style title for each part: numbering and year in six styles (by ``p_type``)."""
    size, bno, name, typ = (F.col("p_size").cast("string"), brand_number().cast("string"),
                            F.col("p_name"), F.col("p_type"))
    return (F.when(typ == "ECONOMY", F.concat(name, F.lit(" S"), F.lpad(size, 2, "0"), F.lit("E"),
                                              F.lpad(bno, 2, "0"), F.lit(" - "), typ, F.lit(": "), F.col("p_brand")))
            .when(typ == "SMALL", F.concat(name, F.lit(" itemset "), size, F.lit(" item "), bno))
            .when(typ == "MEDIUM", F.concat(name, F.lit(" ("), (1880 + F.col("p_size") * 3).cast("string"), F.lit(")")))
            .when(typ == "LARGE", F.concat(name, F.lit(" itemset "), size))
            .when(typ == "PROMO", F.concat(F.replace(name, F.lit(" "), F.lit("_")), F.lit("_S"), size, F.lit("_E"),
                                           bno, F.lit("_Part_"), size))
            .otherwise(F.concat(F.upper(name), F.lit(" ["), (1950 + F.col("p_size")).cast("string"), F.lit("]"))))


def title_candidates(part: DataFrame) -> DataFrame:
    """Search candidates: one series per part name, and every part as an episode
    of it (size <= 30) or as a movie. Positions order series before its parts."""
    series = (part.groupBy("p_name").agg(F.min("p_partkey").alias("k"), F.min("p_size").alias("smin"),
                                         F.max("p_size").alias("smax"))
              .select(F.col("p_name").alias("query"), (F.col("k") * 2).alias("position"),
                      F.concat(F.lit("ser-"), F.replace("p_name", F.lit(" "), F.lit("-"))).alias("id"),
                      F.lit("series").alias("kind"), (1950 + F.col("smin")).cast("int").alias("year"),
                      (F.col("smax") * 5).cast("int").alias("votes"), F.lit(None).cast("string").alias("parent_id"),
                      F.lit(None).cast("int").alias("itemset_no"), F.lit(None).cast("int").alias("item_no")))
    episode = F.col("p_size") <= 30
    parts = part.select(
        F.col("p_name").alias("query"), (F.col("p_partkey") * 2 + 1).alias("position"),
        F.col("p_partkey").cast("string").alias("id"),
        F.when(episode, "episode").otherwise("movie").alias("kind"),
        (1950 + F.col("p_size")).cast("int").alias("year"),
        (F.floor("p_retailprice").cast("int") - 900 + F.col("p_size") * 4).alias("votes"),
        F.when(episode, F.concat(F.lit("ser-"), F.replace("p_name", F.lit(" "), F.lit("-")))).alias("parent_id"),
        F.when(episode, F.col("p_size")).cast("int").alias("itemset_no"),
        F.when(episode, brand_number()).cast("int").alias("item_no"))
    return series.unionByName(parts)


def title_map(part: DataFrame) -> DataFrame:
    """Titles seen in partner reports with the ids known so far."""
    key = F.concat(F.lit("tt"), F.col("p_partkey").cast("string"))
    return part.select(
        F.when(F.col("p_size") == 1, F.lit("  ")).otherwise(raw_title(part)).alias("title"),
        F.when(F.col("p_size") > 44, key).alias("title_id"),
        F.when(F.col("p_size") > 47, key).alias("itemset_id"))


def match_table(part: DataFrame) -> DataFrame:
    """Current match table: one row per normalised title of the LARGE parts."""
    return (part.where(F.col("p_type") == "LARGE")
            .select(F.trim(F.lower(raw_title(part))).alias("title"), "p_partkey", "p_size")
            .groupBy("title")
            .agg(F.min(F.concat(F.lit("tt"), F.col("p_partkey").cast("string"))).alias("title_id"),
                 (F.max("p_size") > 25).alias("has_match"))
            .select("title", "title_id", F.lit(None).cast("string").alias("itemset_id"), "has_match",
                    F.lit("2024-01-01 00:00:00").cast("timestamp").alias("match_ts")))


# ------------------------------------------------------------ file fixtures

def _xml_text(s: str) -> str:
    return (s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;"))


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def xlsx_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A minimal .xlsx: one sheet per entry; str cells inline, int/float numeric,
    ``datetime.date`` cells as date-styled serial numbers."""
    import datetime as _dt
    import io as _io
    import zipfile as _zip

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buf = _io.BytesIO()
    with _zip.ZipFile(buf, "w", _zip.ZIP_DEFLATED) as z:
        names = list(sheets)
        z.writestr("[Content_Types].xml", (
            '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
            + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" '
                      'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                      for i in range(len(names)))
            + "</Types>"))
        z.writestr("_rels/.rels", (
            '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
            'Target="xl/workbook.xml"/></Relationships>'))
        z.writestr("xl/workbook.xml", (
            f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
            + "".join(f'<sheet name="{_xml_text(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names))
            + "</sheets></workbook>"))
        z.writestr("xl/_rels/workbook.xml.rels", (
            '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
                      f'Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names)))
            + "</Relationships>"))
        z.writestr("xl/styles.xml", (
            f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{main}">'
            '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>'))
        for i, n in enumerate(names):
            rows = []
            for r, values in enumerate(sheets[n]):
                cells = []
                for c, v in enumerate(values):
                    ref = f"{_col_letters(c)}{r + 1}"
                    if v is None:
                        continue
                    if isinstance(v, _dt.date):
                        serial = (v - _dt.date(1899, 12, 30)).days
                        cells.append(f'<c r="{ref}" s="1"><v>{serial}</v></c>')
                    elif isinstance(v, (int, float)) and not isinstance(v, bool):
                        cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                    else:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{_xml_text(str(v))}</t></is></c>')
                rows.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml",
                       f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{main}"><sheetData>'
                       + "".join(rows) + "</sheetData></worksheet>")
    return buf.getvalue()


ORDER_SHEET_HEADER = ["Order Key", "Status", "Priority", "Total", "Order Date", "Customer"]


WORKBOOK_ROWS = 10_000   # rows a workbook: their number grows with the table, their size does not


def order_workbooks(orders: DataFrame) -> DataFrame:
    """Partner-style workbooks from ``orders``: workbooks of about ``WORKBOOK_ROWS`` rows, one sheet per
    month ("MM.yyyy") plus a "Summary" sheet; two preamble rows, a header, the rows,
    and two footer rows per sheet. Returns (path, content) rows."""
    import pandas as pd

    # spread rows over several workbooks so they are built and read in parallel
    parts = orders.sparkSession.sparkContext.defaultParallelism * 2
    rows = orders.repartition(parts).select(
        F.col("o_orderkey"), "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.to_date("o_orderdate").alias("d"), F.date_format("o_orderdate", "MM.yyyy").alias("sheet"),
        F.concat(F.floor(F.col("o_custkey") / 1000).cast("string"), F.lit(","),
                 F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0")).alias("cust"),
        F.spark_partition_id().alias("pid"))

    def book(pid, n, sheets):
        out = {"Summary": [["report"], ["generated"], ["Total", len(sheets)]]}
        for name, body in sorted(sheets.items()):
            out[name] = [["Partner report"], [f"Month {name}"], ORDER_SHEET_HEADER] + body + \
                        [[None], ["Total rows", len(body)]]
        return pd.DataFrame([(f"orders-{pid:05d}-{n:05d}.xlsx", xlsx_bytes(out))], columns=["path", "content"])

    def build(batches):
        sheets: dict[str, list] = {}
        n = held = pid = 0
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                pid = int(r.pid)
                sheets.setdefault(r.sheet, []).append([int(r.o_orderkey), r.o_orderstatus, r.o_orderpriority,
                                                       float(r.o_totalprice), r.d, r.cust])
                held += 1
                if held >= WORKBOOK_ROWS:
                    yield book(pid, n, sheets)
                    sheets, held, n = {}, 0, n + 1
        if sheets:
            yield book(pid, n, sheets)

    return rows.mapInPandas(build, "path string, content binary")


def part_reports(lineitem: DataFrame) -> DataFrame:
    """Partner reports as (path, content): gzip CSV files of the rows of 64 order keys each. Of five
    files one is cut short and one is no gzip file; some ids are blank."""
    import gzip

    import pyarrow as pa

    row = F.concat(F.when(F.col("l_linenumber") == 2, "").otherwise((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string")), F.lit(', "x\n'), F.col("l_returnflag"), F.lit('"'))
    files = lineitem.groupBy(F.expr("l_orderkey div 64").alias("file")).agg(F.concat_ws("\n", F.lit("id, note"), F.collect_list(row)).alias("text"))

    def pack(batches):
        for batch in batches:
            out = []
            for file, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = gzip.compress(text.encode())
                out.append(data[:len(data) // 2] if file % 5 == 0 else text.encode() if file % 5 == 1 else data)
            paths = [f"report-{f}.csv.gz" for f in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(out, pa.binary())], names=["path", "content"])

    return files.mapInArrow(pack, "path string, content binary")


ARCHIVE_MEMBERS, ARCHIVE_BYTES = 1_000, 8 * 1024 * 1024   # an archive is closed at either: their number grows with the table


def page_archives(pages: DataFrame) -> DataFrame:
    """Archives of page html files, even partitions as .zip, odd ones as .tar.gz: at most ``ARCHIVE_MEMBERS`` members each,
    closed at ``ARCHIVE_BYTES`` of html. Returns (path, content) rows."""
    import io
    import tarfile
    import zipfile

    import pyarrow as pa

    rows = pages.select("page_id", "html", F.spark_partition_id().alias("pid"))

    def build(batches):
        n = members = held = 0
        out = buf = name = None

        def done():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([buf.getvalue()], pa.binary())],
                                              names=["path", "content"])

        for batch in batches:
            # one value at a time: a batch as a list would hold its texts twice
            for page_id, html, pid in zip(*batch.columns):
                if out is None:
                    buf = io.BytesIO()
                    zipped = pid.as_py() % 2 == 0
                    name = f"pages-{pid.as_py():05d}-{n:05d}{'.zip' if zipped else '.tar.gz'}"
                    out = zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) if zipped else tarfile.open(fileobj=buf, mode="w:gz")
                member, data = f"pages/{page_id.as_py()}.html", (html.as_py() or "").encode()
                if zipped:
                    out.writestr(member, data)
                else:
                    info = tarfile.TarInfo(member)
                    info.size = len(data)
                    out.addfile(info, io.BytesIO(data))
                members, held = members + 1, held + len(data)
                if members >= ARCHIVE_MEMBERS or held >= ARCHIVE_BYTES:
                    yield done()
                    n, members, held, out = n + 1, 0, 0, None
        if out is not None:
            yield done()

    return rows.mapInArrow(build, "path string, content binary")


def messages(events: DataFrame) -> DataFrame:
    """Mail-like messages from ``events``: created, sender, subject, attachments."""
    k = F.regexp_extract("props", r"(\d+)", 1)
    eid = F.col("event_id").cast("string")
    return events.select(
        F.col("ts").alias("created"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("sender"),
        F.concat(F.col("event_type"), F.lit(" report")).alias("subject"),
        F.array(F.concat(F.lit("report_"), eid, F.lit(".xlsx")), F.concat(F.lit("note_"), eid, F.lit(".txt")),
                F.concat(F.lit("data_"), k, F.lit(".csv"))).alias("attachments"))
