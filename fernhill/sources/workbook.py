"""Workbook reader (S5): ``.xlsx`` files -> a cells table, then sheet options as column work.

``read_workbook_cells`` turns each workbook into rows of
``(path, sheet, sheet_index, row, last_row, cells array<string>)``: one row per
sheet row, cell texts by column position. It runs as ``mapInArrow`` over
``binaryFile`` rows -- each workbook parsed inside one task, streamed with
``iterparse`` and emitted in Arrow batches -- so workbooks are read in parallel
and never pass through the driver. Only the standard library is used (no spreadsheet package is needed).

``sheet_rows`` then applies the reader options the partner flows use (sheet by
name / index / regex, skipped rows, header row, footer rows, column ranges
like ``"A:G,I,K"``, thousands marks) as filters and projections.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from functools import reduce
from operator import or_
from xml.etree import ElementTree as ET

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS_SCHEMA = "path string, sheet string, sheet_index int, row int, last_row int, cells array<string>"
HEADER_FIELD = ", header array<string>"
ERRORS_SCHEMA = "path string, error string"

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
# built-in number formats that show dates / times
_DATE_FORMATS = set(range(14, 23)) | {45, 46, 47}
_EPOCH = datetime(1899, 12, 30)
_BATCH = 10_000


def col_index(letters: str) -> int:
    """"A" -> 0, "Z" -> 25, "AA" -> 26."""
    n = 0
    for ch in letters.upper():
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def parse_usecols(spec: str) -> list[int]:
    """"A:G,I,K,M" -> [0..6, 8, 10, 12]."""
    out: list[int] = []
    for part in spec.split(","):
        part = part.strip()
        if ":" in part:
            a, b = part.split(":")
            out.extend(range(col_index(a), col_index(b) + 1))
        elif part:
            out.append(col_index(part))
    return out


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    for _, el in ET.iterparse(z.open("xl/sharedStrings.xml")):
        if el.tag == _M + "si":
            out.append("".join(t.text or "" for t in el.iter(_M + "t")))
            el.clear()
    return out


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles whose number format shows a date or time."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {}
    for nf in root.iterfind("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
        custom[int(nf.get("numFmtId"))] = bool(re.search(r"[dmyhs]", code))
    out = set()
    for i, xf in enumerate(root.iterfind("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_FORMATS or custom.get(fid, False):
            out.add(i)
    return out


def _serial_text(v: str) -> str:
    ts = _EPOCH + timedelta(days=float(v))
    ts = ts.replace(microsecond=0) if ts.microsecond < 500_000 else (ts + timedelta(seconds=1)).replace(microsecond=0)
    return ts.strftime("%Y-%m-%d %H:%M:%S")


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, part name) in workbook order."""
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels}
    out = []
    for s in wb.iterfind("m:sheets/m:sheet", _NS):
        t = target[s.get(_REL)].lstrip("/")
        out.append((s.get("name"), t if t.startswith("xl/") else "xl/" + t))
    return out


_REF = re.compile(r"([A-Za-z]+)(\d*)")
_ROW, _C, _V, _IS, _T = _M + "row", _M + "c", _M + "v", _M + "is", _M + "t"


def _last_row(z: zipfile.ZipFile, part: str) -> int:
    """0-based index of the last row that holds a value (a light first pass)."""
    last, seq = -1, 0
    for _, el in ET.iterparse(z.open(part)):
        if el.tag == _ROW:
            r = el.get("r")
            idx = int(r) - 1 if r else seq
            seq = idx + 1
            if any(c.find(_V) is not None or c.find(_IS) is not None for c in el):
                last = idx
            el.clear()
    return last


def workbook_rows(path: str, content: bytes, header_row: int | None = None) -> Iterator[tuple]:
    """Rows of every sheet: (path, sheet, sheet index, row index, last row index,
    cell texts, header cells). The row index is the Excel row number - 1, so
    blank rows count as they do in the sheet. ``header`` is the cells of row
    ``header_row`` of the same sheet for the rows after it (else null). The last
    row index comes from a light first pass, so rows stream out in batches."""
    z = zipfile.ZipFile(io.BytesIO(content))
    strings = _shared_strings(z)
    dates = _date_styles(z)
    for si, (name, part) in enumerate(_sheets(z)):
        last = _last_row(z, part)
        head = None
        seq = 0
        for _, el in ET.iterparse(z.open(part)):
            if el.tag != _ROW:
                continue
            r = el.get("r")
            r_i = int(r) - 1 if r else seq
            seq = r_i + 1
            cells: dict[int, str | None] = {}
            nxt = 0
            for c in el:
                if c.tag != _C:
                    continue
                ref = c.get("r")
                idx = col_index(_REF.match(ref).group(1)) if ref else nxt
                nxt = idx + 1
                t = c.get("t")
                if t == "inlineStr":
                    text = "".join(x.text or "" for x in c.iter(_T))
                else:
                    v = c.find(_V)
                    if v is None or v.text is None:
                        text = None
                    elif t == "s":
                        text = strings[int(v.text)]
                    elif t == "b":
                        text = "TRUE" if v.text == "1" else "FALSE"
                    elif t in ("str", "e"):
                        text = v.text
                    elif dates and int(c.get("s", "0")) in dates:
                        text = _serial_text(v.text)
                    else:
                        text = v.text
                cells[idx] = text
            width = max(cells) + 1 if cells else 0
            values = [cells.get(i) for i in range(width)]
            yield path, name, si, r_i, last, values, head
            if header_row is not None and r_i == header_row:
                head = values
            el.clear()


def _cells_batches(header_row):
    """Arrow batches of cell rows (``mapInArrow``: lists go straight to Arrow, no pandas)."""
    import pyarrow as pa

    fields = [pa.field("path", pa.string()), pa.field("sheet", pa.string()), pa.field("sheet_index", pa.int32()),
              pa.field("row", pa.int32()), pa.field("last_row", pa.int32()),
              pa.field("cells", pa.list_(pa.string()))]
    if header_row is not None:
        fields.append(pa.field("header", pa.list_(pa.string())))
    schema = pa.schema(fields)
    width = len(fields)

    def flush(buf):
        return pa.RecordBatch.from_arrays([pa.array(col, type=f.type) for col, f in zip(zip(*buf), fields)],
                                          schema=schema)

    def run(batches):
        for batch in batches:
            # one value at a time: a batch as a list would hold its contents twice
            for path, content in zip(batch.column("path"), batch.column("content")):
                buf = []
                for row in workbook_rows(path.as_py(), content.as_py(), header_row):
                    buf.append(row[:width])
                    if len(buf) >= _BATCH:
                        yield flush(buf)
                        buf = []
                if buf:
                    yield flush(buf)

    return run


def read_workbook_cells(spark: SparkSession, path: str | DataFrame, glob: str = "*.xlsx",
                        header_row: int | None = None) -> DataFrame:
    """Workbooks under ``path`` (or a DataFrame of ``path, content``) -> cells table.

    With ``header_row`` (0-based, counted from the top of the sheet) each row
    after it carries that row's cells as ``header``; ``sheet_rows`` then needs no
    second pass to name the columns.
    """
    if isinstance(path, DataFrame):
        files = path.select("path", "content")
    else:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", True).load(path).select("path", "content"))
    # each file is one binaryFile row, parsed whole inside one task
    schema = CELLS_SCHEMA + (HEADER_FIELD if header_row is not None else "")
    return files.mapInArrow(_cells_batches(header_row), schema)


def _thousands(c: Column, mark: str) -> Column:
    plain = F.regexp_replace(c, re.escape(mark), "")
    looks_numeric = c.rlike(r"^\s*-?[0-9][0-9" + re.escape(mark) + r"]*(\.[0-9]+)?\s*$")
    return F.when(looks_numeric, plain).otherwise(c)


def sheet_rows(cells: DataFrame, sheet: str | int | None = None, sheet_regex: str | Sequence[str] | None = None,
               header: int | None = 0, skip: int = 0, skip_footer: int = 0,
               usecols: str | Sequence[int] | None = None, thousands: str | None = None,
               names: Sequence[str] | None = None) -> DataFrame:
    """S5 options as column work. Returns (path, sheet, row, <named text columns>).

    Sheet choice: by name, by index, by one or more regexes that match the start of
    the sheet's name, or all. ``skip`` rows are dropped, row ``header`` (counted
    after the skip) names the columns, ``skip_footer`` last rows of each sheet are
    dropped, ``usecols`` keeps column positions (Excel letters allowed),
    ``thousands`` removes the mark from numeric-looking cells.

    ``names`` are the header names to turn into columns; one that a sheet lacks is
    null there. Without them the result has one column ``cells``, a map from header
    name to cell: headers differ between sheets, and finding them all would be a job
    of its own. Blank header names and the later of two equal ones are left out.
    """
    df = cells
    if isinstance(sheet, int):
        df = df.where(F.col("sheet_index") == sheet)
    elif isinstance(sheet, str):
        df = df.where(F.col("sheet") == sheet)
    if sheet_regex:
        starts = [sheet_regex] if isinstance(sheet_regex, str) else sheet_regex
        df = df.where(reduce(or_, [F.col("sheet").rlike(f"^(?:{x})") for x in starts]))
    df = df.where(F.col("row") >= skip)
    if skip_footer:
        df = df.where(F.col("row") <= F.col("last_row") - skip_footer)
    idx = parse_usecols(usecols) if isinstance(usecols, str) else (list(usecols) if usecols else None)

    def cut(c: Column) -> Column:
        return F.array(*[F.try_element_at(c, F.lit(i + 1)) for i in idx]) if idx is not None else c

    cells_c = cut(F.col("cells"))
    if thousands:
        cells_c = F.transform(cells_c, lambda c: _thousands(c, thousands))
    if header is None:
        if not names:
            raise ValueError("without a header row, give names")
        return df.select("path", "sheet", "row", *[F.try_element_at(cells_c, F.lit(i + 1)).alias(n)
                                                   for i, n in enumerate(names)])
    head_row = skip + header
    if "header" in df.columns:
        # the reader attached the header row of each sheet (see read_workbook_cells)
        body = df.where((F.col("row") > head_row) & F.col("header").isNotNull()) \
            .select("path", "sheet", "row", cells_c.alias("cells"), cut(F.col("header")).alias("_head"))
    else:
        # one header row a sheet; how they meet the rows is left to Spark's own size check
        heads = df.where(F.col("row") == head_row).select("path", "sheet", cut(F.col("cells")).alias("_head"))
        body = df.where(F.col("row") > head_row).select("path", "sheet", "row", cells_c.alias("cells")) \
            .join(heads, ["path", "sheet"])
    trimmed = F.transform("_head", lambda h: F.coalesce(F.trim(h), F.lit("")))
    if names is None:
        known = F.filter(trimmed, lambda h, i: (h != "") & (F.array_position(trimmed, h) == i + 1))
        pairs = F.transform(known, lambda h: F.struct(h, F.try_element_at("cells", F.array_position(trimmed, h).cast("int"))))
        return body.select("path", "sheet", "row", F.map_from_entries(pairs).alias("cells"))

    def pick(n: str) -> Column:
        pos = F.array_position(trimmed, F.lit(n)).cast("int")
        return F.when(pos > 0, F.try_element_at("cells", pos)).alias(n)

    return body.select("path", "sheet", "row", *[pick(n) for n in names])


def workbook_errors(spark: SparkSession, path: str | DataFrame, glob: str = "*.xlsx") -> DataFrame:
    """Workbooks that cannot be opened, one row each (path, error), kept apart
    from the data instead of turning into rows with an error column."""

    def check(batches):
        import pyarrow as pa

        schema = pa.schema([pa.field("path", pa.string()), pa.field("error", pa.string())])
        for batch in batches:
            bad = []
            # one value at a time: a batch as a list would hold its contents twice
            for p, content in zip(batch.column("path"), batch.column("content")):
                try:
                    _sheets(zipfile.ZipFile(io.BytesIO(content.as_py())))
                except Exception as e:  # noqa: BLE001 - any failure to open is reported
                    bad.append((p.as_py(), f"{type(e).__name__}: {e}"))
            if bad:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*bad)], schema=schema)

    if isinstance(path, DataFrame):
        files = path.select("path", "content")
    else:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", True).load(path).select("path", "content"))
    return files.mapInArrow(check, ERRORS_SCHEMA)
