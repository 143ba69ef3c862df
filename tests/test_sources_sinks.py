"""Readers (S1, S3, S5, S6, S9, S11), writers (K4) and incremental pickup."""

import datetime as dt
import io
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from fernhill.operators.shaping import MissingColumns, keep_columns, require_columns
from fernhill.plans.derive import xlsx_bytes
from fernhill.session import scratch_path
from fernhill.sinks.writers import append_load, write_report_csv
from fernhill.sources.archive import read_archive_members
from fernhill.sources.files import select_attachments, select_files
from fernhill.sources.readers import read_access_log, read_report_csv
from fernhill.sources.workbook import parse_usecols, read_workbook_cells, sheet_rows
from fernhill.streaming.incremental import load_new_files


def local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def write_text(path: str, name: str, text: str):
    import os

    os.makedirs(local(path), exist_ok=True)
    with open(f"{local(path)}/{name}", "w") as f:
        f.write(text)


def test_access_log_comments_and_short_rows(spark):
    p = scratch_path(spark, "t-log")
    write_text(p, "a.log", "#Version: 1.0\n#Fields: ...\n2024-01-01\t10:00:00\tGET\t1.2.3.4\n"
                           "2024-01-01\t10:00:01\tGET\t1.2.3.5\tHTTP/1.1\t-\tagent\tnotanint\n")
    df = read_access_log(spark, p)
    rows = df.orderBy("time").collect()
    assert len(rows) == 2
    assert rows[0].c_ip == "1.2.3.4" and rows[0].cs_uri_stem is None
    assert rows[1].cs_user_agent == "agent" and rows[1].filesize is None


def test_report_csv_header_na_and_empty(spark):
    p = scratch_path(spark, "t-csv")
    write_text(p, "r.csv", 'a, b, "c d"\n1, NA, "x"\n2,,y\n')
    df = read_report_csv(spark, p)
    assert df.columns == ["a", "b", "c d"]
    rows = sorted(map(tuple, df.collect()))
    assert rows == [("1", "NA", "x"), ("2", None, "y")]
    df2 = read_report_csv(spark, p, na_values=["NA"])
    assert sorted(map(tuple, df2.collect()))[0] == ("1", None, "x")


def test_report_csv_standard_quoting(spark):
    p = scratch_path(spark, "t-quote")
    write_text(p, "r.csv", 'a,n\n"a ""b"" c, d",1\n"two\nlines",2\n"back\\slash\\",3\n')
    assert sorted(map(tuple, read_report_csv(spark, p, multiline=True).collect())) == [
        ('a "b" c, d', "1"), ("back\\slash\\", "3"), ("two\nlines", "2")]


TEXTS = ['say "hi", x', "two\nlines", "cr\r\nlf", "back\\slash\\", '"', "trail  ", "plain", "# no comment", None]


def test_report_csv_round_trip(spark):
    p = scratch_path(spark, "t-trip")
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(TEXTS)], "k string, v string")
    write_report_csv(df, p, rows_per_file=2)
    got = read_report_csv(spark, p, schema="k string, v string", multiline=True)
    assert sorted(map(tuple, got.collect())) == [(str(i), v) for i, v in enumerate(TEXTS)]


def test_report_csv_rejects(spark):
    p = scratch_path(spark, "t-bad")
    write_text(p, "r.csv", "a,b\n1,2\n3\n4,5,6\n")
    df = read_report_csv(spark, p, corrupt_col="bad", na_values=["2"])
    assert sorted(map(tuple, df.collect())) == [("1", None, None), ("3", None, "3"), ("4", "5", "4,5,6")]


def test_require_and_keep_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `Completion %` int")
    assert keep_columns(df, ["Completion %"]).columns == ["Completion %"]
    with pytest.raises(MissingColumns):
        require_columns(df, ["a", "completion %"])


def test_usecols():
    assert parse_usecols("A:C,E,AA") == [0, 1, 2, 4, 26]


def test_workbook_reader_options(spark):
    book = xlsx_bytes({
        "Summary": [["x"]],
        "05.2022": [["Report"], ["skip me"], ["Name", "Qty", "Skip", "Day"],
                    ["a", "1,234", "z", dt.date(2022, 5, 3)], ["b", "7", "z", dt.date(2022, 5, 4)],
                    ["Total", "1,241"]],
        "06.2022": [["Report"], ["skip me"], ["Name", "Qty", "Skip", "Day"], ["c", "2", "z", None],
                    ["Total", "2"]],
    })
    files = spark.createDataFrame([("book.xlsx", bytearray(book))], "path string, content binary")
    for header_row in (None, 2):
        cells = read_workbook_cells(spark, files, header_row=header_row)
        rows = sheet_rows(cells, sheet_regex=r"\d{2}\.\d{4}", skip=2, skip_footer=1, usecols="A:B,D",
                          thousands=",", names=["Name", "Qty", "Day"])
        got = sorted((r.sheet, r.Name, r.Qty, r.Day) for r in rows.collect())
        assert got == [("05.2022", "a", "1234", "2022-05-03 00:00:00"), ("05.2022", "b", "7", "2022-05-04 00:00:00"),
                       ("06.2022", "c", "2", None)], header_row
    one = sheet_rows(read_workbook_cells(spark, files), sheet=0, header=0)
    assert one.columns == ["path", "sheet", "row", "cells"] and one.count() == 0


def test_sheets_are_chosen_by_the_start_of_their_names(spark):
    """Several regexes; headers that differ, repeat or are blank; no names given."""
    def sheet(name, i, *lines):
        return [("b.xlsx", name, i, n, len(lines) - 1, list(c)) for n, c in enumerate(lines)]

    cells = spark.createDataFrame(
        sheet("01.2022 final", 0, ("Name", "Qty", "Qty", None), ("a", "1", "2", "3"), ("b",))
        + sheet("Extra", 1, (" Name ", "Day"), ("c", "d")) + sheet("x 02.2022", 2, ("Name",), ("e",)),
        "path string, sheet string, sheet_index int, row int, last_row int, cells array<string>")
    chosen = [r"\d{2}\.\d{4}", "Ext"]
    named = sheet_rows(cells, sheet_regex=chosen, names=["Name", "Qty", "Day"])
    assert sorted(((r.sheet, r.Name, r.Qty, r.Day) for r in named.collect()), key=str) == [
        ("01.2022 final", "a", "1", None), ("01.2022 final", "b", None, None), ("Extra", "c", None, "d")]
    mapped = sheet_rows(cells, sheet_regex=chosen)
    assert sorted((r.sheet, sorted(r.cells.items(), key=str)) for r in mapped.collect()) == [
        ("01.2022 final", [("Name", "a"), ("Qty", "1")]), ("01.2022 final", [("Name", "b"), ("Qty", None)]),
        ("Extra", [("Day", "d"), ("Name", "c")])]


def test_sheets_load_by_a_spec(spark):
    """Footer rows, a misspelt header in one of two books, a header that is absent."""
    from fernhill.plans.loads import F_, LoadSpec, Period, load_sheets

    def book(path, *lines):
        return [(path, "Sheet1", 0, n, len(lines) - 1, list(c)) for n, c in enumerate(lines)]

    cells = spark.createDataFrame(
        book("a.xlsx", ("Title", "Share"), ("t1", "1.5"), ("Total", "1.5"))
        + book("b.xlsx", ("Share", "Tittle"), ("2.5", "t2"), ("9", "Total")),
        "path string, sheet string, sheet_index int, row int, last_row int, cells array<string>")
    spec = LoadSpec("s", (F_("title", "text", "Title", "Tittle"), F_("share", "float", "Share"), F_("units", "int", "Units")),
                    Period("params"))
    out = load_sheets(cells, spec, run_id="r", start="2024-01-01", end="2024-01-08", sheet=0, skip_footer=1)
    assert sorted((r.title, r.share, r.units, r.source_key, r.run_id) for r in out.collect()) == [
        ("t1", 1.5, None, "a.xlsx", "r"), ("t2", 2.5, None, "b.xlsx", "r")]


def test_archive_members(spark):
    zbuf = io.BytesIO()
    with zipfile.ZipFile(zbuf, "w") as z:
        z.writestr("a.csv", "x")
        z.writestr("dir/b.csv", "yy")
    tbuf = io.BytesIO()
    with tarfile.open(fileobj=tbuf, mode="w:gz") as t:
        info = tarfile.TarInfo("c.log")
        info.size = 3
        t.addfile(info, io.BytesIO(b"zzz"))
    files = spark.createDataFrame([("in/a.zip", bytearray(zbuf.getvalue())), ("in/t.tar.gz", bytearray(tbuf.getvalue())),
                                   ("in/plain.csv", bytearray(b"pp"))], "path string, content binary")
    got = sorted((r.archive, r.member, r.size, bytes(r.content)) for r in read_archive_members(spark, files).collect())
    assert got == [("in/a.zip", "a.csv", 1, b"x"), ("in/a.zip", "dir/b.csv", 2, b"yy"),
                   ("in/plain.csv", "plain.csv", 2, b"pp"), ("in/t.tar.gz", "c.log", 3, b"zzz")]


def test_select_files_and_attachments(spark):
    m = spark.createDataFrame([("s3://b/x/2022_Q3_TRC.xlsx",), ("s3://b/y/notes.txt",), ("s3://b/x/2022_Q3_TRC.xlsx",)],
                              "path string")
    assert [r.path for r in select_files(m, [r".*TRC.*\.xlsx"]).collect()] == ["s3://b/x/2022_Q3_TRC.xlsx"]
    assert select_files(m).count() == 2
    msgs = spark.createDataFrame([
        (dt.datetime(2024, 1, 2), "ops@partner.com", "trc_stage", ["r.xlsx", "n.txt"]),
        (dt.datetime(2024, 1, 9), "ops@partner.com", "trc_stage", ["late.xlsx"]),
        (dt.datetime(2024, 1, 2), "x@other.com", "trc_stage", ["o.xlsx"])],
        "created timestamp_ntz, sender string, subject string, attachments array<string>")
    out = select_attachments(msgs, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5), sender="partner",
                             subject="trc", suffixes=[".xlsx"])
    assert [r.attachment for r in out.collect()] == ["r.xlsx"]


def test_idempotent_load(spark):
    p = scratch_path(spark, "t-load")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    append_load(df, p, run_id="r1", idempotent=True)
    append_load(df, p, run_id="r1", idempotent=True)
    assert spark.read.parquet(p).count() == 2
    append_load(df, p, run_id="r2", idempotent=True)
    assert spark.read.parquet(p).count() == 4


def test_incremental_equals_batch(spark):
    root = scratch_path(spark, "t-incr")
    schema = "a string, b string"
    df = spark.range(100).select(F.col("id").cast("string").alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    df.where("b = '0'").write.option("header", True).csv(f"{root}/in/d1")
    opts = {"header": "true", "recursiveFileLookup": "true"}
    load_new_files(spark, f"{root}/in", schema, f"{root}/out", f"{root}/ck", options=opts)
    load_new_files(spark, f"{root}/in", schema, f"{root}/out", f"{root}/ck", options=opts)
    df.where("b <> '0'").write.option("header", True).csv(f"{root}/in/d2")
    load_new_files(spark, f"{root}/in", schema, f"{root}/out", f"{root}/ck", options=opts)
    got = sorted(map(tuple, spark.read.parquet(f"{root}/out").collect()))
    assert got == sorted(map(tuple, df.collect()))


def test_workbook_errors_output(spark):
    from fernhill.sources.workbook import workbook_errors

    good = xlsx_bytes({"S": [["a"], ["1"]]})
    files = spark.createDataFrame([("good.xlsx", bytearray(good)), ("bad.xlsx", bytearray(b"not a zip"))],
                                  "path string, content binary")
    rows = workbook_errors(spark, files).collect()
    assert [r.path for r in rows] == ["bad.xlsx"] and "BadZipFile" in rows[0].error
