"""Derived inputs and landed files whose size per file, and shuffles whose width, must not grow with the tables."""

import datetime as dt
import io
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from fernhill.plans import derive
from fernhill.plans.registry import load_all


@pytest.fixture
def lineitem(spark, tmp_path):
    rows = spark.range(700).select(
        F.expr("id div 7 * 50").alias("l_orderkey"), F.expr("id % 7 + 1").alias("l_linenumber"), F.col("id").alias("l_partkey"),
        F.expr("id % 11").alias("l_suppkey"), F.expr("cast(id % 50 AS double)").alias("l_quantity"), F.expr("cast(id AS double)").alias("l_extendedprice"),
        F.expr("substring('ANR', cast(id % 3 AS int) + 1, 1)").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit(dt.datetime(2022, 7, 5)).cast("timestamp_ntz").alias("l_shipdate"))
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_p1_types_the_whole_report(spark, lineitem):
    p1, c5 = (load_all()[n].build(spark, lineitem) for n in ("p1_load_projection", "c5_basic_metrics"))
    assert p1.columns == c5.columns
    assert p1.count() == 700 and p1.exceptAll(c5).count() == 0


def _members(path, content):
    if path.endswith(".zip"):
        return {i.filename: zipfile.ZipFile(io.BytesIO(content)).read(i) for i in zipfile.ZipFile(io.BytesIO(content)).infolist()}
    with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as t:
        return {m.name: t.extractfile(m).read() for m in t}


def test_archives_stay_small(spark):
    pages = spark.range(2_500, numPartitions=2).select(F.col("id").alias("page_id"), F.expr("IF(id % 9 = 0, NULL, concat('<p>', id))").alias("html"))
    found = {}
    for r in derive.page_archives(pages).collect():
        members = _members(r.path, bytes(r.content))
        assert len(members) <= 1_000
        found.update(members)
    assert found == {f"pages/{k}.html": b"" if k % 9 == 0 else f"<p>{k}".encode() for k in range(2_500)}


def test_workbooks_stay_small(spark, monkeypatch):
    monkeypatch.setattr(derive, "WORKBOOK_ROWS", 50, raising=False)
    orders = spark.range(1_000).select(
        F.col("id").alias("o_orderkey"), F.lit("O").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit(1.5).alias("o_totalprice"),
        F.lit(dt.datetime(2022, 7, 5)).cast("timestamp_ntz").alias("o_orderdate"), F.col("id").alias("o_custkey"))
    from fernhill.sources.workbook import read_workbook_cells, sheet_rows

    books = derive.order_workbooks(orders)
    cells = read_workbook_cells(spark, books, header_row=2)
    rows = sheet_rows(cells, sheet_regex=r"\d{2}\.\d{4}", skip=2, skip_footer=2, names=["Order Key"])
    sizes = {r.path: r["count"] for r in rows.groupBy("path").count().collect()}
    assert sum(sizes.values()) == 1_000 and max(sizes.values()) <= 50
    assert rows.select("Order Key").distinct().count() == 1_000


def test_filters_on_parsed_titles_stay_above_the_parse(spark):
    from fernhill.functions.titles import parse_titles

    df = spark.createDataFrame([("a itemset 4",), ("a S01E02 - b",), (None,)], "title string").repartition(2)
    parsed = parse_titles(df.distinct(), "title", "p")
    found = parsed.where(F.col("p.item").isNull() & F.col("p.itemset").isNotNull()).select("title", "p.itemset")
    assert [tuple(r) for r in found.collect()] == [("a itemset 4", 4)]
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(text.split("RLIKE")) + len(text.split("rlike")) <= 4 and parsed.count() == 3


def test_m6_parses_titles_once(spark):
    text = load_all()["m6_rest_title_search"].build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len(text.split("RLIKE")) - 1 <= 2


def test_reports_land_compressed(spark, lineitem):
    from fernhill.plans import queries_loads

    path = queries_loads.land_report(spark, lineitem, "c9")
    names = spark.read.format("binaryFile").load(path).select("path").collect()
    assert names and all(r.path.endswith(".csv.gz") for r in names)


def test_sheet_rows_are_numbered_before_cells_are_written_out(spark, lineitem):
    from fernhill.plans import queries_loads

    text = queries_loads.report_cells(spark, lineitem, "c11")._jdf.queryExecution().optimizedPlan().toString()
    assert "array(" not in text[text.index("Window "):]


def test_big_csv_files_grow_in_number(spark, lineitem, tmp_path, monkeypatch):
    from fernhill.plans import queries_landing
    from fernhill.plans.registry import table, table_state

    size = table_state(spark, lineitem, "lineitem")[2]
    monkeypatch.setattr(queries_landing, "FILE_BYTES", size // 2, raising=False)
    seen = []
    write = queries_landing.write_report_csv
    monkeypatch.setattr(queries_landing, "write_report_csv", lambda df, path: (seen.append(path), write(df, path)))
    r = queries_landing.s3_split_multiline(spark, lineitem)
    assert r.count() == 700 and len(spark.read.text(seen[0]).inputFiles()) == 2
    assert r.select("l_orderkey", "l_linenumber").distinct().count() == table(spark, lineitem, "lineitem").count()
