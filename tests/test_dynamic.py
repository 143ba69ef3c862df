"""Rows as dynamic values by exact name."""

import pytest
from pyspark.sql import functions as F

from fernhill.plans.jobs import load_reports
from fernhill.plans.loads import F_, LoadSpec, load_dynamic
from fernhill.operators.shaping import MissingColumns
from fernhill.session import scratch_path
from fernhill.sources.dynamic import FILE, by_name, dynamic_columns, read_dynamic_csv, read_dynamic_json
from tests.test_sources_sinks import write_text
from tests.test_split_csv import splits_of


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_files_with_different_headers(spark):
    path = scratch_path(spark, "t-dynamic")
    write_text(path, "a.csv", 'id, Views %, it\'s\n1,"5\n0",x\n2,,\n')
    write_text(path, "b.csv", 'it\'s,id\r\n"q ""q""",3\r\n')
    write_text(path, "c.csv", "ID,views %\n4,9\n")
    write_text(path, "d.csv", "\n\nid\n5\n")
    for size in (4, 1 << 20):
        with splits_of(spark, size):
            rows, headers = read_dynamic_csv(spark, path)
            assert sorted(headers) == [["ID", "views %"], ["id"], ["id", "Views %", "it's"], ["it's", "id"]]
            got = rows_of(dynamic_columns(rows, ["id", "Views %", "it's"]).drop(FILE))
        assert got == sorted([("1", "5\n0", "x"), ("2", None, None), ("3", None, 'q "q"'), (None, None, None), ("5", None, None)], key=str)


def test_no_common_schema_is_made(spark):
    """One plan whatever the headers, and the variant is built once a row."""
    path = scratch_path(spark, "t-dynamic")
    write_text(path, "a.csv", "a,b\n1,2\n")
    write_text(path, "b.csv", "b,c\n3,4\n")
    rows, _ = read_dynamic_csv(spark, path)
    df = load_dynamic(rows, LoadSpec("t", (F_("x", "int", "a"), F_("y", "int", "b"), F_("z", "int", "c"))), run_id="r")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_variant_object(") == 1
    assert sorted(((r.x, r.y, r.z) for r in df.collect()), key=str) == [(1, 2, None), (None, 3, 4)]
    assert all(r.source_key.endswith(".csv") for r in df.collect())


def test_json_lines_with_any_fields(spark):
    path = scratch_path(spark, "t-dynamic")
    write_text(path, "a.json", '{"id": 1, "note": "x"}\n{"note": {"deep": 2}, "ID": 7}\n{"id": "two"}\n')
    rows = read_dynamic_json(spark, path)
    assert rows_of(rows.select(by_name("row", "id"), by_name("row", "id", "int"))) == sorted([("1", 1), (None, None), ("two", None)], key=str)


def test_names_that_cannot_be_asked_for(spark):
    with pytest.raises(ValueError, match="both kinds"):
        by_name("row", "a'b\"c")
    path = scratch_path(spark, "t-dynamic")
    write_text(path, "a.csv", "a,a\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_dynamic_csv(spark, path)


def test_load_job_takes_files_as_their_headers_come(spark):
    spec = LoadSpec("t", (F_("id", "int", "id", "Id"), F_("views", "number", "views")))
    src, out = scratch_path(spark, "t-dynamic"), scratch_path(spark, "t-dynamic-out")
    write_text(src, "a.csv", "id,views\n1,10\n")
    write_text(src, "b.csv", "views,Id,more\n20,2,x\n")
    load_reports(spark, src, spec, out, run_id="r1", any_header=True)
    assert rows_of(spark.read.parquet(out).select("id", F.col("views").cast("int"))) == [(1, 10), (2, 20)]
    write_text(src, "c.csv", "id\n3\n")
    with pytest.raises(MissingColumns):
        load_reports(spark, src, spec, out, run_id="r2", any_header=True)
    load_reports(spark, src, spec, out, run_id="r2", any_header=True, required=())
    assert spark.read.parquet(out).where("run_id = 'r2'").count() == 3
