"""Big CSV files with line breaks in fields, cut by quote parity."""

import contextlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from fernhill.session import scratch_path
from fernhill.sources.readers import read_report_csv
from fernhill.sources.split_csv import UnbalancedQuotes, _lines, quote_ranges, read_split_csv
from tests.test_sources_sinks import write_text


@contextlib.contextmanager
def splits_of(spark, size):
    """Files are split into ranges of ``size`` bytes."""
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def big_file(spark, rows=3000, seed=1):
    rng = np.random.default_rng(seed)
    path = scratch_path(spark, "t-split")
    notes = ['plain', '"with ""quotes"", and commas"', '"two\nlines"', '"\n\n"', '""', '', '"back\\slash\\"', '"' + "long\n" * 300 + '"', '"a ""\n"" b"']
    text = " id, note,  n\n" + "".join(f"{k},{notes[int(rng.integers(len(notes)))]},{k % 7}\n" + "\n" * (k % 50 == 0) for k in range(rows))
    write_text(path, "big.csv", text)
    return path


def test_many_tasks_read_what_one_task_reads(spark):
    path = big_file(spark)
    want = rows_of(read_report_csv(spark, path, multiline=True))
    with splits_of(spark, 4000):
        df = read_split_csv(spark, path)
        assert df.columns == ["id", "note", "n"]
        ranges = quote_ranges(_lines(spark, path, None)).collect()
        assert len(ranges) > 20 and any(r.inside for r in ranges) and any(not r.inside for r in ranges)
        assert rows_of(df) == want
        # no exchange on the way of whole records; each range is a task of its own
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert read_split_csv(spark, path).select("id").count() == 3000
    whole = plan.split("Union", 1)[1]
    assert "MapInArrow" in whole and whole.index("MapInArrow") < whole.index("Exchange")
    assert rows_of(read_split_csv(spark, path)) == want          # one range


def test_records_longer_than_ranges(spark):
    path = scratch_path(spark, "t-split")
    write_text(path, "a.csv", 'a,b\n1,"' + "x\n" * 5000 + '"\n2,y\n')
    write_text(path, "b.csv", 'a,b\n3,"' + "\n" * 900 + '"\n')
    with splits_of(spark, 500):
        got = {r.a: r.b for r in read_split_csv(spark, path).collect()}
    assert got == {"1": "x\n" * 5000, "2": "y", "3": "\n" * 900}


def test_source_column_na_values_and_corrupt_rows(spark):
    path = scratch_path(spark, "t-split")
    write_text(path, "one.csv", 'a,b\n1,NA\n"2\n2",x,extra\n3\n')
    write_text(path, "two.csv", "a,b\n4,y\n")
    with splits_of(spark, 6):
        df = read_split_csv(spark, path, na_values=["NA"], source_col="src", corrupt_col="bad")
        got = {r.a: (r.b, r.bad, r.src.rsplit("/", 1)[1]) for r in df.collect()}
    assert got == {"1": (None, None, "one.csv"), "2\n2": ("x", '"2\n2",x,extra', "one.csv"), "3": (None, "3", "one.csv"), "4": ("y", None, "two.csv")}


def test_headers_must_agree_when_asked(spark):
    path = scratch_path(spark, "t-split")
    write_text(path, "one.csv", "a, b\n1,2\n")
    write_text(path, "two.csv", "a,b\n3,4\n")
    assert rows_of(read_split_csv(spark, path, same_header=True)) == [("1", "2"), ("3", "4")]
    write_text(path, "three.csv", "b,a\n5,6\n")
    with pytest.raises(PySparkException, match="header differs"):
        read_split_csv(spark, path, same_header=True).collect()


def test_unbalanced_quotes_fail_by_name(spark):
    path = scratch_path(spark, "t-split")
    write_text(path, "good.csv", 'a\n"x"\n')
    write_text(path, "odd.csv", 'a\n"x\n')
    with pytest.raises(UnbalancedQuotes, match="odd.csv"):
        read_split_csv(spark, path)


def test_windows_line_ends(spark):
    path = scratch_path(spark, "t-split")
    write_text(path, "w.csv", 'a,b\r\n1,"x ""y"""\r\n\r\n2,z\r\n')
    with splits_of(spark, 5):
        assert rows_of(read_split_csv(spark, path)) == [("1", 'x "y"'), ("2", "z")]


field = st.text(alphabet=st.sampled_from('ab",\n\\ '), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(field, field), min_size=1, max_size=25), st.integers(3, 60))
def test_any_fields_come_back(spark, rows, size):
    path = scratch_path(spark, "t-split")
    quoted = lambda v: '"' + v.replace('"', '""') + '"'
    write_text(path, "f.csv", "k,a,b\n" + "".join(f"{k},{quoted(a)},{quoted(b)}\n" for k, (a, b) in enumerate(rows)))
    with splits_of(spark, size):
        got = {int(r.k): (r.a, r.b) for r in read_split_csv(spark, path).select("k", "a", "b").collect()}
    want = {int(r.k): (r.a, r.b) for r in read_report_csv(spark, path, multiline=True).collect()}
    assert got == want and len(got) == len(rows)
    assert got == {k: (a or None, b or None) for k, (a, b) in enumerate(rows)} or any(v != v.strip() for r in rows for v in r)
