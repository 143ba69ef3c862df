"""Loads that remember what they have loaded (K4)."""

import os
import threading

import pytest
from pyspark.errors import PySparkException

from fernhill.session import scratch_path
from fernhill.sinks import ledger
from fernhill.sources.readers import read_report_csv
from tests.test_sources_sinks import local, write_text

SCHEMA = "id string, v string"


def loader(spark):
    return lambda names: read_report_csv(spark, names, schema=SCHEMA)


def ids(spark, table):
    return sorted(r.id for r in ledger.read_loads(spark, table, SCHEMA).collect())


def test_a_second_run_adds_nothing_and_a_changed_file_is_loaded_again(spark):
    src, table = scratch_path(spark, "t-landing"), scratch_path(spark, "t-loads")
    write_text(src, "a.csv", "id,v\n1,x\n2,y\n")
    write_text(src, "b.csv", "id,v\n3,z\n")
    first = ledger.load_once(spark, src, table, loader(spark))
    assert ids(spark, table) == ["1", "2", "3"]
    assert ledger.load_once(spark, src, table, loader(spark)) is None
    write_text(src, "c.csv", "id,v\n4,w\n")
    second = ledger.load_once(spark, src, table, loader(spark))
    assert ids(spark, table) == ["1", "2", "3", "4"]
    assert [r.id for r in ledger.read_loads(spark, table, SCHEMA).where(f"load_id = '{second}'").collect()] == ["4"]
    write_text(src, "b.csv", "id,v\n3,z\n5,new\n")
    ledger.load_once(spark, src, table, loader(spark))
    assert ids(spark, table) == ["1", "2", "3", "3", "4", "5"]
    taken = ledger.load_ledger(spark, table).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in taken) == ["a.csv", "b.csv", "b.csv", "c.csv"] and first in {r.load_id for r in taken}


def test_forced_loads_double(spark):
    src, table = scratch_path(spark, "t-landing"), scratch_path(spark, "t-loads")
    write_text(src, "a.csv", "id,v\n1,x\n")
    ledger.load_once(spark, src, table, loader(spark))
    ledger.load_once(spark, src, table, loader(spark), force=True)
    assert ids(spark, table) == ["1", "1"]


def test_a_failed_load_leaves_nothing_to_read(spark):
    src, table = scratch_path(spark, "t-landing"), scratch_path(spark, "t-loads")
    write_text(src, "a.csv", "id,v\n1,x\n")
    with pytest.raises(PySparkException):
        ledger.load_once(spark, src, table, lambda names: loader(spark)(names).selectExpr("id", "raise_error('bad') AS v"))
    assert ids(spark, table) == [] and ledger.load_ledger(spark, table).count() == 0
    ledger.load_once(spark, src, table, loader(spark))
    assert ids(spark, table) == ["1"]


def test_two_loads_that_meet_take_each_file_once(spark):
    src, table = scratch_path(spark, "t-landing"), scratch_path(spark, "t-loads")
    for k in range(4):
        write_text(src, f"f{k}.csv", f"id,v\n{k},x\n")
    both = threading.Barrier(2, timeout=60)
    met = []

    def slow(names):
        if len(met) < 2:
            met.append(len(names))
            both.wait()         # both have seen an empty ledger
        return loader(spark)(names)

    runs = [threading.Thread(target=lambda: ledger.load_once(spark, src, table, slow)) for _ in range(2)]
    for r in runs:
        r.start()
    for r in runs:
        r.join()
    assert met == [4, 4] and ids(spark, table) == ["0", "1", "2", "3"]
    # the second one's folder is there and never read
    assert len([n for n in os.listdir(local(table)) if n.startswith("load=")]) == 2 and len(ledger._entries(spark, table)) == 1
