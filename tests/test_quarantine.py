"""Unreadable report files and archives are set aside whole, with a ledger."""

import gzip
import io
import tarfile
import zipfile

import pytest
from pyspark.errors import PySparkException

from fernhill.session import scratch_path
from fernhill.sources.archive import archive_errors, read_archive_members
from fernhill.sources.quarantine import UnreadableFile, file_ledger, good_rows, read_outcomes, rejects, report_rows, unique_report_ids
from tests.test_sources_sinks import local


def land(spark, files):
    import os

    path = scratch_path(spark, "t-reports")
    os.makedirs(local(path), exist_ok=True)
    for name, content in files.items():
        with open(f"{local(path)}/{name}", "wb") as f:
            f.write(content)
    return path


def report(ids, head="id, note"):
    return (head + "\n" + "".join(f'{i},"n\n{i}"\n' for i in ids)).encode()


def test_bad_files_among_good_ones(spark):
    whole = gzip.compress(report(range(1000, 3000)))
    path = land(spark, {
        "a.csv": report([1, 2, 2]), "b.csv.gz": gzip.compress(report(range(10, 30))), "c.csv": b"note,id\nx,7\ny,\n",
        "cut.csv.gz": whole[:len(whole) // 2], "junk.csv.gz": b"this is no gzip file", "blank.csv": b"\n", "header.csv": b"id,note\n"})
    ids, ledger = unique_report_ids(spark, path, "id")
    assert sorted(int(r.id) for r in ids.collect()) == [1, 2, 7, *range(10, 30)]      # nothing of the truncated file
    told = {r.path.rsplit("/", 1)[1]: (r.status, r.n_rows, r.reason) for r in ledger.collect()}
    assert told == {"a.csv": ("read", 3, None), "b.csv.gz": ("read", 20, None), "c.csv": ("read", 2, None), "header.csv": ("read", 0, None),
                    "cut.csv.gz": ("rejected", 0, "truncated gzip"), "junk.csv.gz": ("rejected", 0, "not gzip"), "blank.csv": ("rejected", 0, "no header")}


def test_expected_files_that_never_came(spark):
    path = land(spark, {"a.csv": report([1])})
    outcomes = read_outcomes(spark, path)
    seen = outcomes.first().path
    expected = spark.createDataFrame([(seen,), (seen.replace("a.csv", "b.csv"),)], "path string")
    told = {r.path.rsplit("/", 1)[1]: (r.status, r.n_rows) for r in file_ledger(outcomes, expected).collect()}
    assert told == {"a.csv": ("read", 1), "b.csv": ("missing", 0)}
    assert rejects(outcomes).count() == 0
    assert [tuple(r)[1:] for r in good_rows(outcomes, ["note", "absent"]).collect()] == [(1, "n\n1", None)]


@pytest.mark.parametrize("content,reason", [
    (b"a,b\n1,\0\n", "binary data"), (b"a,b\n\xff\xfe,1\n", "not UTF-8"), (b'a,b\n"open,1\n', "not CSV"), (b"a,b\n1,2,3\n", "more fields"),
    (b"b\n1\n", "no column a"), (b"a,a\n1,2\n", "twice"), (b"\n\n", "no header")])
def test_reasons(content, reason):
    with pytest.raises(UnreadableFile, match=reason):
        report_rows("x.csv", content, ("a",))


def test_short_rows_and_byte_order_marks():
    assert report_rows("x.csv", "﻿a, b\n1\n\n 2, 3\n".encode()) == [{"a": "1"}, {"a": "2", "b": "3"}]


def test_many_rows_travel_in_batches(spark):
    path = land(spark, {"big.csv": report(range(25_000))})
    outcomes = read_outcomes(spark, path)
    assert outcomes.where("row > 0").count() == 25_000 and file_ledger(outcomes).first().n_rows == 25_000


def archives():
    z, t = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(z, "w", zipfile.ZIP_DEFLATED) as f:
        f.writestr("one.txt", b"1" * 5000)
        f.writestr("two.txt", bytes(range(256)) * 20)
    with tarfile.open(fileobj=t, mode="w:gz") as f:
        for n in range(3):
            data = bytes(range(256)) * 50
            info = tarfile.TarInfo(f"m{n}")
            info.size = len(data)
            f.addfile(info, io.BytesIO(data))
    return z.getvalue(), t.getvalue()


def test_bad_archives_are_set_aside_whole(spark):
    z, t = archives()
    spoilt = bytearray(z)
    spoilt[60] ^= 0xFF                                # a wrong checksum in the first member
    path = land(spark, {"a.zip": z, "b.tar.gz": t, "junk.zip": b"no archive", "cut.tar.gz": t[:len(t) // 2], "crc.zip": bytes(spoilt), "plain.txt": b"text"})
    got = sorted((r.archive.rsplit("/", 1)[1], r.member) for r in read_archive_members(spark, path, skip_bad=True).select("archive", "member").collect())
    assert got == [("a.zip", "one.txt"), ("a.zip", "two.txt"), ("b.tar.gz", "m0"), ("b.tar.gz", "m1"), ("b.tar.gz", "m2"), ("plain.txt", "plain.txt")]
    assert sorted(r.path.rsplit("/", 1)[1] for r in archive_errors(spark, path).collect()) == ["crc.zip", "cut.tar.gz", "junk.zip"]
    with pytest.raises(PySparkException):
        read_archive_members(spark, path).collect()
