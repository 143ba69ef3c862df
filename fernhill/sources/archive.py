"""Archive members (S6): zip / tar / tar.gz files -> (archive, member, content) rows.

``binaryFile`` + ``mapInArrow``: each archive is opened inside one task and
its members are emitted in Arrow batches (at most 1,000 members or 8 MB per
batch), so archives are unpacked in parallel and nothing passes through the
driver. A file that is not an archive (by suffix)
is passed on as its own single member. A member that a binary value cannot
hold (2 GB) fails the job.

An archive that cannot be read fails the job as well, unless ``skip_bad`` is set: then each
archive is read through once before its members are emitted, a bad one gives no member at
all, and ``archive_errors`` lists it with the reason.
"""

from __future__ import annotations

import io
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

MEMBERS_SCHEMA = "archive string, member string, size long, content binary"
_BATCH_BYTES = 8 * 1024 * 1024
_CHUNK = 1024 * 1024


def archive_kind(path: str) -> str:
    """Kind from the suffix: zip, tar.gz, tar or plain."""
    p = path.lower()
    if p.endswith(".zip"):
        return "zip"
    if p.endswith((".tar.gz", ".tgz")):
        return "tar.gz"
    if p.endswith(".tar"):
        return "tar"
    return "plain"


def archive_members(path: str, content: bytes) -> Iterator[tuple]:
    kind = archive_kind(path)
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for info in z.infolist():
                if info.is_dir():
                    continue
                yield path, info.filename, info.file_size, z.read(info)
    elif kind in ("tar", "tar.gz"):
        mode = "r:gz" if kind == "tar.gz" else "r:"
        with tarfile.open(fileobj=io.BytesIO(content), mode=mode) as t:
            for m in t:
                if not m.isfile():
                    continue
                yield path, m.name, m.size, t.extractfile(m).read()
    else:
        yield path, path.rsplit("/", 1)[-1], len(content), content


def archive_fault(path: str, content: bytes) -> str | None:
    """Why an archive cannot be read to its end; None if it can. Members are read in chunks."""
    kind = archive_kind(path)

    def through(f):
        while f.read(_CHUNK):
            pass

    try:
        if kind == "zip":
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for info in z.infolist():
                    if not info.is_dir():
                        with z.open(info) as f:
                            through(f)
        elif kind in ("tar", "tar.gz"):
            with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz" if kind == "tar.gz" else "r:") as t:
                for m in t:
                    if m.isfile():
                        through(t.extractfile(m))
    except (zipfile.BadZipFile, tarfile.TarError, EOFError, OSError, zlib.error, RuntimeError, NotImplementedError) as e:
        return f"{type(e).__name__}: {e}"
    return None


def _archive_files(spark: SparkSession, path: str | DataFrame, glob: str | None) -> DataFrame:
    if isinstance(path, DataFrame):
        return path.select("path", "content")
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "content")


def _files_of(batches) -> Iterator[tuple[str, bytes]]:
    """(path, content) of each file, one at a time: a batch as a list would hold its contents twice."""
    for batch in batches:
        for p, c in zip(batch.column("path"), batch.column("content")):
            yield p.as_py(), c.as_py()


def archive_errors(spark: SparkSession, path: str | DataFrame, glob: str | None = None) -> DataFrame:
    """(path, reason) of the archives that cannot be read."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = ((p, archive_fault(p, c)) for p, c in _files_of([batch]))
            bad = [f for f in found if f[1] is not None]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in bad], pa.string()) for k in (0, 1)], names=["path", "reason"])

    return _archive_files(spark, path, glob).mapInArrow(run, "path string, reason string")


def read_archive_members(spark: SparkSession, path: str | DataFrame, glob: str | None = None, skip_bad: bool = False) -> DataFrame:
    """Every member of every archive under ``path`` (or of a ``path, content`` DataFrame)."""
    files = _archive_files(spark, path, glob)

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([pa.field("archive", pa.string()), pa.field("member", pa.string()),
                            pa.field("size", pa.int64()), pa.field("content", pa.binary())])
        for p, c in _files_of(batches):
            if skip_bad and archive_fault(p, c) is not None:
                continue
            buf, held = [], 0
            for row in archive_members(p, c):
                buf.append(row)
                held += len(row[3])
                if len(buf) >= 1000 or held >= _BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(col) for col in zip(*buf)], schema=schema)
                    buf, held = [], 0
            if buf:
                yield pa.RecordBatch.from_arrays([pa.array(col) for col in zip(*buf)], schema=schema)

    return files.mapInArrow(run, MEMBERS_SCHEMA)
