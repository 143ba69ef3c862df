"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The white space that separates words and that exact copies ignore: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def limit_batches(spark: SparkSession, most_mb: int = 8) -> None:
    """Bound the Arrow batches of this session: a Python worker and the executor hold several
    at a time, and 10,000 rows of text may be 64 MB. A smaller bound of the session's own stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name).removesuffix("b")
    if not own.isdigit() or int(own) > most_mb << 20:
        spark.conf.set(name, str(most_mb << 20))


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage is
    cut, later passes do not recompute it, and a lost executor costs nothing."""
    limit_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], wish: str) -> str:
    """``wish``, with underscores before it until no column has that name."""
    lower = {c.lower() for c in taken}
    while wish.lower() in lower:
        wish = "_" + wish
    return wish


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
