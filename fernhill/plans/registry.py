"""Registry of named queries: a Spark builder and, where SQL can say it, the
equivalent DuckDB SQL over the same parquet tables (the correctness oracle).

Keys are the operator ids of the blueprint in lower case (``c2_...``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a ``(spark, sf_dir) -> DataFrame`` builder under ``name``."""

    def wrap(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None)
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_state(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """What tells one state of a given table's files from another: path, size, time."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return (spark.sparkContext.applicationId, str(path.toString()), fs.getContentSummary(path).getLength(),
            fs.getFileStatus(path).getModificationTime())


def load_all() -> dict[str, Query]:
    """Import every query module (they register on import) and return the registry."""
    from . import queries_io, queries_landing, queries_loads, queries_scalar, queries_titles, queries_views  # noqa: F401

    return REGISTRY
