"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet and read again as the next one's documents. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernhill.llm import exact_dedup, order_minhash, packing, quality_qda, source_mix
from fernhill.llm.common import limit_batches, settle
from fernhill.llm.queries import QUALITY_THRESHOLD, tokenizer_path, training_labels
from fernhill.session import ensure_checkpoint_dir, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    _ready(spark)
    return quality_qda.keep_good(docs, training_labels(spark, sf_dir), QUALITY_THRESHOLD)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    _ready(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    _ready(spark)
    return order_minhash.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken, cut to the taken blocks; n_chars follows the text."""
    _ready(spark)
    mixed = source_mix.mix_rows(docs)
    if "n_chars" not in docs.columns:
        return mixed
    return mixed.select(*(F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2,048."""
    _ready(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

#: SQL expresses neither the classifier nor the near-duplicate stage; tests/llm/test_pipeline.py holds each stage against plain Python.
ORACLE_SQL = None


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    limit_batches(spark)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
