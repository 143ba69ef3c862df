"""Classifiers on rows that they have not learned from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernhill.llm import queries

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    values, where, counts = np.unique(score[order], return_inverse=True, return_counts=True)
    rank = np.empty(len(score))
    rank[order] = (np.cumsum(counts) - (counts - 1) / 2)[where]
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def held_out_rows(spark, query, label, sf=SF):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col(label).alias("label")).where("label IS NOT NULL")
    got = query(spark, sf).where("held_out").join(labels, "doc_id").toPandas()
    return got.score.to_numpy(), got.label.to_numpy(), got.predicted.to_numpy()


def test_quality_of_held_out_documents(spark):
    score, label, predicted = held_out_rows(spark, queries.op2_quality_qda, "quality")
    assert len(label) > 40 and auc(score, label) > 0.97 and (predicted == label).mean() > 0.95


def test_toxicity_of_held_out_documents(spark):
    # the smaller table has six toxic documents that are held out
    score, label, predicted = held_out_rows(spark, queries.op3_toxicity_kn, "toxic", "/root/testdata/sf0.1")
    assert len(label) > 700 and auc(score, label) > 0.95 and (predicted == label).mean() > 0.93
    assert label[predicted == 1].mean() > 0.9


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL").select("doc_id", "lang")
    got = queries.op9_hierarchical_language(spark, SF).where("held_out AND lang_pred <> 'und'").join(docs, "doc_id").toPandas()
    assert len(got) > 150 and (got.lang == got.lang_pred).mean() > 0.98


@pytest.mark.parametrize("seed", [1, 2])
def test_auc(seed):
    rng = np.random.default_rng(seed)
    score, label = rng.integers(0, 5, 60) / 5, rng.integers(0, 2, 60)
    pairs = [(a > b) + 0.5 * (a == b) for a in score[label == 1] for b in score[label == 0]]
    assert auc(score, label) == pytest.approx(np.mean(pairs))
