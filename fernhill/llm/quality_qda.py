"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Twenty-two statistics of a whole text (lengths, shares of character classes, repetition
of words, shingles and lines) are transformed to be near normal. Each class is a
normal distribution whose covariance is shrunk towards the pooled diagonal. The score is the
logistic function of the difference of the classes' Mahalanobis log-densities plus the
log prior odds, divided by a temperature; the factors are Cholesky factors computed once.

The moments are sums over all labelled training rows, so training is one aggregate.

Defined cases: null text counts as empty and gets a score like any other; rows without a
label, and labels that are null, train nothing; conflicting labels all count; with fewer than three
rows of a class the score is the share of label 1 (0.5 without labels). Labels repeated
for an id count as often as they stand there; other columns, whatever their names, are ignored, and ``keep_good``
keeps them. Texts are worked on in slices, so memory is bounded by the longest one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .textvec import mix, places, text_bytes, window_hashes, word_slices

N_STATISTICS = 22

_CLASS = np.full(256, 5, np.int8)  # 5: other symbols
for _codes, _name in ((range(65, 91), 0), (range(97, 123), 1), (range(48, 58), 2), ((32, *range(9, 14)), 3),
                      ((ord(c) for c in ".,;:!?'\"-()"), 4), (range(128, 256), 6)):
    _CLASS[list(_codes)] = _name


@dataclass(frozen=True)
class QualityParams:
    shrinkage: float = 0.1
    temperature: float = 3.0
    ridge: float = 1e-3


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Logit of a share, held off 0 and 1 by half an item."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def _distinct(row: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes per row and the count of the most frequent one."""
    order = np.lexsort((hashes, row))
    new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])][:len(order)]
    begins = np.flatnonzero(new)
    sizes = np.diff(np.r_[begins, len(order)])
    most = np.zeros(n, np.int64)
    np.maximum.at(most, row[order][begins], sizes)
    return np.bincount(row[order][begins], minlength=n), most


def _statistics(data: np.ndarray, offsets: np.ndarray, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    n = len(counts)
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * 7 + _CLASS[data], minlength=7 * n).reshape(n, 7)
    upper, lower, digits, spaces, marks, symbols, high = kinds.T
    letters = upper + lower + high
    solid = size - spaces
    w_row, place = places(counts)
    word_kinds, word_most = _distinct(w_row, words, n)
    shingles = window_hashes(words, 5)
    fits = np.flatnonzero((counts[w_row] - place >= 5)[:len(shingles)]) if len(shingles) else np.zeros(0, np.int64)
    shingle_kinds, _ = _distinct(w_row[fits], shingles[fits], n)
    n_shingles = np.maximum(counts - 4, 0)
    # lines: word hashes summed up between line ends
    ends = np.flatnonzero(data == 10)
    begins = np.unique(np.r_[ends + 1, offsets[:-1][size > 0]])
    begins = begins[begins < len(data)] if len(data) else begins[:0]
    line_of = np.searchsorted(begins, np.arange(len(data)), "right") - 1
    weight = mix(data.astype(np.uint64) + (np.arange(len(data), dtype=np.uint64) - begins[line_of].astype(np.uint64)) * np.uint64(256)) if len(begins) else np.zeros(0, np.uint64)
    sums = np.add.reduceat(weight, begins) if len(begins) else np.zeros(0, np.uint64)
    n_lines = np.bincount(row[begins], minlength=n) if len(begins) else np.zeros(n, np.int64)
    line_kinds, line_most = _distinct(row[begins], sums, n) if len(begins) else (np.zeros(n, np.int64), np.zeros(n, np.int64))
    pipes, hashes, bangs, stops = (np.bincount(row[data == ord(c)], minlength=n) for c in "|#!.")
    words_1 = np.maximum(counts, 1)
    mean = solid / words_1
    return np.stack([
        np.log1p(size), np.log1p(counts), np.log1p(mean), np.log1p(size / np.maximum(n_lines, 1)), np.log1p(n_lines),
        _share(upper, letters), _share(digits, solid), _share(marks, solid), _share(symbols, solid), _share(high, solid),
        _share(spaces, size), _share(letters, solid), _share(word_kinds, counts), _share(word_most, counts),
        _share(shingle_kinds, n_shingles), _share(line_kinds, n_lines), _share(line_most, n_lines), np.log1p(pipes / words_1 * 10),
        np.log1p(bangs / words_1 * 10), np.log1p(stops / words_1 * 10), np.log1p(hashes / words_1 * 10), np.log1p(symbols / words_1 * 10)], axis=1)


def _measured(rows: DataFrame, text_of) -> DataFrame:
    """The first column of ``rows`` as doc_id, and the statistics x of the texts that
    ``text_of`` takes from a batch."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = text_of(batch)
            data, offsets = text_bytes(text)
            for i, j, words, counts in word_slices(text):
                x = _statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words, counts)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * N_STATISTICS, pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), listed], names=["doc_id", "x"])

    return rows.mapInArrow(measure, f"doc_id {rows.schema[0].dataType.simpleString()}, x array<double>")


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the transformed statistics x of each document, in the order of the rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _measured(rows, lambda batch: batch.column(1))


@dataclass(frozen=True)
class Discriminant:
    """Fitted classes; without two of them only the share of label 1."""

    share: float
    means: np.ndarray | None = None
    inverse_factors: np.ndarray | None = None
    log_dets: np.ndarray | None = None
    temperature: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        logs = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.inverse_factors[k].T
            logs.append(-0.5 * (z * z).sum(axis=1) - self.log_dets[k])
        odds = (logs[1] - logs[0] + np.log(self.share / (1 - self.share))) / self.temperature
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(labelled: DataFrame, params: QualityParams = QualityParams()) -> Discriminant:
    """labelled: x, label (0 or 1). Counts, sums and products are added up over all rows."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + N_STATISTICS + N_STATISTICS ** 2))
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)
            for k in (0, 1):
                own = x[label == k]
                total[k] += np.r_[len(own), own.sum(axis=0), (own.T @ own).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["label", "m"])

    parts = labelled.select("x", F.col("label").cast("int")).mapInArrow(moments, "label bigint, m array<double>")
    sums = parts.select("label", F.posexplode("m").alias("at", "v")).groupBy("label", "at").agg(F.sum("v").alias("v"))
    total = np.zeros((2, 1 + N_STATISTICS + N_STATISTICS ** 2))
    for row in sums.collect():  # two classes times a fixed number of moments
        total[row.label, row["at"]] = row.v
    n = total[:, 0]
    share = float(n[1] / n.sum()) if n.sum() else 0.5
    if n.min() < 3:
        return Discriminant(share)
    means = total[:, 1:1 + N_STATISTICS] / n[:, None]
    covs = total[:, 1 + N_STATISTICS:].reshape(2, N_STATISTICS, N_STATISTICS) / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = np.diag(np.diag((covs * n[:, None, None]).sum(axis=0) / n.sum())) + params.ridge * np.eye(N_STATISTICS)
    factors = [np.linalg.cholesky((1 - params.shrinkage) * c + params.shrinkage * pooled) for c in covs]
    return Discriminant(share, means, np.array([np.linalg.inv(f) for f in factors]), np.array([np.log(np.diag(f)).sum() for f in factors]), params.temperature)


def score_rows(measured: DataFrame, model: Discriminant) -> DataFrame:
    """``measured`` with x replaced by the score."""
    others = [f for f in measured.schema if f.name != "x"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(f.name)) for f in others), pa.array(model.score(x))],
                                             names=[*(f.name for f in others), "score"])

    return measured.mapInArrow(apply, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others) + ", score double")


def quality_scores(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """doc_id, score of each document; ``labels`` (doc_id, label) are the training rows."""
    measured = settle(document_statistics(docs, id_col, text_col), "quality-statistics")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where(F.col("label").isin(0, 1))
    return score_rows(measured, fit(measured.join(known, "doc_id"), params))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, params: QualityParams = QualityParams(), id_col: str = "doc_id",
              text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold; rows are scored where they are read."""
    measured = settle(document_statistics(docs, id_col, text_col), "quality-statistics")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where(F.col("label").isin(0, 1))
    model = fit(measured.join(known, "doc_id"), params)
    # whole rows go along as one column, and the text is read from it, so that it is sent once
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    at = docs.columns.index(text_col)
    return score_rows(_measured(rows, lambda batch: pc.fill_null(batch.column(0).field(at), "")), model).where(F.col("score") >= threshold).select("doc_id.*")
