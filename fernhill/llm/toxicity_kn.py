"""Toxicity by class-conditional Kneser-Ney models of characters.

Two models of order six, one of toxic and one of ordinary labelled texts, give each
symbol of a text (a letter, or the space between words) a probability after the five before it,
from the first to the last and across spaces. Counts of the class are discounted; the mass so freed goes to a backoff
distribution that both classes share, built from the continuation counts of all labelled texts
(order four, then two, then uniform). Rare expressions are so smoothed by what is known
of their endings in either class.

A toxic text is ordinary prose with some toxic expressions, so the likelihood of a unit there
is a mixture: a share of toxic units, the rest ordinary. A unit is a word and the space after it, or eight
letters of a longer run, as texts without spaces have. A text's statistic is the
log-likelihood of that mixture less that of the ordinary model, divided by its number of units and by
the root of that number; the score is a logistic function of the two, fitted to one fold of the training
rows with counts that leave this fold out. The final counts are of all training rows.

Counts grow with the training rows; they are exact and stay in Spark. For scoring, the most frequent grams and contexts are
broadcast with their exact keys, 20 bytes each, up to a bound (``ToxicityParams``). If the model has more, units with a
gram that is not among them are finished by a join with the whole model, so the result does not depend on the bound.

Defined cases: null text counts as empty; a text without letters has no units and the score of
its intercept; null labels and rows without a label train nothing; conflicting labels all count; repeated rows are scored each; without
two classes the score is the share of label 1 (0.5 without labels). Memory is bounded by the longest text. An empty table
gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .charvec import char_slices, shifted
from .common import settle
from .exact_dedup import bit_blocks, filter_blocks, split_by_filter
from .textvec import mix, places

ORDER = 6
#: Letters of a word, or of a longer run, that make a unit.
UNIT = 8
SYMBOLS = 160.0
#: Symbols whose grams a task counts at a time.
HELD = 1 << 21
#: At most about so many rows fit the three numbers of the logistic function.
CALIBRATION_ROWS = 50_000


@dataclass(frozen=True)
class ToxicityParams:
    discount: float = 0.75
    #: Share of the words of a toxic text that its toxic model speaks for.
    toxic_share: float = 0.05
    calibration_folds: int = 4
    #: Grams and contexts that are broadcast; the rest is joined.
    broadcast_grams: int = 4_000_000
    broadcast_contexts: int = 1_000_000


def _grams(symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each symbol with the five before it, as 48 bits; spaces stand before a text."""
    _, place = places(counts)
    code = np.zeros(len(symbols), np.uint64)
    for back in range(ORDER):
        code |= shifted(symbols, place, back) << np.uint64(8 * back)
    return code


def _units(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit of each symbol, and the row of each unit."""
    row, place = places(counts)
    space = symbols == 32
    begins = np.r_[True, space[:-1]][:len(symbols)] | (place == 0)
    at = np.arange(len(symbols))
    inside = at - np.maximum.accumulate(np.where(begins, at, 0))
    begins |= (inside % UNIT == 0) & ~space
    return np.cumsum(begins) - 1, row[begins]


def gram_counts(rows: DataFrame) -> DataFrame:
    """rows: text, label, fold (whether it is the fold left out first). gram and its counts in ordinary
    and toxic texts: n0, n1 over all rows, f0, f1 in the fold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            # the two bits above the gram tell the class and the fold
            found, n = np.unique(np.concatenate(held), return_counts=True)
            kind = (found >> np.uint64(48)).astype(np.int64)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array((found & np.uint64((1 << 48) - 1)).view(np.int64)), *(pa.array(np.where(own, n, 0)) for own in (kind & 1 == 0, kind & 1 == 1, kind == 2, kind == 3))],
                names=["gram", "n0", "n1", "f0", "f1"])

        for batch in batches:
            kind = batch.column(1).to_numpy(zero_copy_only=False) + 2 * batch.column(2).to_numpy(zero_copy_only=False)
            for i, j, symbols, counts in char_slices(batch.column(0)):
                held.append(_grams(symbols, counts) | np.repeat(kind[i:j], counts).astype(np.uint64) << np.uint64(48))
                size += len(symbols)
                if size >= HELD:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return rows.select("text", F.col("label").cast("int"), F.col("fold").cast("int")).mapInArrow(
        count, "gram bigint, n0 bigint, n1 bigint, f0 bigint, f1 bigint").groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "f0", "f1")))


def log_ratios(counts: DataFrame, discount: float) -> tuple[DataFrame, DataFrame]:
    """``counts``: gram, n0, n1. gram, n, ratio of the seen grams and context, n, ratio of the freed masses."""
    tail = lambda order: F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1))
    context = lambda c: F.shiftrightunsigned(c, 8)
    fours = settle(counts.groupBy(tail(4).alias("four")).agg(F.count("*").alias("c4")), "kn-fours")
    threes = fours.groupBy(context(F.col("four")).alias("three")).agg(F.sum("c4").alias("s4"), F.count("*").alias("t4"))
    twos = settle(fours.groupBy(F.col("four").bitwiseAND(F.lit(0xFFFF)).alias("two")).agg(F.count("*").alias("c2")), "kn-twos")
    ones = twos.groupBy(context(F.col("two")).alias("one")).agg(F.sum("c2").alias("s2"), F.count("*").alias("t2"))
    p2 = (F.col("c2") - discount) / F.col("s2") + discount * F.col("t2") / F.col("s2") / SYMBOLS
    twos = settle(twos.withColumn("one", context(F.col("two"))).join(ones, "one").select("two", p2.alias("p2")), "kn-p2")
    p4 = (F.col("c4") - discount) / F.col("s4") + discount * F.col("t4") / F.col("s4") * F.col("p2")
    fours = settle(fours.withColumn("three", context(F.col("four"))).withColumn("two", F.col("four").bitwiseAND(F.lit(0xFFFF)))
                   .join(threes, "three").join(twos, "two").select("four", p4.alias("p4")), "kn-p4")
    contexts = settle(counts.groupBy(context(F.col("gram")).alias("context")).agg(
        *(x for k in (0, 1) for x in (F.sum(f"n{k}").alias(f"s{k}"), F.sum((F.col(f"n{k}") > 0).cast("long")).alias(f"t{k}")))), "kn-contexts")
    # a context that a class has not seen leaves all to the backoff
    freed = lambda k: F.when(F.col(f"s{k}") > 0, discount * F.col(f"t{k}") / F.col(f"s{k}")).otherwise(1.0)
    own = lambda k: F.when(F.col(f"n{k}") > 0, (F.col(f"n{k}") - discount) / F.col(f"s{k}")).otherwise(0.0)
    p = lambda k: own(k) + freed(k) * F.col("p4")
    seen = counts.withColumn("context", context(F.col("gram"))).withColumn("four", tail(4)).join(contexts, "context").join(fours, "four")
    return (seen.select("gram", (F.col("n0") + F.col("n1")).alias("n"), (F.log(p(1)) - F.log(p(0))).alias("ratio")),
            contexts.select("context", (F.col("s0") + F.col("s1")).alias("n"), (F.log(freed(1)) - F.log(freed(0))).alias("ratio")))


class RatioTable:
    """Ratios by exact key: hashed keys (a bijection, so nothing collides) in order, found by their first bits."""

    def __init__(self, keys: np.ndarray, ratios: np.ndarray):
        hashed = mix(keys)
        order = np.argsort(hashed)
        self.shift = np.uint64(64 - max(1, len(keys).bit_length()))
        # beyond the last key stands one that is below none
        self.hashed, self.ratios = np.r_[hashed[order], np.uint64((1 << 64) - 1)], np.r_[ratios[order], np.nan]
        self.starts = np.searchsorted(hashed[order], np.arange(1 << 64 - int(self.shift), dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ratio of each key, NaN where there is none."""
        hashed = mix(keys)
        at = self.starts[(hashed >> self.shift).astype(np.int64)]
        live = np.flatnonzero(self.hashed[at] < hashed)
        while len(live):
            at[live] += 1
            live = live[self.hashed[at[live]] < hashed[live]]
        return np.where(self.hashed[at] == hashed, self.ratios[at], np.nan)


def _most_frequent(rows: DataFrame, key: str, bound: int) -> tuple[RatioTable, bool]:
    """Table of at most ``bound`` rows, the most frequent ones, and whether these are all."""
    every = rows.count()
    got = (rows if every <= bound else rows.orderBy(F.col("n").desc(), key).limit(bound)).select(key, "ratio").toArrow()
    return RatioTable(got[key].to_numpy().view(np.uint64), got["ratio"].to_numpy()), every <= bound


def evidence(docs: DataFrame, counts: DataFrame, params: ToxicityParams) -> DataFrame:
    """docs: key, text; counts: gram, n0, n1. key, llr (difference of log-likelihoods) and size (units) of each row."""
    grams, contexts = (settle(t, "kn-ratios") for t in log_ratios(counts, params.discount))
    share = params.toxic_share
    tables = (_most_frequent(grams, "gram", params.broadcast_grams), _most_frequent(contexts, "context", params.broadcast_contexts))
    whole = tables[0][1] and tables[1][1]
    known = docs.sparkSession.sparkContext.broadcast([t[0] for t in tables])
    key_type = docs.schema["key"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_gram, by_context = known.value
        for batch in batches:
            for i, j, symbols, sizes in char_slices(batch.column(2)):
                code = _grams(symbols, sizes)
                unit, unit_row = _units(symbols, sizes)
                ratio = by_gram.find(code)
                unseen = np.flatnonzero(np.isnan(ratio))
                if whole:
                    # a context without counts leaves both classes to the backoff
                    ratio[unseen] = np.nan_to_num(by_context.find(code[unseen] >> np.uint64(8)), nan=0.0)
                    unseen = unseen[:0]
                ratio[unseen] = 0.0
                of_unit = np.bincount(unit, ratio, minlength=len(unit_row))
                late = np.zeros(len(unit_row), bool)
                late[unit[unseen]] = True
                mixed = np.where(late, 0.0, np.log1p(share * np.expm1(np.minimum(of_unit, 30))))
                rows = np.r_[np.arange(j - i), unit_row[unit[unseen]]]
                told = lambda own, open_: pa.array(np.r_[own, open_])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(rows)), batch.column(1).slice(i, j - i).take(pa.array(rows)),
                     told(np.bincount(unit_row, mixed, minlength=j - i), of_unit[unit[unseen]]), told(np.bincount(unit_row, minlength=j - i), np.zeros(len(unseen), np.int64)),
                     told(np.full(j - i, -1), unit[unseen]), told(np.zeros(j - i, np.int64), code[unseen].astype(np.int64))],
                    names=["row", "key", "llr", "size", "unit", "gram"])

    out = docs.select(F.monotonically_increasing_id().alias("row"), "key", "text").mapInArrow(
        weigh, f"row bigint, key {key_type}, llr double, size bigint, unit bigint, gram bigint")
    if whole:
        return out.select("key", "llr", "size")
    out = settle(out, "kn-open")
    # units with a gram that was not broadcast: its ratio, or else its context's, or else none
    told = out.where("unit >= 0").withColumn("context", F.shiftrightunsigned("gram", 8)).join(grams.select("gram", F.col("ratio").alias("of_gram")), "gram", "left").join(
        contexts.select("context", F.col("ratio").alias("of_context")), "context", "left")
    units = told.groupBy("row", "unit").agg((F.first("llr") + F.sum(F.coalesce("of_gram", "of_context", F.lit(0.0)))).alias("of_unit"))
    late = units.groupBy("row").agg(F.sum(F.log1p(share * F.expm1(F.least("of_unit", F.lit(30.0))))).alias("late"))
    return out.where("unit < 0").join(late, "row", "left").select("key", (F.col("llr") + F.coalesce("late", F.lit(0.0))).alias("llr"), "size")


def _inputs(llr: np.ndarray, size: np.ndarray) -> np.ndarray:
    long = np.maximum(size, 1)
    return np.stack([llr / long, llr / np.sqrt(long), 1 / np.sqrt(long), np.ones(len(llr))], axis=1)


def fit_logistic(llr: np.ndarray, size: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights of the inputs, by Newton steps on the penalised likelihood."""
    x = _inputs(llr, size)
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[-1] = 1
    x = x / scale
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(h, x.T @ (p - label) + 0.1 * w), -5, 5)
    return w / scale


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts that are probably among the ids: a bounded Bloom filter is broadcast, so
    that only these, and a few by chance, shuffle to their labels."""
    keys = ids.select(F.col("doc_id").cast("string").alias("digest"))
    blocks = filter_blocks(keys.count(), 32)
    bits = settle(bit_blocks(keys, blocks), "kn-labelled")
    return split_by_filter(texts.withColumn("digest", F.col("doc_id").cast("string")), bits, blocks, "maybe").where("maybe").drop("digest", "maybe")


def toxicity_scores(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """doc_id, score of each document; ``labels`` (doc_id, label) are the training rows."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fold: Column = F.pmod(F.xxhash64("doc_id"), F.lit(params.calibration_folds)) == 0
    classes = {r.label: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = classes.get(1, 0) / max(1, sum(classes.values())) if classes else 0.5
    counts = settle(gram_counts(_texts_of(texts, known).join(known, "doc_id").withColumn("fold", fold)), "kn-counts")
    # the logistic function sees texts that its counts do not hold
    part = min(1.0, CALIBRATION_ROWS / max(1, sum(classes.values()) / params.calibration_folds))
    some = known.where(fold & (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < int(part * (1 << 20))))
    others = counts.select("gram", (F.col("n0") - F.col("f0")).alias("n0"), (F.col("n1") - F.col("f1")).alias("n1")).where("n0 + n1 > 0")
    left_out = _texts_of(texts, some).join(some, "doc_id").select(F.struct("label").alias("key"), "text")
    sample = evidence(left_out, others, params).select("llr", "size", "key.label").toArrow()
    llr, size, label = (sample[c].to_numpy() for c in ("llr", "size", "label"))
    if len(set(label.tolist())) < 2 or min(classes.get(k, 0) for k in (0, 1)) < 2:
        return texts.select("doc_id", F.lit(float(share)).alias("score"))
    weighed = evidence(texts.withColumnRenamed("doc_id", "key"), counts.select("gram", "n0", "n1"), params).withColumnRenamed("key", "doc_id")
    w = fit_logistic(llr, size, label)
    long = F.greatest(F.col("size"), F.lit(1)).cast("double")
    odds = F.col("llr") / long * float(w[0]) + F.col("llr") / F.sqrt(long) * float(w[1]) + F.lit(1.0) / F.sqrt(long) * float(w[2]) + float(w[3])
    return weighed.select("doc_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))).alias("score"))
