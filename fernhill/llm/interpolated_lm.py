"""Language-model scores by deleted interpolation (Jelinek and Mercer).

A text is its words and an end token. The probability of a token after the one before it (at
the start, after the end token) interpolates maximum-likelihood estimates,

    P(w | v) = a(C(v)) c(v, w) / C(v) + (1 - a(C(v))) P(w),   P(w) = b c(w) / N + (1 - b) / (V + 1),

where the weight a depends on the bucket of the context's count C(v), by powers of two, and is 0 for
an unseen context. V counts distinct training tokens; one more stands for all unknown ones, so
the probabilities after any context sum to one. One in ``deleted`` training
documents is held out from the estimates while expectation-maximisation learns the weights on what
it holds; the final estimates count all training documents.

Counts cover whole texts and all documents, and stay in Spark. Texts are packed into blocks of some MB (long
ones cut at white space, the part before lends its last word as context). Each block lists its distinct
words and word pairs once, as sorted 64-bit hashes with counts, cut by hash range into buckets. A
bucket's task adds up the counts of all blocks and answers each block in the order in which that one asked,
so keys travel once and answers are counts alone; a pair that is in every text has one entry per
block. A block then meets its answers, and its texts are scored in its own task. Bucket and block sizes bound
memory; the number of both grows with the input, as does the answers' share of it. With very
many blocks, larger ones (``block_bytes``, ``bucket_bytes``) keep the pieces between them from getting small.

Defined cases: null text is the end token alone; a null id is never held out; repeated rows are texts of their
own; without training documents all probabilities are 1 / (V + 1) = 1; without
held-out ones the weights are the starting ones; texts of any length are worked on in parts. An
empty table gives an empty result. Other columns are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle
from .textvec import BASE_WORDS, BASE_WORDS_2, mix, word_slices

GAP = re.compile(rb"[\x20\x09-\x0D]+")
#: The hash that stands for the end of a text.
END = np.uint64(0x5851F42D4C957F2D)
#: Blocks hold documents of one kind: counted, held out for the weights, or only scored.
COUNTED, DELETED, SCORED = 0, 1, 2
#: Context counts from 2^k to 2^(k+1) - 1 share bucket k + 1; bucket 0 is for unseen contexts.
COUNT_BUCKETS = 64


@dataclass(frozen=True)
class InterpolationParams:
    #: One in so many training documents is held out for the weights.
    deleted: int = 10
    block_bytes: int = 2 << 20
    bucket_bytes: int = 4 << 20
    #: Longer texts are cut into parts of about this size.
    part_bytes: int = 1 << 20
    most_steps: int = 25
    tolerance: float = 1e-4


def _pack(values: np.ndarray) -> bytes:
    """64-bit values, byte planes apart: those of small or ascending values are mostly zeros."""
    planes = np.ascontiguousarray(values.astype("<u8")).view("u1").reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, codec="zstd", asbytes=True), "u1").reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _parts(data: bytes, part_bytes: int) -> Iterator[tuple[bytes, bool, bool]]:
    """(bytes, whether the first word is only context, whether the text ends here)."""
    at, context = 0, b""
    while True:
        cut = GAP.search(data, at + part_bytes) if len(data) - at > part_bytes else None
        stop = cut.end() if cut else len(data)
        part = data[at:stop] if at or cut else data
        yield (context + b" " + part if context else part), bool(context), stop == len(data)
        if stop == len(data):
            return
        words = part.rsplit(None, 1)  # bytes split at the same six characters
        context = words[-1] if words else context
        at = stop


def pack_blocks(texts: DataFrame, params: InterpolationParams = InterpolationParams()) -> DataFrame:
    """``texts`` (row, doc_id, kind, text) in blocks of one kind: block, kind, size, and a list item per part."""
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"block bigint, kind int, size bigint, rows array<bigint>, ids array<{id_type}>, leads array<int>, ends array<int>, sizes array<int>, data binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered = TaskContext.get().partitionId() << 28
        made = 0
        open_parts: dict[int, list[tuple]] = {COUNTED: [], DELETED: [], SCORED: []}
        filled = dict.fromkeys(open_parts, 0)

        def flush(kind: int) -> pa.RecordBatch:
            nonlocal made
            rows, ids, leads, ends, data = zip(*open_parts[kind], strict=True)
            whole = b"".join(data)
            open_parts[kind], filled[kind] = [], 0
            made += 1
            one = lambda values, kind: pa.array([values], pa.list_(kind))
            return pa.RecordBatch.from_arrays(
                [pa.array([numbered + made]), pa.array([kind], pa.int32()), pa.array([len(whole)]), one(rows, pa.int64()), pa.array([list(ids)], pa.list_(id_kind)),
                 one(leads, pa.int32()), one(ends, pa.int32()), one(list(map(len, data)), pa.int32()), pa.array([pa.compress(whole, codec="zstd", asbytes=True)], pa.binary())],
                names=["block", "kind", "size", "rows", "ids", "leads", "ends", "sizes", "data"])

        id_kind = pa.int64()
        for batch in batches:
            id_kind = batch.column(1).type
            for row, did, kind, text in zip(*batch.columns, strict=True):
                kind = kind.as_py()
                # lower() of bytes changes A-Z alone
                for data, lead, end in _parts(text.as_py().encode().lower(), params.part_bytes):
                    open_parts[kind].append((row.as_py(), did.as_py(), int(lead), int(end), data))
                    filled[kind] += len(data) + 32
                    if filled[kind] >= params.block_bytes:
                        yield flush(kind)
        for kind, parts in open_parts.items():
            if parts:
                yield flush(kind)

    return texts.select("row", "doc_id", "kind", "text").mapInArrow(pack, schema)


class Block:
    """Tokens of one block's parts and its distinct keys: odd ones for words, even ones for pairs."""

    def __init__(self, data: bytes, size: int, sizes: list[int], leads: list[int], ends: list[int]):
        raw = pa.py_buffer(pa.decompress(data, size, codec="zstd", asbytes=True))
        offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), raw])
        got = list(word_slices(column))
        words, counts = np.concatenate([s[2] for s in got]), np.concatenate([s[3] for s in got])
        lead, end = np.array(leads, bool), np.array(ends, bool)
        # a part is its context (the end token at the start of a text), its words and the end token if it ends the text
        lengths = counts + ~lead + end
        stops = np.cumsum(lengths)
        begins = stops - lengths
        sequence = np.full(int(stops[-1]), END, np.uint64)
        is_word = np.ones(len(sequence), bool)
        is_word[begins[~lead]] = False
        is_word[stops[end] - 1] = False
        sequence[is_word] = words
        told = np.ones(len(sequence), bool)
        told[begins] = False
        at = np.flatnonzero(told)
        token, before = sequence[at], sequence[at - 1]
        self.part = np.repeat(np.arange(len(sizes), dtype=np.int32), lengths - 1)
        # contexts are tokens of the block themselves but for those at the beginnings of parts
        contexts = np.unique(sequence[begins])
        del sequence, is_word, told, at, got
        word_key = lambda h: mix(h ^ np.uint64(BASE_WORDS)) | np.uint64(1)
        pair_key = mix(mix(before * np.uint64(BASE_WORDS_2)) + token) & ~np.uint64(1)
        pairs, first, inverse, self.pair_n = np.unique(pair_key, return_index=True, return_inverse=True, return_counts=True)
        self.pair = inverse.astype(np.int32)
        before = before[first]
        del pair_key, inverse
        words = np.unique(np.r_[word_key(token), word_key(contexts)])
        word = np.searchsorted(words, word_key(token)).astype(np.int32)
        self.pair_word, self.pair_context = word[first], np.searchsorted(words, word_key(before))
        self.keys = np.sort(np.r_[words, pairs])
        self.words_at, self.pairs_at = np.searchsorted(self.keys, words), np.searchsorted(self.keys, pairs)
        self.n = np.zeros(len(self.keys), np.int64)
        self.n[self.words_at] = np.bincount(word, minlength=len(words))
        self.n[self.pairs_at] = self.pair_n

    @staticmethod
    def of(table: pa.Table | pa.RecordBatch, k: int) -> Block:
        get = lambda c: table[c][k].as_py()
        return Block(get("data"), get("size"), get("sizes"), get("leads"), get("ends"))

    def counts(self, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each distinct pair, from the counts of the keys: its own, its context's and its word's."""
        words = total[self.words_at]
        return total[self.pairs_at], words[self.pair_context], words[self.pair_word]


def gather_counts(blocks: DataFrame, params: InterpolationParams = InterpolationParams()) -> DataFrame:
    """For each block and bucket its keys' counts over all training documents (total) and, for
    blocks held out, over those that are not (kept), in the keys' order; a bucket's own sums stand in its first row."""
    size = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bits = int(max(1, -(-size // params.bucket_bytes)) - 1).bit_length()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block.of(batch, k)
                bucket = (block.keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(block.keys), np.int64)
                cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
                spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts[:-1]]), *(pa.array([batch[c][k].as_py()] * len(spans), kind) for c, kind in (("block", pa.int64()), ("kind", pa.int32()))),
                     pa.array(np.diff(cuts)), pa.array([_pack(block.keys[s:e]) for s, e in spans], pa.binary()), pa.array([_pack(block.n[s:e]) for s, e in spans], pa.binary())],
                    names=["bucket", "block", "kind", "length", "keys", "n"])

    def answer(asked: pa.Table) -> pa.Table:
        blocks_, kinds, lengths = (asked[c].to_numpy() for c in ("block", "kind", "length"))
        read = lambda c: np.concatenate([_unpack(p.as_py(), int(n)) for p, n in zip(asked[c], lengths, strict=True)])
        keys, where = np.unique(read("keys"), return_inverse=True)
        n, kind = read("n").astype(np.float64), np.repeat(kinds, lengths)
        total = np.bincount(where, n * (kind < SCORED), len(keys)).astype(np.uint64)
        kept = np.bincount(where, n * (kind == COUNTED), len(keys)).astype(np.uint64)
        stops = np.cumsum(lengths)
        spans = list(zip((stops - lengths).tolist(), stops.tolist(), strict=True))
        is_word = (keys & np.uint64(1)) > 0
        sums = [int((is_word & (total > 0)).sum()), int(total[is_word].sum()), int(kept[is_word].sum())]
        return pa.Table.from_arrays(
            [pa.array(blocks_), asked["bucket"], asked["length"], pa.array([_pack(total[where[s:e]]) for s, e in spans], pa.binary()),
             pa.array([_pack(kept[where[s:e]]) if k == DELETED else None for (s, e), k in zip(spans, kinds, strict=True)], pa.binary()),
             *(pa.array([x] + [0] * (len(spans) - 1), pa.int64()) for x in sums)],
            names=["block", "bucket", "length", "total", "kept", "words", "tokens", "kept_tokens"])

    asked = blocks.select("block", "kind", "size", "leads", "ends", "sizes", "data").mapInArrow(
        ask, "bucket bigint, block bigint, kind int, length bigint, keys binary, n binary")
    return asked.groupBy("bucket").applyInArrow(
        answer, "block bigint, bucket bigint, length bigint, total binary, kept binary, words bigint, tokens bigint, kept_tokens bigint")


def _answers(told: pa.Table, column: str) -> np.ndarray:
    order = np.argsort(told["bucket"].to_numpy())
    return np.concatenate([_unpack(told[column][int(k)].as_py(), told["length"][int(k)].as_py()) for k in order]).astype(np.float64)


def held_out_events(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """pair, context, word (counts without the held-out documents) and n of the events in the held-out ones."""

    def events(own: pa.Table, told: pa.Table) -> pa.Table:
        found = []
        for k in range(own.num_rows):
            block = Block.of(own, k)
            rows, where = np.unique(np.stack(block.counts(_answers(told, "kept")), axis=1).astype(np.int64), axis=0, return_inverse=True)
            found.append(np.column_stack([rows, np.bincount(where.ravel(), block.pair_n).astype(np.int64)]))
        table = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
        return pa.Table.from_arrays([pa.array(np.ascontiguousarray(c)) for c in table.T], names=["pair", "context", "word", "n"])

    told = counts.where(F.col("kept").isNotNull()).select("block", "bucket", "length", "kept")
    asked = blocks.where(F.col("kind") == DELETED).groupBy("block").cogroup(told.groupBy("block"))
    return asked.applyInArrow(events, "pair bigint, context bigint, word bigint, n bigint").groupBy("pair", "context", "word").agg(F.sum("n").alias("n"))


def count_bucket(count: np.ndarray) -> np.ndarray:
    """0 for none, k + 1 for 2^k to 2^(k+1) - 1."""
    return np.where(count > 0, np.frexp(count)[1], 0)


@dataclass(frozen=True)
class Weights:
    pair: tuple[float, ...] = (0.0, *[0.5] * (COUNT_BUCKETS - 1))
    word: float = 0.9


def _better(weights: Weights, sums: list[tuple]) -> Weights:
    """One step: ``sums`` (bucket, n, share of the pair's estimate, of the word's, of the two lower ones)."""
    pair, seen = list(weights.pair), sorted(s[0] for s in sums if s[0] > 0)
    for b, n, of_pair, _, _ in sums:
        if b > 0 and n > 0:
            pair[b] = of_pair / n
    # buckets that no held-out event has fallen into take the weight of the nearest one
    for b in range(1, COUNT_BUCKETS):
        if seen and b not in seen:
            pair[b] = pair[min(seen, key=lambda s: abs(s - b))]
    lower = sum(s[4] for s in sums)
    word = sum(s[3] for s in sums) / lower if lower > 0 else weights.word
    inside = lambda x: round(min(max(x, 1e-6), 1 - 1e-6), 6)
    return Weights((0.0, *map(inside, pair[1:])), inside(word))


def learn_weights(events: DataFrame, words: int, kept_tokens: int, params: InterpolationParams = InterpolationParams()) -> Weights:
    """Expectation-maximisation over written ``events``: each step is one pass that returns a row per bucket."""
    seen = F.col("context") > 0
    ready = settle(events.select(
        F.when(seen, F.floor(F.log2(F.col("context").cast("double")) + 1e-12).cast("int") + 1).otherwise(0).alias("bucket"),
        F.when(seen, F.col("pair") / F.greatest("context", F.lit(1))).otherwise(0.0).alias("by_pair"),
        (F.col("word") / F.lit(max(kept_tokens, 1))).alias("by_word"), "n"), "lm-events")
    weights = Weights()
    for _ in range(params.most_steps):
        a = F.element_at(F.array(*map(F.lit, weights.pair)), F.col("bucket") + 1)
        of_pair = a * F.col("by_pair")
        of_word = (1 - a) * weights.word * F.col("by_word")
        rest = (1 - a) * (1 - weights.word) / (words + 1)
        share = lambda x: F.sum(F.col("n") * x / (of_pair + of_word + rest))
        sums = [tuple(r) for r in ready.groupBy("bucket").agg(F.sum("n"), share(of_pair), share(of_word), share(of_word + rest)).collect()]  # a row per bucket
        if not sums:
            return weights
        weights, before = _better(weights, sums), weights
        if max(abs(x - y) for x, y in zip((*weights.pair, weights.word), (*before.pair, before.word), strict=True)) < params.tolerance:
            break
    return weights


def pair_probability(pair: np.ndarray, context: np.ndarray, word: np.ndarray, words: int, tokens: int, weights: Weights) -> np.ndarray:
    """P(w | v) from the counts of (v, w), v and w."""
    a = np.array(weights.pair)[count_bucket(context)]
    by_pair = np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)
    return a * by_pair + (1 - a) * (weights.word * word / max(tokens, 1) + (1 - weights.word) / (words + 1) if tokens else 1.0)


def text_scores(docs: DataFrame, is_training: Column, params: InterpolationParams = InterpolationParams(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score (add-one unigrams), score of each document, in log10."""
    deleted = F.pmod(F.xxhash64(F.col(id_col)), F.lit(params.deleted)) == 0
    kind = F.when(~F.coalesce(is_training, F.lit(False)), SCORED).when(deleted, DELETED).otherwise(COUNTED)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), kind.alias("kind"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blocks = settle(pack_blocks(texts, params), "lm-blocks")
    counts = settle(gather_counts(blocks, params), "lm-counts")
    words, tokens, kept_tokens = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "tokens", "kept_tokens"))).first()
    weights = learn_weights(held_out_events(blocks, counts), words, kept_tokens, params)
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def score(own: pa.Table, told: pa.Table) -> pa.Table:
        total = _answers(told, "total")
        out = []
        for k in range(own.num_rows):
            block = Block.of(own, k)
            pair, context, word = block.counts(total)
            n = len(own["rows"][k])
            model = np.log10(pair_probability(pair, context, word, words, tokens, weights))
            base = np.log10((word + 1) / (tokens + words + 1))
            add = lambda of_pair: np.bincount(block.part, of_pair[block.pair], n)
            out.append(pa.Table.from_arrays(
                [own["rows"][k].values, own["ids"][k].values, pa.array(np.bincount(block.part, minlength=n)), pa.array(add(word > 0).astype(np.int64)),
                 pa.array(add(base)), pa.array(add(model))], names=["row", "doc_id", "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(out)

    met = blocks.groupBy("block").cogroup(counts.select("block", "bucket", "length", "total").groupBy("block"))
    parts = met.applyInArrow(score, f"row bigint, doc_id {id_type}, n_tokens bigint, n_known bigint, base_score double, score double")
    return parts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score"))).select(
        "doc_id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
