"""Exact substring de-duplication with fixed-block anchors.

Every document is cut into non-overlapping blocks of half a window (18 of 35 words);
the blocks' hashes are the index. Any 35-word window covers a whole block wherever it
stands, so two equal windows meet in it: at one of them as a block, at the other as a rolling 18-word
probe (or as a block that is in the index twice, where both stand alike). Every rolling
probe of every document is held against the index; windows around a hit are extended to their
35 words and compared exactly with all others, by a 96-bit hash of the words; runs of repeated
windows are the maximal repeats.

The index is probed through blocked Bloom filters, 32 bits a block of words up to
``max_filter_mb``. They are broadcast and so are bounded; bits set by chance, or many of them beyond the
bound, only bring more windows to the exact comparison. Windows that repeat within a task are settled there: the task
passes on one of them, so a passage in a third of all documents gives a row per batch, not per document.

Defined cases: null text has no words; empty text has none either, and the digest of no bytes;
documents that repeat an id and a text repeat each other. Memory is bounded by the longest text. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .textvec import BASE_WORDS_2, mix, places, window_hashes, word_slices

MAP_BITS = 32768
MARKS = 4


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, text: the key tells texts of one id apart; equal rows share it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def block_index(rows: DataFrame, block: int) -> DataFrame:
    """Hash and number of each block of words at a multiple of ``block``: h, n."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, words, counts in word_slices(batch.column(0)):
                _, place = places(counts)
                left = np.repeat(counts, counts) - place
                at = np.flatnonzero((place % block == 0) & (left >= block))
                found.append(window_hashes(words, block)[at])
            h, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    return rows.select("text").mapInArrow(emit, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _marks(hashes: np.ndarray) -> np.ndarray:
    """Four bit places inside the part of 32,768 bits, one row each."""
    return np.stack([(hashes >> np.uint64(15 * k)) & np.uint64(MAP_BITS - 1) for k in range(MARKS)])


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (mix(hashes) & np.uint64(parts - 1)).astype(np.int64)


def bit_map(hashes: DataFrame, n: int, max_filter_mb: int) -> np.ndarray:
    """Blocked Bloom filter of the distinct 64-bit hashes h: 32 bits a hash, 128 KiB at
    least and the bound at most. Each task builds whole parts, so the driver gets its bytes once."""
    parts = 32
    while parts * MAP_BITS < 32 * n and parts * MAP_BITS < max_filter_mb << 23:
        parts *= 2

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_part(h.view(np.uint64), parts))], names=["h", "part"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            h, part = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            order = np.argsort(part, kind="stable")
            begins = np.flatnonzero(np.r_[True, np.diff(part[order]) > 0][:len(order)])
            for at, end in zip(begins, np.r_[begins[1:], len(order)], strict=True):
                own = maps.setdefault(int(part[order[at]]), np.zeros(MAP_BITS, bool))
                own[_marks(h[order[at:end]]).ravel().astype(np.int64)] = True
        for part, own in maps.items():
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.packbits(own, bitorder="little").tobytes()])], names=["part", "bits"])

    numbered = hashes.select("h").mapInArrow(number, "h bigint, part bigint")
    out = np.zeros(parts * MAP_BITS // 8, np.uint8)
    for row in numbered.repartition("part").mapInArrow(build, "part bigint, bits binary").toLocalIterator():
        out[row.part * (MAP_BITS // 8):][:MAP_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return out


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether all four bits of each hash are set."""
    begin = _part(hashes, len(bits) * 8 // MAP_BITS) * (MAP_BITS // 8)
    live = np.arange(len(hashes))
    for place in _marks(hashes):
        at = place[live]
        live = live[(bits[begin[live] + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0]
    found = np.zeros(len(hashes), bool)
    found[live] = True
    return found


def _open_windows(rows: DataFrame, blocks, repeated_blocks, window: int, block: int) -> DataFrame:
    """Windows around hits: h and g (their hash), salt, n, doc_id, text_key, start.

    A window that occurs again in the same batch is repeated for sure: one of them speaks for
    all with n = 2, the others go on under salts of their own, with n = 2 as well."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, twice = blocks.value, repeated_blocks.value
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1).to_numpy()
            parts = []
            for i, _, words, counts in word_slices(batch.column(2)):
                probes = window_hashes(words, block)
                if len(words) < window:
                    continue
                row, place = places(counts)
                left = counts[row] - place
                hit = np.zeros(len(words), bool)
                inside = left[:len(probes)] >= block
                aligned = place[:len(probes)] % block == 0
                # a block is in the index itself, so it only counts if it is there twice
                hit[:len(probes)] = inside & np.where(aligned, in_map(twice, probes), in_map(every, probes))
                reach = np.zeros(len(words) + 1, np.int64)
                np.cumsum(hit, out=reach[1:])
                ends = np.minimum(np.arange(len(words)) + window - block + 1, len(words))
                at = np.flatnonzero((reach[ends] > reach[:-1]) & (left >= window))
                h, g = window_hashes(words, window)[at], window_hashes(words, window, BASE_WORDS_2)[at]
                parts.append((h.view(np.int64), g.astype(np.uint32).view(np.int32), row[at] + i, place[at].astype(np.int32)))
            if not parts:
                continue
            h, g, row, start = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((g, h))
            same = (h[order][1:] == h[order][:-1]) & (g[order][1:] == g[order][:-1])
            first = np.r_[True, ~same][:len(order)]
            several = ~first | np.r_[same, False][:len(order)]
            salt = np.zeros(len(order), np.int32)
            salt[~first] = 1 + np.flatnonzero(~first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[order]), pa.array(g[order]), pa.array(salt), pa.array(np.where(several, 2, 1).astype(np.int8)),
                 ids.take(pa.array(row[order])), pa.array(keys[row[order]]), pa.array(start[order])],
                names=["h", "g", "salt", "n", "doc_id", "text_key", "start"])

    return rows.mapInArrow(emit, "h bigint, g int, salt int, n tinyint, doc_id bigint, text_key bigint, start int")


def repeated_windows(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", max_filter_mb: int = 64) -> DataFrame:
    """doc_id, text_key and the sorted starts of all windows whose words start anywhere else too."""
    rows = _rows(docs, id_col, text_col)
    block = (window + 1) // 2
    index = settle(block_index(rows, block), "anchor-index")
    n, n_twice = index.agg(F.count("*"), F.count(F.when(F.col("n") > 1, 1))).first()
    spark = docs.sparkSession
    every = spark.sparkContext.broadcast(bit_map(index, n, max_filter_mb))
    twice = spark.sparkContext.broadcast(bit_map(index.where("n > 1"), n_twice, max_filter_mb))
    open_windows = _open_windows(rows, every, twice, window, block)
    # rows of one salt: a window that repeats inside a batch has a salt and n = 2 of its own
    same = Window.partitionBy("h", "g", "salt")
    repeated = open_windows.withColumn("all", F.sum("n").over(same)).where(F.col("all") > 1)
    return repeated.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("start")).alias("starts"))


def drop_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", max_filter_mb: int = 64,
                 with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, spans
    (removed runs of words: first, end) and kept_text (the other words joined by one space)."""
    rows = _rows(docs, id_col, text_col)
    found = settle(repeated_windows(docs, window, id_col, text_col, max_filter_mb), "anchor-starts")
    found = found.select(F.col("doc_id").alias("f_id"), F.col("text_key").alias("f_key"), "starts")
    joined = rows.join(found, (F.col("text_key") == F.col("f_key")) & F.col("doc_id").eqNullSafe(F.col("f_id")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts_of = batch.column(2)
            begins, flat = starts_of.offsets.to_numpy(), starts_of.values.to_numpy()
            valid = np.asarray(starts_of.is_valid())
            columns: list[list] = [[], [], [], [], []]
            for r, text in enumerate(batch.column(1).cast(pa.large_binary())):
                words = text.as_py().split()
                n, spans = len(words), []
                if valid[r] and begins[r] < begins[r + 1]:
                    starts = flat[begins[r]:begins[r + 1]]
                    breaks = np.flatnonzero(np.diff(starts) > window)
                    firsts = starts[np.r_[0, breaks + 1]]
                    ends = starts[np.r_[breaks, len(starts) - 1]] + window
                    spans = list(zip(firsts.tolist(), ends.tolist(), strict=True))
                    kept, at = [], 0
                    for a, b in spans:
                        kept += words[at:a]
                        at = b
                    words = kept + words[at:]
                text = b" ".join(words)
                row = [n, n - len(words), hashlib.sha256(text).hexdigest()]
                if with_text:
                    row += [[{"first": a, "end": b} for a, b in spans], text.decode()]
                for column, value in zip(columns, row, strict=False):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])), pa.string()]
            names = ["n_words", "n_removed", "kept_sha256", "spans", "kept_text"][:5 if with_text else 3]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k, _ in zip(columns, kinds, names, strict=False))],
                                             names=["doc_id", *names])

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return joined.select("doc_id", "text", "starts").mapInArrow(
        cut, schema + ", spans array<struct<first: int, end: int>>, kept_text string" * with_text)
