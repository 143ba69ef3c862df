"""Near-duplicate documents by Order MinHash and banded alignment.

A document is the sequence of its five-word shingles, each labelled with its occurrence
number (Marçais et al.). A sketch takes the three labelled shingles that are smallest under
one of 20 hash orders, in the order of the text; documents with an equal sketch meet in a
bucket. The similarity of two documents is that of their best alignment: matches /
(shingles of both - matches), where matches are the longest common subsequence of the shingles without
labels, so that a repeat dropped early does not shift all later ones. It is taken for all
shingles and for the first occurrences alone, and the smaller counts, so that one
line repeated in both does not make two texts alike. Links have 0.8 or more; classes are the
connected components of the links.

A bucket is never expanded into its pairs. Its members are first held against three of them: the one
that meets the most others over all buckets, and two by hash. Pairs whose lengths or 20 minima rule
out the threshold wait; of the others each document's few most similar ones are aligned. Equal word sequences are one node from the start.

A document also has a bitmap of 512 bits, in which each of its distinct shingles turns one bit over. Two bitmaps differ
in at most as many bits as the texts differ in shingles, so many pairs below the threshold are ruled out exactly before their texts meet.

Members of buckets that are then still in several classes, as in a family whose members share a passage but
are not similar, are held against one another by an exact prefix filter on their distinct shingles, as links
need the threshold for first occurrences too: these are ordered, frequent ones
last, and two texts at the threshold share one among the first fifth of both. What they share there
and what follows their last common one bounds all they can share; pairs below are ruled out, and all others
of different classes aligned, whatever their minima.

The alignment is banded: a pair of matching shingles that lie further apart than the texts may differ at
the threshold is part of no alignment that reaches it, so only those inside the band are looked at.

Defined cases: null text is empty; a text without words is a class of its own; a text of one to four
words is one shingle; a class has the smallest id that is not null; repeated rows are equal
texts. Memory is bounded by the longest text, however long. Other columns are ignored by ``near_classes`` and kept by ``drop_near``. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .anchor_dedup import bit_map, in_map
from .common import settle
from .textvec import BASE_WORDS_2, byte_slices, inverse, mix, places, powers, window_hashes, word_slices

SHINGLE = 5
SKETCHES = 20
TAKEN = 3
#: Of the 20 minima so many at least must agree before a pivot's pair is aligned; at a similarity of 0.8, 16 do on average and 99.9 % of pairs reach 10.
#: The others are left to the prefix filter.
AGREE = 10
FILTER_MB = 32
#: Shingles that more rows than this have come last in the order of the prefix filter; this changes nothing but time.
FREQUENT = 8
#: So many pairs of a document are aligned before the prefix filter.
BEST = 4
BITMAP = 512
#: The bit of a labelled shingle that marks first occurrences; it is the lowest of the upper 32.
FIRST = np.uint64(1 << 32)


def _sequence_hash(words: np.ndarray, counts: np.ndarray, base: int) -> np.ndarray:
    """One hash of each row's whole word sequence."""
    ends = np.cumsum(counts)
    begins = ends - counts
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(base, len(words)), out=sums[1:])
    scale = powers(inverse(base), len(words) + 1)
    return mix((sums[ends] - sums[begins]) * scale[begins] + counts.astype(np.uint64))


def labelled_shingles(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles labelled with their occurrence in text order, shingles per row, two hashes of each row's
    words, and 31 bits of the shingles without labels over a lowest bit that marks first occurrences."""
    one, two = _sequence_hash(words, counts, 0x2545F4914F6CDD1D), _sequence_hash(words, counts, BASE_WORDS_2)
    row, place = places(counts)
    hashes = window_hashes(words, SHINGLE)
    fits = np.flatnonzero((counts[row] - place >= SHINGLE)[:len(hashes)]) if len(hashes) else np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    hashes, row = np.r_[hashes[fits], one[short]], np.r_[row[fits], short]
    if len(short):
        back = np.argsort(row, kind="stable")
        hashes, row = hashes[back], row[back]
    order = np.lexsort((hashes, row))  # stable, so equal shingles stay in text order
    again = np.r_[False, (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])][:len(order)]
    nth = np.arange(len(order))
    nth = nth - np.maximum.accumulate(np.where(again, 0, nth))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = nth
    labelled = mix(hashes + occurrence * np.uint64(BASE_WORDS_2))
    # the middle bit tells first occurrences from others
    labelled = np.where(occurrence == 0, labelled | FIRST, labelled & ~FIRST)
    plain = (hashes >> np.uint64(32)).astype("<u4") & ~np.uint32(1) | (occurrence == 0)
    return labelled, np.bincount(row, minlength=len(counts)), one, two, plain.astype("<u4")


def sketch_rows(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows that all have shingles: the 20 bucket keys and the 20 minima (32 bits) of each."""
    begins = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), counts)
    keys, minima = np.empty((len(counts), SKETCHES), np.uint64), np.empty((len(counts), SKETCHES), np.uint32)
    for j in range(SKETCHES):
        rank = mix(shingles ^ np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        at = np.full((len(counts), TAKEN), np.iinfo(np.int64).max)
        for k in range(TAKEN):
            least = np.minimum.reduceat(rank, begins)
            if k == 0:
                minima[:, j] = least >> np.uint64(32)
            found = np.flatnonzero(rank == least[row])
            first = np.r_[True, row[found][1:] != row[found][:-1]][:len(found)]
            found = found[first]
            found = found[counts[row[found]] > k]
            at[row[found], k] = found
            rank[found] = np.iinfo(np.uint64).max
        at.sort(axis=1)
        key = np.full(len(counts), j + 1, np.uint64)
        for k in range(TAKEN):
            has = at[:, k] < len(shingles)
            key = mix(key * np.uint64(BASE_WORDS_2) + np.where(has, shingles[np.where(has, at[:, k], 0)], np.uint64(0)))
        keys[:, j] = key
    return keys, minima


def bitmaps(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, and its bitmap as 64-bit words: bits that an odd number of them fall on."""
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.flatnonzero(shingles & FIRST)
    at = row[first] * BITMAP + (mix(shingles[first]) >> np.uint64(40)).astype(np.int64) % BITMAP
    odd = np.bincount(at, minlength=len(counts) * BITMAP) & 1
    return np.bincount(row[first], minlength=len(counts)), np.packbits(odd.astype(bool).reshape(len(counts), BITMAP), axis=1).view("<i8")


def _bitmaps_allow(a: Column, b: Column, a_distinct: Column, b_distinct: Column, threshold: float) -> Column:
    """Whether the distinct shingles of two rows can agree at the threshold, going by their bitmaps."""
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    both = a_distinct + b_distinct
    return (both - differ) / 2 >= F.lit(threshold / (1 + threshold)) * both - 1e-6


def _nodes(one: np.ndarray, two: np.ndarray) -> pa.Array:
    """The two hashes as 16 bytes: a document's node."""
    raw = np.stack([one, two], axis=1).astype("<u8").tobytes()
    return pa.Array.from_buffers(pa.binary(16), len(one), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _texts(docs: DataFrame, text_col: str, *others: Column) -> DataFrame:
    return docs.select(*others, F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, node (null without words), n (shingles), keys, minima, n_distinct, bitmap of each document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words, counts in word_slices(batch.column(1)):
                shingles, n, one, two, _ = labelled_shingles(words, counts)
                some = n > 0
                keys, minima = sketch_rows(shingles, n[some]) if some.any() else (np.zeros((0, SKETCHES), np.uint64), np.zeros((0, SKETCHES), np.uint32))
                n_distinct, bits = bitmaps(shingles, n)
                listed = lambda m, kind: pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(some)] * m.shape[1], pa.int32()), pa.array(m.ravel().view(kind)))
                node = _nodes(one, two)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.compute.if_else(pa.array(some), node, pa.scalar(None, node.type)), pa.array(n.astype(np.int64)),
                     listed(keys, np.int64), listed(minima, np.int32), pa.array(n_distinct), listed(np.ascontiguousarray(bits[some]), np.int64)],
                    names=["doc_id", "node", "n", "keys", "minima", "n_distinct", "bitmap"])

    return _texts(docs, text_col, F.col(id_col).cast("long").alias("doc_id")).mapInArrow(
        sign, "doc_id bigint, node binary, n bigint, keys array<bigint>, minima array<int>, n_distinct bigint, bitmap array<bigint>")


def _fold(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return mix(one ^ (two << np.uint64(1)))


def _node_map(nodes: DataFrame):
    """A broadcast bit map of the (distinct) nodes: bounded, may hold others by chance."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(_fold(pairs[:, 0], pairs[:, 1]).view(np.int64))], names=["h"])

    return nodes.sparkSession.sparkContext.broadcast(bit_map(nodes.select("node").mapInArrow(fold, "h bigint"), nodes.count(), FILTER_MB))


def shingle_rows(docs: DataFrame, nodes: DataFrame, text_col: str) -> DataFrame:
    """node, shingles (without labels, 32 bits each in text order), once for each of the (distinct, written) nodes, and some others."""
    wanted = _node_map(nodes)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words, counts in word_slices(batch.column(0)):
                _, n, one, two, small = labelled_shingles(words, counts)
                ends = np.cumsum(n)
                _, first = np.unique(_fold(one, two), return_index=True)
                some = first[(n[first] > 0) & in_map(wanted.value, _fold(one, two)[first])]
                yield pa.RecordBatch.from_arrays(
                    [_nodes(one[some], two[some]), pa.array([small[ends[r] - n[r]:ends[r]].tobytes() for r in some], pa.binary())], names=["node", "shingles"])

    return _texts(docs, text_col).mapInArrow(emit, "node binary, shingles binary").groupBy("node").agg(F.min("shingles").alias("shingles"))


def distinct_shingles(plain: np.ndarray) -> np.ndarray:
    """A row's distinct shingles: its first occurrences, hashed."""
    return mix((plain[plain & 1 > 0] >> 1).astype(np.uint64))


def common_subsequence(a: np.ndarray, b: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one integer
    (Hyyrö). The nth of ``a`` may match places ``low[n]`` to ``high[n]`` - 1 of ``b`` only, if given."""
    order = np.argsort(b, kind="stable")
    values, begins, counts = np.unique(b[order], return_index=True, return_counts=True)
    masks: dict[int, int | list[int]] = {}
    for value, begin, count in zip(values.tolist(), begins.tolist(), counts.tolist(), strict=True):
        at = order[begin:begin + count]
        if count > 64:
            flags = np.zeros(len(b), np.uint8)
            flags[at] = 1
            masks[value] = int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")
        else:
            masks[value] = at.tolist()  # masks of rare shingles would together take the square of the length
    every = left = (1 << len(b)) - 1
    low, high = [0] * len(a) if low is None else low.tolist(), [len(b)] * len(a) if high is None else high.tolist()
    for value, lo, hi in zip(a.tolist(), low, high, strict=True):
        mask = masks.get(value, 0)
        if isinstance(mask, list):
            mask = sum(1 << k for k in mask if lo <= k < hi)
        else:
            mask = mask >> lo << lo & (1 << hi) - 1
        met = left & mask
        left = ((left + met) | (left - met)) & every
    return len(b) - left.bit_count()


def alignment(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Similarity by the best alignment, 0 if below the threshold for sure."""
    total = len(a) + len(b)
    # matches >= t (total - matches)
    need = threshold / (1 + threshold) * total - 1e-9
    if min(len(a), len(b)) < need:
        return 0.0
    # equal beginnings and ends belong to a best alignment, and shingles of one text alone to none
    same = min(len(a), len(b))
    other = np.flatnonzero(a[:same] != b[:same])
    head = int(other[0]) if len(other) else same
    a, b, same = a[head:], b[head:], same - head
    other = np.flatnonzero(a[len(a) - same:][::-1] != b[len(b) - same:][::-1])
    tail = int(other[0]) if len(other) else same
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    at_a, at_b = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    # a match of places i and j leaves len(b) - (j - i) matches at most, or len(a) - (i - j): the band where that is enough
    right, left = len(b) - (need - head - tail), len(a) - (need - head - tail)
    a, b = a[at_a], b[at_b]
    _, times_a = np.unique(a, return_counts=True)
    _, times_b = np.unique(b, return_counts=True)
    if head + tail + np.minimum(times_a, times_b).sum() < need:
        return 0.0
    if len(times_a) == len(a) and len(times_b) == len(b):
        order = np.argsort(b)
        where = order[np.searchsorted(b[order], a)]
        beyond = at_b[where] - at_a
        where = where[(beyond <= right) & (beyond >= -left)]
        if np.all(where[1:] > where[:-1]):
            matches = len(where)
        else:
            tails: list[int] = []
            for w in where.tolist():
                k = bisect_left(tails, w)
                if k == len(tails):
                    tails.append(w)
                else:
                    tails[k] = w
            matches = len(tails)
    else:
        matches = common_subsequence(a, b, np.searchsorted(at_b, at_a - left), np.searchsorted(at_b, at_a + right, "right"))
    matches += head + tail
    return matches / (total - matches)


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether all shingles, and the first occurrences alone, align at the threshold."""
    if alignment(a >> 1, b >> 1, threshold) < threshold:
        return False
    first_a, first_b = a[a & 1 > 0], b[b & 1 > 0]
    return len(first_a) + len(first_b) == len(a) + len(b) or alignment(first_a, first_b, threshold) >= threshold


def _align(pairs: DataFrame, shingles: DataFrame, threshold: float, name: str) -> DataFrame:
    """Those of the pairs (a, b) whose alignment reaches the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [n for n, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True))
                    if similar(np.frombuffer(x.as_buffer(), "<u4"), np.frombuffer(y.as_buffer(), "<u4"), threshold)]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)], names=["a", "b"])

    side = lambda c: shingles.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_shingles"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return settle(both.select("a", "b", "a_shingles", "b_shingles").mapInArrow(verify, "a binary, b binary"), name)


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of the connected component, for nodes with edges.

    Each round takes the smallest label among the neighbours and then the label of the
    label, so a chain is halved; rounds are written, and end when no label changes."""
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "near-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        lower = settle(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "near-labels")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = settle(lower.join(jump, "label").select("node", "old", F.col("root").alias("label")), "near-labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.drop("old")


def _likely_pairs(nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, agree) of a bucket's member and one of its three pivots; node, bucket of all shared buckets."""
    by_hash = F.struct(F.xxhash64("node", "bucket").alias("h"), "node")
    buckets = nodes.select("node", F.explode("keys").alias("bucket"))
    shared = settle(buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "near-buckets")
    members = settle(buckets.join(shared, "bucket"), "near-members")
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    members = settle(members.select("node", "bucket").join(met, "node"), "near-met")
    pivots = members.groupBy("bucket").agg(
        F.max(F.struct("met", "node")).alias("most"), F.min(by_hash).alias("low"), F.max(by_hash).alias("high"))
    pivots = settle(pivots.select("bucket", F.array_distinct(F.array("most.node", "low.node", "high.node")).alias("pivots")), "near-pivots")
    held = members.select("node", "bucket").join(pivots, "bucket").select("node", F.explode("pivots").alias("pivot")).where("node <> pivot")
    pairs = settle(held.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct(), "near-pairs")
    side = lambda c: nodes.select(F.col("node").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("n", "minima", "n_distinct", "bitmap")))
    told = pairs.join(side("a"), "a").join(side("b"), "b").where(
        (F.least("a_n", "b_n") >= threshold * F.greatest("a_n", "b_n"))
        & _bitmaps_allow(F.col("a_bitmap"), F.col("b_bitmap"), F.col("a_n_distinct"), F.col("b_n_distinct"), threshold))
    agree = F.aggregate(F.zip_with("a_minima", "b_minima", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return settle(told.select("a", "b", agree.alias("agree")).where(F.col("agree") >= AGREE), "near-likely"), members.select("node", "bucket")


def _unsettled(members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, label, bitmap of the members of buckets that hold several classes."""
    told = settle(members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "near-told")
    several = told.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("bucket")
    return settle(told.join(several, "bucket").select("node", "label").distinct().join(nodes.select("node", "bitmap"), "node"), "near-unsettled")


def _frequent_map(shingles: DataFrame):
    """A broadcast bit map of the shingles that many of the rows have; bounded, may hold others by chance."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 0):
                found, n = np.unique(np.concatenate([distinct_shingles(np.frombuffer(x.as_buffer(), "<u4")) for x in part.column(0)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["h", "n"])

    often = settle(shingles.select("shingles").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where(
        F.col("n") > FREQUENT).select("h"), "near-frequent")
    return shingles.sparkSession.sparkContext.broadcast(bit_map(often, often.count(), FILTER_MB))


def prefix_pairs(unsettled: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, agree) of nodes with different labels: all that can reach the threshold, and some others;
    ``agree`` counts the shingles that both have among their first ones.

    Of n distinct shingles, a pair at threshold t shares m >= t / (1 + t) (n_a + n_b). So in any order the first
    shared one has at most n - m others before it in either text: it is among the first
    (1 - 2 t / (1 + t)) n + 1 of the shorter and the first (1 - t) n + 1 of the longer. All others that
    they share come after the last one shared among these, in both texts."""
    frequent = _frequent_map(shingles)

    def first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 3):
                sizes, found = [], []
                for x in part.column(3):
                    own = distinct_shingles(np.frombuffer(x.as_buffer(), "<u4"))
                    sizes.append(len(own))
                    order = np.lexsort((own, in_map(frequent.value, own)))
                    found.append(own[order[:int((1 - threshold) * sizes[-1] + 1e-6) + 1]])
                counts = np.array([len(f) for f in found])
                row, place = places(counts)
                n = np.array(sizes)[row]
                short = place <= (1 - 2 * threshold / (1 + threshold)) * n + 1e-6
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(row)) for c in (0, 1, 2)), pa.array(np.concatenate(found).view(np.int64)), pa.array(n), pa.array(place), pa.array(short)],
                    names=["node", "label", "bitmap", "shingle", "n", "place", "short"])

    rows = settle(unsettled.join(shingles, "node").select("node", "label", "bitmap", "shingles").mapInArrow(
        first_ones, "node binary, label binary, bitmap array<bigint>, shingle bigint, n bigint, place bigint, short boolean"), "near-prefixes")
    several = rows.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("short").alias("any")).where(
        "lo <> hi AND any").select("shingle")
    rows = settle(rows.join(several, "shingle"), "near-prefixes")
    a, b = rows.where("short").alias("a"), rows.alias("b")
    need = F.lit(threshold / (1 + threshold)) * (F.col("a.n") + F.col("b.n")) - 1e-6
    can = ((F.col("a.label") != F.col("b.label")) & ((F.col("a.n") < F.col("b.n")) | (F.col("a.n") == F.col("b.n")) & (F.col("a.node") < F.col("b.node")))
           & (F.col("a.n") - F.col("a.place") >= need) & (F.col("b.n") - F.col("b.place") >= need) & (F.col("a.n") >= need)
           & _bitmaps_allow(F.col("a.bitmap"), F.col("b.bitmap"), F.col("a.n"), F.col("b.n"), threshold))
    met = a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & can).groupBy(F.col("a.node").alias("a"), F.col("b.node").alias("b")).agg(
        F.count("*").alias("agree"), F.least(F.min(F.col("a.n") - F.col("a.place")), F.min(F.col("b.n") - F.col("b.place"))).alias("left"),
        F.first(F.col("a.n") + F.col("b.n")).alias("both"))
    enough = F.col("agree") + F.col("left") - 1 >= F.lit(threshold / (1 + threshold)) * F.col("both") - 1e-6
    return settle(met.where(enough).select("a", "b", "agree"), "near-within")


def near_nodes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Written tables: doc_id, node of each document; node, class_id, class_size, keep (the
    node of the document that stays) of each node."""
    signed = settle(signatures(docs, id_col, text_col), "near-signatures")
    nodes = settle(signed.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.min("n").alias("n"), *(F.first(c).alias(c) for c in ("keys", "minima", "n_distinct", "bitmap"))), "near-nodes")
    likely, members = _likely_pairs(nodes, threshold)
    # each document's most similar pairs; whatever else could join two classes is left to the prefix filter
    ends = likely.select(F.explode(F.array("a", "b")).alias("node"), "a", "b", "agree")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.col("agree").desc(), "a", "b"))
    best = settle(ends.withColumn("place", place).where(F.col("place") <= BEST).select("a", "b").distinct(), "near-best")
    ends = settle(best.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "near-ends")
    shingles = settle(shingle_rows(docs, ends, text_col), "near-shingles")
    links = _align(best, shingles, threshold, "near-links")
    unsettled = _unsettled(members, components(links), nodes)
    shingles = settle(shingle_rows(docs, unsettled.select("node"), text_col).join(unsettled.select("node"), "node"), "near-shingles")
    labels = components(links.union(_align(prefix_pairs(unsettled, shingles, threshold), shingles, threshold, "near-links")))
    known = nodes.select("node", "least", "copies").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = settle(known.groupBy("label").agg(
        F.min("least").alias("class_id"), F.sum("copies").alias("class_size"),
        F.min(F.struct(F.col("least").isNull(), "least", "node")).alias("k")).select("label", "class_id", "class_size", F.col("k.node").alias("keep")), "near-classes")
    return signed.select("doc_id", "node"), settle(known.select("node", "label").join(classes, "label").drop("label"), "near-result")


def near_classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), class_size."""
    signed, nodes = near_nodes(docs, threshold, id_col, text_col)
    some = signed.where("node IS NOT NULL").join(nodes, "node").select("doc_id", "class_id", "class_size")
    return some.unionByName(signed.where("node IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size")))


def drop_near(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: of each class the one with the
    smallest id (null last); of rows that tie in id and words the smallest row."""
    _, nodes = near_nodes(docs, threshold, id_col, text_col)
    grouped = settle(nodes.where("class_size > 1").select("node", "keep", "class_id"), "near-grouped")
    wanted = _node_map(grouped)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words, counts in word_slices(batch.column(1)):
                one, two = _sequence_hash(words, counts, 0x2545F4914F6CDD1D), _sequence_hash(words, counts, BASE_WORDS_2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), _nodes(one, two), pa.array((counts > 0) & in_map(wanted.value, _fold(one, two)))], names=["row", "node", "maybe"])

    packed = _texts(docs, text_col, row)
    marked = packed.mapInArrow(mark, f"row {packed.schema['row'].dataType.simpleString()}, node binary, maybe boolean")
    # rows outside the map have no copy of any kind and pass straight through
    hit = marked.where("maybe").join(grouped, "node", "left").where("keep IS NULL OR keep = node")
    alone = hit.where("keep IS NULL").select("row")
    of_id = F.col(f"row.`{id_col}`").cast("long").eqNullSafe(F.col("class_id"))
    stays = hit.where(F.col("keep").isNotNull() & of_id).groupBy("node").agg(F.min("row").alias("row")).select("row")
    return marked.where(~F.col("maybe")).select("row").union(alone).union(stays).select("row.*")
