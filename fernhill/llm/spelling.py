"""Spelling variants grouped through PartEnum signatures of letter multisets.

Words are maximal runs of letters of whole texts, counted over all documents. A word is
near another if one inserted, deleted or replaced code point turns it into the other. Such words have
letter multisets that, as binary vectors over (letter, which occurrence of it),
differ in at most two places. PartEnum (Arasu, Ganti, Kaushik) splits the places into
parts and enumerates which of them may differ: words at a Hamming distance of at most two agree in all
but two of the second-level parts of some first-level part, so a word's signatures are the
hashes of its vector on all such choices of parts. An equi-join of equal signatures gives
all candidates, and the edit distance is verified in the join itself.

Signatures that many words share (few letters, much used ones) are not joined word by
word: there, a word is joined on the signature and half of its text, since one
edit leaves the first or the second half of both words equal. That split is exact and only saves time.

A word's form is its most frequent near word, if at least twice as frequent; following
forms leads to the root. Frequencies double at each step, so chains are short; they are
followed by pointer doubling.

Defined cases: null text has no words; a null id counts as the text ``null``; repeated rows count as
often as they occur; equal frequencies go to the smallest word in code-point order. Texts are
cut into parts between runs, so memory is bounded by the longest run of letters, however long a text is.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle
from .textvec import mix, places

#: Fixed value: the letters of a run, once A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
#: Code points of text that are searched at a time.
PART = 1 << 20
#: Words that a task counts before it hands them on; this changes nothing but time.
HELD = 200_000


@dataclass(frozen=True)
class SpellingParams:
    shortest: int = 5
    least: int = 3
    #: One in so many (document, run) pairs loses a code point.
    slips: int = 97
    #: PartEnum: first-level parts, and second-level parts in each.
    outer: int = 1
    inner: int = 6
    #: A signature of more words than this is split by halves of the words.
    split_above: int = 64


def _parts(text: str, gap: re.Pattern) -> Iterator[str]:
    at = 0
    while at < len(text):
        cut = gap.search(text, at + PART)
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop


def word_counts(docs: DataFrame, params: SpellingParams = SpellingParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words that occur often enough, over all documents."""
    # a slip shortens a run, so runs below the shortest word never become one
    run, gap = re.compile(f"[{LETTERS}]{{{params.shortest},}}"), re.compile(f"[^{LETTERS}]")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for did, text in zip(batch.column(0), batch.column(1), strict=True):
                begin = zlib.crc32(f"{did.as_py()}:".encode())
                for part in _parts(text.as_py().encode().lower().decode(), gap):  # lower() of bytes changes A-Z alone
                    for word, n in Counter(run.findall(part)).items():
                        h = zlib.crc32(word.encode(), begin)
                        if h % params.slips == 0:
                            k = h % len(word)
                            word = word[:k] + word[k + 1:]
                            if len(word) < params.shortest:
                                continue
                        held[word] += n
                    if len(held) >= HELD:
                        yield flush()
        yield flush()

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= params.least)


def letter_vectors(words: list[str], parts: int) -> np.ndarray:
    """One hash per word and part: of the (letter, occurrence) places that fall into the part."""
    counts = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    row, _ = places(counts)
    order = np.lexsort((letters, row))
    again = np.r_[False, (letters[order][1:] == letters[order][:-1]) & (row[order][1:] == row[order][:-1])][:len(order)]
    at = np.arange(len(order))
    occurrence = (at - np.maximum.accumulate(np.where(again, 0, at))).astype(np.uint64)
    place = mix((letters[order] << np.uint64(20)) + occurrence + np.uint64(1))
    out = np.zeros((len(words), parts), np.uint64)
    # a set's hash is the sum of its members' hashes
    np.add.at(out, (row[order], (place % np.uint64(parts)).astype(np.int64)), mix(place))
    return out


def signatures(words: list[str], outer: int = 1, inner: int = 6, distance: int = 2) -> np.ndarray:
    """PartEnum signatures: one line per word, equal in some column if the letter
    multisets differ in at most ``distance`` places."""
    vectors = letter_vectors(words, outer * inner).reshape(len(words), outer, inner)
    # of the first-level parts one has at most distance // outer of the differences
    differing = distance // outer
    columns = []
    for part in range(outer):
        for kept in combinations(range(inner), inner - differing):
            key = np.full(len(words), len(columns) + 1, np.uint64)
            for k in kept:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + vectors[:, part, k])
            columns.append(key)
    return np.stack(columns, axis=1)


def _halves(word: Column) -> Column:
    """Keys of which two words one edit apart share the one for the length of the shorter:
    the first half of its length from the front, or the rest of it from the back."""
    size = F.length(word)
    front = lambda m: F.floor(m / 2).cast("int")
    key = lambda m, side, text: F.struct(m.alias("m"), F.lit(side).alias("side"), text.alias("text"))
    return F.array(*(k for m in (size, size - 1) for k in (
        key(m, 0, F.substring(word, F.lit(1), front(m))), key(m, 1, F.right(word, m - front(m))))))


def near_pairs(words: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """All pairs (a, a_n, b, b_n), a < b, of near words of ``words`` (word, n)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 13):
                part = batch.slice(at, 1 << 13)
                found = signatures(part.column(0).to_pylist(), params.outer, params.inner)
                again = pa.array(np.repeat(np.arange(part.num_rows), found.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.ravel().view(np.int64)), part.column(0).take(again), part.column(1).take(again)], names=["signature", "word", "n"])

    signed = settle(words.select("word", "n").mapInArrow(sign, "signature bigint, word string, n bigint"), "spelling-signatures")
    crowded = settle(signed.groupBy("signature").agg(F.count("*").alias("size")).where(F.col("size") > params.split_above).select("signature"), "spelling-crowded")

    def joined(rows: DataFrame, *keys: str) -> DataFrame:
        a, b = rows.alias("a"), rows.alias("b")
        same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
        near = (F.col("a.word") < F.col("b.word")) & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
        return a.join(b, [*same, near]).select(F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n"))

    plain = signed.join(crowded, "signature", "left_anti")
    split = signed.join(crowded, "signature").withColumn("half", F.explode(_halves(F.col("word")))).select(
        F.xxhash64("signature", "half").alias("signature"), "word", "n")
    return joined(plain, "signature").union(joined(split, "signature")).distinct()


def follow(links: DataFrame) -> DataFrame:
    """word, root for ``links`` (word, form) without circles: the last word of each chain."""
    roots = settle(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        beyond = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = settle(roots.join(beyond, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.drop("moved")


def spelling_groups(docs: DataFrame, params: SpellingParams = SpellingParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = settle(word_counts(docs, params, id_col, text_col), "spelling-words")
    pairs = settle(near_pairs(words, params), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    has_form = -F.col("best.less") >= 2 * F.col("n")
    told = settle(words.join(best, "word", "left").select(
        "word", F.when(has_form, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = follow(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
