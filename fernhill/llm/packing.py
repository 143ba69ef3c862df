"""Best-fit packing of token pieces by the sum-of-squares rule.

Each document is its token ids plus an end id. Longer ones are cut into pieces of the
capacity, the first of which takes the remainder. A piece that fills a sequence is one
by itself. The others are dealt evenly over tasks of about ``per_task`` pieces; each task
places its pieces, longest first, into the open sequence for which the sum over residual
gaps of the squared number of open sequences with that gap becomes smallest, and opens
a sequence only where no open one has room. So each task leaves about one sequence unfilled.

Defined cases: null text is an empty one, that is the end id alone; a null or repeated
doc_id is packed like any other; an empty table gives an empty result. A text that
holds an added token of the tokenizer file gets its id there. Memory is bounded by the longest text. Other columns of the documents are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

# Fixed value: the published byte-level pre-tokenizer pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable Latin-1
    characters for themselves, the others for code points from 256 on."""
    printable = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class TextEncoder:
    """Ids of whole texts as ``tokenizers`` gives them, as little-endian unsigned 32-bit bytes.

    The vocabulary is read with ``tokenizers``; since its ids are ranks, ``tiktoken`` merges
    by it in a fraction of the time. Texts that hold an added token go through ``tokenizers`` itself."""

    def __init__(self, tokenizer_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): n for token, n in self.tokenizer.get_vocab(with_added_tokens=False).items()
                 if all(c in alphabet for c in token) and not (token.startswith("<|") and token.endswith("|>"))}
        self.ids = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def encode(self, text: str) -> bytes:
        if self.added is not None and self.added.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.ids(text), "<u4").tobytes()


@lru_cache(maxsize=1)
def encoder_of(tokenizer_path: str) -> TextEncoder:
    """A Python worker keeps its encoder from task to task."""
    return TextEncoder(tokenizer_path)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    end = np.array([end_id], "<u4").tobytes()
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[list] = [[] for _ in range(6)]
                for n, text in enumerate(part.column(1)):
                    ids = encoder.encode(text.as_py()) + end
                    count = len(ids) // 4
                    stop, start, piece = (count - 1) % capacity + 1, 0, 0
                    while start < count:
                        own = ids[4 * start:4 * stop]
                        for column, value in zip(rows, (n, piece, start, stop - start, zlib.crc32(own)), strict=False):
                            column.append(value)
                        if with_ids:
                            rows[5].append(np.frombuffer(own, "<u4").astype(np.int32))
                        start, stop, piece = stop, stop + capacity, piece + 1
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][:4 + with_ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows[0], pa.int64())), *(pa.array(r, k) for r, k in zip(rows[1:], kinds, strict=False))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])

    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        cut, schema + ", ids array<int>" * with_ids)


def place_by_squares(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each length (from 1 to the capacity) by the sum-of-squares rule.

    Moving an open bin from gap g to g - s changes the sum of squares by
    2 (N[g - s] - N[g] + 1), or by 1 - 2 N[g] if it is full then.
    """
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    bin_of, bins = np.empty(len(lengths), np.int64), 0
    for at in np.argsort(-lengths, kind="stable"):
        s = int(lengths[at])
        room = np.flatnonzero(count[s:capacity])  # gaps that are left in open bins with room
        if len(room):
            change = 2 * (count[room] - count[room + s] + 1)
            if room[0] == 0:
                change[0] -= 1
            left = int(room[np.argmin(change)])
            b = by_gap[left + s].pop()
            count[left + s] -= 1
        else:
            left, b, bins = capacity - s, bins, bins + 1
        bin_of[at] = b
        if left:
            by_gap[left].append(b)
            count[left] += 1
    return bin_of


def pack_pieces(pieces: DataFrame, capacity: int = 2048, per_task: int = 8192) -> DataFrame:
    """``pieces`` (written, with a length from 1 to the capacity) plus sequence_id and offset."""
    names = pieces.columns
    numbered = pieces.withColumn("_item", F.monotonically_increasing_id())
    full = numbered.where(F.col("length") >= capacity).select(
        *names, (-1 - F.col("_item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    small = numbered.where(F.col("length") < capacity)
    tasks = max(1, -(-small.count() // per_task))
    dealt = small.withColumn("_task", F.pmod(F.xxhash64("_item"), F.lit(tasks)).cast("int")).repartition(tasks, "_task")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got:
            return
        rows = pa.Table.from_batches(got).sort_by([("_task", "ascending"), ("_item", "ascending")]).combine_chunks()
        task, lengths = rows["_task"].to_numpy(), rows["length"].to_numpy()
        for own in np.unique(task):
            lo, hi = np.searchsorted(task, [own, own + 1])
            part = lengths[lo:hi]
            bins = place_by_squares(part, capacity)
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(part[order])
            starts = ends - part[order]
            first = np.r_[True, np.diff(bins[order]) > 0]
            offset = np.empty(len(part), np.int64)
            offset[order] = starts - np.maximum.accumulate(np.where(first, starts, 0))
            table = rows.slice(lo, hi - lo).select(names).append_column("sequence_id", pa.array(bins + (int(own) << 32)))
            yield from table.append_column("offset", pa.array(offset)).combine_chunks().to_batches()

    return dealt.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint").unionByName(full)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """All documents packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_pieces(settle(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids), "pieces"), capacity)
