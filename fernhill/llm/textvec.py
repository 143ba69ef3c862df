"""Word hashes of Arrow text columns with numpy: no Python object per word.

Words are the runs of bytes outside [\x20\x09-\x0D]; a hash is a polynomial over its bytes
modulo 2^64, mixed. Windows of consecutive words get a polynomial over the word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text is worked on in slices of about so many bytes, so memory is bounded by the longest document.
SLICE = 1 << 18
BASE_BYTES, BASE_WORDS, BASE_WORDS_2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64, kept and grown."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _hash_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and byte place of each word; a word ends where its document ends."""
    if len(buf) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = _IS_SPACE[buf]
    word = ~space
    filled = offsets[:-1] < offsets[1:]
    first = word.copy()
    first[1:] &= space[:-1]
    begins = offsets[:-1][filled]
    first[begins] = word[begins]
    last = word.copy()
    last[:-1] &= space[1:]
    ends = offsets[1:][filled] - 1
    last[ends] = word[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(BASE_BYTES, len(buf)), out=sums[1:])
    raw = (sums[stops] - sums[starts]) * powers(inverse(BASE_BYTES), len(buf))[starts]
    return mix(raw + (stops - starts).astype(np.uint64)), starts


def word_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, words per row) for slices of the rows. A
    document longer than a slice comes alone; it is hashed in parts cut at white space."""
    data, offsets = text_bytes(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        buf = data[offsets[i]:offsets[j]]
        if len(buf) <= 2 * SLICE:
            hashes, starts = _hash_words(buf, offsets[i:j + 1] - offsets[i])
            counts = np.diff(np.searchsorted(starts, offsets[i:j + 1] - offsets[i]))
        else:
            parts, at = [], 0
            while at < len(buf):
                stop = min(len(buf), at + SLICE)
                while stop < len(buf) and not _IS_SPACE[buf[stop]]:
                    nearest = np.flatnonzero(_IS_SPACE[buf[stop:stop + SLICE]])
                    stop = stop + int(nearest[0]) if len(nearest) else min(len(buf), stop + SLICE)
                parts.append(_hash_words(buf[at:stop], np.array([0, stop - at]))[0])
                at = stop
            hashes = np.concatenate(parts)
            counts = np.array([len(hashes)])
        yield i, j, hashes, counts
        i = j


def byte_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about SLICE bytes in a binary column, of one row at least."""
    _, offsets = text_bytes(batch.column(column))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def window_hashes(words: np.ndarray, size: int, base: int = BASE_WORDS) -> np.ndarray:
    """Hash of each run of ``size`` words, also of runs that cross documents."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(base, len(words)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(inverse(base), len(words))[:len(words) - size + 1])


def places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items that lie row by row: each one's row and place in it."""
    row = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    return row, np.arange(len(row)) - begin[row]
