"""Normalised characters of texts as numpy arrays: lower-case letters and single spaces.

Letters become one byte each: ASCII letters their code, others a hashed one of 128; every run of other
characters becomes one space (byte 32). Work goes in slices, so memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE = 1 << 18


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    table = np.full(1 << 16, 32, np.uint8)
    for code in range(1 << 16):
        char = chr(code)
        if char.isalpha():
            low = ord(char.lower()[0])
            table[code] = low if low < 128 else 128 + (low * 0x9E37 >> 4) % 128
    table[0] = 0
    return table


def char_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, symbols, symbols per row) for slices of a string column without nulls."""
    waiting: list[str] = []
    size, begin = 0, 0

    def flush(end: int):
        raw = np.frombuffer("\0".join(t.replace("\0", " ") for t in waiting).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols = _symbols()[np.minimum(raw, 0xFFFF)]
        symbols = np.where(raw > 0xFFFF, np.uint8(255), symbols)
        parts = symbols == 0
        blank = (symbols == 32) & np.r_[True, (symbols[:-1] == 32) | parts[:-1]][:len(symbols)]
        keep = ~blank
        row = np.cumsum(parts)
        counts = np.bincount(row[keep & ~parts], minlength=len(waiting)) if len(raw) else np.zeros(len(waiting), np.int64)
        return begin, end, symbols[keep & ~parts], counts

    for n, text in enumerate(column):
        waiting.append(text.as_py())
        size += len(waiting[-1])
        if size >= SLICE:
            yield flush(n + 1)
            waiting, size, begin = [], 0, n + 1
    if waiting:
        yield flush(len(column))


def shifted(symbols: np.ndarray, place: np.ndarray, back: int) -> np.ndarray:
    """The symbol ``back`` places before each in its text; spaces stand before a text."""
    out = np.full(len(symbols), 32, np.uint64)
    if back < len(symbols):
        out[back:] = symbols[:len(symbols) - back] if back else symbols
    out[place < back] = 32
    return out
