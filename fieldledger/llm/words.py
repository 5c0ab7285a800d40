"""Words of Arrow texts as numpy arrays: starts, ends and 64-bit codes, without a Python object per word.

A word's code is a polynomial over random numbers given to its bytes, modulo 2**64, taken from one running
sum over the buffer, and then mixed. Texts are handled in pieces of about a megabyte, cut between words, so
memory does not follow the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
ASCII_SPACE = b" \t\n\x0b\x0c\r"
# Odd multipliers, one for each independent code of a word.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(BASES[0]) + np.uint64(seed * 7919))


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=4)
def _tables(seed: int, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the bytes, powers of the base and of its inverse."""
    of_byte = numbers(256, seed + 1)
    if lower:
        of_byte[65:91] = of_byte[97:123]
    base = BASES[seed % len(BASES)]
    return of_byte, powers(base, 2 * PIECE), powers(pow(base, -1, 1 << 64), 2 * PIECE)


@lru_cache(maxsize=4)
def _in_word(separators: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(separators, dtype=np.uint8)] = False
    return table


@dataclass
class Words:
    """Words of consecutive texts; those of text ``i`` are at ``first[i]`` up to ``first[i + 1]``."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    # Codes of the words' first bytes, for each length asked for; 0 for words that are not longer.
    prefix: list[np.ndarray]


def buffers(texts: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of texts, if asked in Unicode lower case; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if fold:
        texts = pc.utf8_lower(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def row_blocks(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or of one row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def _piece(data, lows, highs, seed, lower, inside, prefixes) -> tuple[np.ndarray, ...]:
    """Words of one piece; ``lows`` and ``highs`` are where texts begin and end in it."""
    of_byte, up, down = _tables(seed, lower)
    if len(data) >= len(up):  # one word longer than a piece
        base = BASES[seed % len(BASES)]
        up, down = powers(base, len(data) + 1), powers(pow(base, -1, 1 << 64), len(data) + 1)
    own = inside[data]
    before = np.empty_like(own)
    before[0], before[1:] = False, own[:-1]
    before[lows[lows < len(data)]] = False
    start = np.flatnonzero(own & ~before)
    after = np.empty_like(own)
    after[-1], after[:-1] = False, own[1:]
    after[highs[highs > 0] - 1] = False
    end = np.flatnonzero(own & ~after) + 1
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(of_byte[data] * up[: len(data)], out=total[1:])
    code = (total[end] - total[start]) * down[start]
    begins = []
    for size in prefixes:
        part = (total[np.minimum(start + size, end)] - total[start]) * down[start]
        begins.append(np.where(end - start > size, mix(part ^ np.uint64(size)), np.uint64(0)))
    return start, end, mix(code + (end - start).astype(np.uint64)), *begins


def _cut(data, offsets, inside, at: int, stop: int, limit: int) -> int:
    """Where the piece that begins at ``at`` ends: between words or texts, soon after ``limit`` bytes."""
    cut = at + limit
    if cut >= stop:
        return stop
    back = max(at, cut - 4096)
    gap = np.flatnonzero(~inside[data[back:cut]])
    text = int(offsets[np.searchsorted(offsets, cut, side="right") - 1])
    best = max(text, back + int(gap[-1]) + 1 if len(gap) else 0)
    if best > at:
        return best
    while cut < stop:  # inside a long word
        step = min(cut + limit, stop)
        text = int(offsets[np.searchsorted(offsets, cut)])
        gap = np.flatnonzero(~inside[data[cut:step]])
        if len(gap) or text <= step:
            return min(text, cut + int(gap[0]) + 1 if len(gap) else text)
        cut = step
    return stop


def words_of(
    data: np.ndarray,
    offsets: np.ndarray,
    lower: bool = False,
    seed: int = 0,
    separators: bytes = ASCII_SPACE,
    prefixes: tuple[int, ...] = (),
    limit: int = PIECE,
) -> Words:
    """Words between ``separators`` of the texts at ``offsets``; ``lower`` makes A-Z equal to a-z."""
    inside = _in_word(separators)
    base, stop = int(offsets[0]), int(offsets[-1])
    parts, at = [], base
    while at < stop:
        cut = _cut(data, offsets, inside, at, stop, limit)
        edges = offsets[(offsets >= at) & (offsets <= cut)] - at
        start, end, *codes = _piece(data[at:cut], edges, edges, seed, lower, inside, prefixes)
        parts.append((start + at, end + at, *codes))
        at = cut
    if parts:
        start, end, code, *begins = (np.concatenate(x) for x in zip(*parts, strict=True))
    else:
        start = end = np.zeros(0, np.int64)
        code, *begins = (np.zeros(0, np.uint64) for _ in range(1 + len(prefixes)))
    return Words(np.searchsorted(start, offsets), start, end, code, begins)


def windows(code: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Codes of all runs of ``length`` consecutive words, across texts too; the caller leaves those out."""
    count = len(code) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    factors = numbers(length, seed + 101) | np.uint64(1)
    out = code[:count] * factors[0]
    for k in range(1, length):
        out += code[k : k + count] * factors[k]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def lists_of(values: np.ndarray, first: np.ndarray) -> pa.ListArray:
    """An Arrow list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values))


def columns(values: dict[str, np.ndarray | list | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        v.cast(f.type) if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, f.type)
        for f, v in ((f, values[f.name]) for f in schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
