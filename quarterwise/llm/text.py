"""Vectorised work on columns of texts inside a task: bytes, words, hashes of words and shingles.

Everything here sees one Arrow slice of bounded size at a time; Spark does the rest.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes worked on at once, unless a single text is longer.
SLICE_BYTES = 1 << 20

SPACES = [9, 10, 11, 12, 13, 32]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[SPACES] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ROOT = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_ROOT), -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of the texts or binaries, cut so that their bytes stay near `most`. Null texts are empty.

    At the end, memory that the slices took goes back to the system: workers live on between tasks.
    """
    try:
        yield from _slices(batches, text, most)
    finally:
        release()


def release() -> None:
    """Give freed memory back: Arrow's pool and, with glibc, the heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _slices(batches: Iterable[pa.RecordBatch], text: str, most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
        data = column.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        row = 0
        while row < len(column):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
            yield batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end


@dataclass
class Words:
    """Words of a slice: first byte, end byte and text number of each, and `first[i]:first[i+1]` are those of text i."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = IS_SPACE) -> Words:
    """Maximal runs of bytes that are not `space`, never across two texts."""
    inside = ~space[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = offsets[1:] > offsets[:-1]
    before[offsets[:-1][filled]] = False
    after[offsets[1:][filled] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(offsets, start, "right") - 1
    return Words(start, end, text, np.searchsorted(start, offsets))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        size = max(n, 2 * SLICE_BYTES)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        _powers[name] = known = np.multiply.accumulate(known)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mix of 64-bit values, so that low bits depend on all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    """A 64-bit hash of each word, from prefix sums of a rolling polynomial."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _power("up", _ROOT, len(data)), out=sums[1:])
    down = _power("down", _INVERSE, len(data) + 1)
    return mixed((sums[w.end] - sums[w.start]) * down[w.start] + (w.end - w.start).astype(np.uint64))


def windows(hashes: np.ndarray, w: Words, size: int, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, first word) of all `size`-word windows; with `short`, a text of fewer words has one of all its words."""
    n = len(hashes)
    out = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        out = mixed(out + hashes[k : n - size + 1 + k] * np.uint64(2 * k + 0x9E3779B1)) if n >= size else out
    at = np.flatnonzero(w.text[: len(out)] == w.text[size - 1 :]) if len(out) else np.zeros(0, np.int64)
    values, texts = out[at], w.text[at]
    counts = np.diff(w.first)
    few = np.flatnonzero((counts > 0) & (counts < size)) if short else np.zeros(0, np.int64)
    if len(few):
        whole = np.zeros(len(few), np.uint64)
        for k in range(size - 1):
            on = counts[few] > k
            whole[on] = mixed(whole[on] + hashes[w.first[few[on]] + k] * np.uint64(2 * k + 0x85EBCA6B))
        values, texts, at = np.concatenate([values, mixed(whole + np.uint64(1))]), np.concatenate([texts, few]), np.concatenate([at, w.first[few]])
        order = np.argsort(texts, kind="stable")
        values, texts, at = values[order], texts[order], at[order]
    return values, texts, at


def distinct_per_text(values: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, texts in order."""
    order = np.lexsort((values, texts))
    values, texts = values[order], texts[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    return values[new], texts[new]


def longs(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed ones that Spark has."""
    return x.astype(np.uint64).view(np.int64)
