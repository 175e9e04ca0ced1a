"""Flat numpy views of a text column.

A batch of texts is one array of bytes plus offsets, as Arrow stores it. Words, lines
and chunks are (start, end) spans of that array; equal spans are found by a 64-bit
hash and worked on once. No step loops over characters in Python.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: The separators of ``[^\x20\x09-\x0D]+``.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

#: Bytes hashed at once.
HASH_BYTES = 1 << 18

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 2 * len(_powers), 4096), _BASE, np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver has
    it, whatever their working folder. A cluster's executors need it installed."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    held = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in held:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, held)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Free memory goes back to the machine: a worker lives on after its task, beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim is not None:
        trim(0)


def slices(data: np.ndarray, offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of about ``size`` bytes each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
    if n and offsets[-1] > SLICE_BYTES:
        give_back()


def cuts(data: np.ndarray, is_cut: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive windows of one text, of about ``size`` bytes: each but the last ends
    after a byte marked in ``is_cut`` (by byte value), the next such byte where there is
    none in ``size`` bytes."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + size, n)
        if hi < n:
            found = np.flatnonzero(is_cut[data[lo:hi]])
            if len(found):
                hi = lo + int(found[-1]) + 1
            else:
                while hi < n and not is_cut[data[hi - 1]]:
                    more = np.flatnonzero(is_cut[data[hi : hi + size]])
                    hi = hi + int(more[0]) + 1 if len(more) else min(hi + size, n)
        yield lo, hi
        lo = hi


def row_slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each, one row at least."""
    _, offsets = text_bytes(batch.column(column))
    for lo, hi, _, _ in slices(np.zeros(0, np.uint8), offsets, size):
        yield batch.slice(lo, hi - lo)


def spans_between(cut: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans without bytes marked in ``cut``; none crosses a text's end."""
    inside = ~cut
    first, last = inside.copy(), inside.copy()
    first[1:] &= cut[:-1]
    last[:-1] &= cut[1:]
    at = offsets[1:-1]
    at = at[(at > 0) & (at < len(cut))]
    first[at] = inside[at]
    last[at - 1] = inside[at - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words ``[^\\x20\\x09-\\x0D]+``."""
    starts, ends = spans_between(IS_SPACE[data], offsets)
    return starts, ends, owner(offsets, starts)


def owner(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of the text that holds each byte position."""
    return np.searchsorted(offsets, at, "right") - 1


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the spans, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty span's bytes. Spans of about ``HASH_BYTES`` are
    hashed at once, a longer one in parts of that size."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    upto, lo = np.cumsum(lengths), 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - lengths[lo] + HASH_BYTES, "right")))
        if upto[hi - 1] - upto[lo] + lengths[lo] <= HASH_BYTES:
            n = lengths[lo:hi]
            begin = np.cumsum(n) - n
            at = np.arange(int(n.sum())) - np.repeat(begin, n)
            terms = _BYTE[data[at + np.repeat(starts[lo:hi], n)]] * powers(int(n.max()))[at]
            out[lo:hi] = np.add.reduceat(terms, begin)
        else:
            total, factor = 0, 1
            for a in range(int(starts[lo]), int(ends[lo]), HASH_BYTES):
                part = data[a : min(a + HASH_BYTES, int(ends[lo]))]
                total += factor * int((_BYTE[part] * powers(len(part))[: len(part)]).sum())
                factor = factor * pow(int(_BASE), HASH_BYTES, 1 << 64) % (1 << 64)
            out[lo] = total % (1 << 64)
        lo = hi
    return mix(out + lengths.astype(np.uint64) * _BASE)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one holder of each distinct hash, and each element's distinct number."""
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return first, inverse


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The concatenated payloads ``values[starts[w]:][:lengths[w]]`` for w in ``which``."""
    return values[ragged(starts[which], lengths[which])]


def totals(per_item: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Sums of non-negative per-item integers by text number."""
    return np.bincount(text, weights=per_item, minlength=n).astype(np.int64)
