"""Quality rules and repetition inside a text, by suffix arrays.

The suffix array of a text's words orders all its suffixes; the longest common prefix
of neighbours in that order bounds the intervals of suffixes that begin alike. The
deepest interval of a suffix gives the longest passage that begins there and occurs
again; a passage that the word before would prolong lies in that one's span, so the
union of these spans is the union of the maximal repeated passages.

A slice of a batch holds many texts. They share one array: a word's first rank holds
its text, so suffixes of different texts never tie, and only tied suffixes are ranked
again in each doubling round. The equal-rank tables of the rounds then give the common
prefixes, also by doubling. Equal words are told by a 64-bit hash.

A text is rejected if the base rules fail or if the repeated passages of at least
``min_words`` words cover more than ``max_covered`` of its words or one of them is
longer than ``max_longest`` words.

Results for special cases: a null or empty text has no words and fails the base rules.
Repeated rows are judged each for itself. Whole texts are used; one very long text is a
slice of its own, and its suffix array needs some 50 bytes for each of its bytes. An empty table
gives no rows. Columns beside the two named have no influence; ``keep_good`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import flat


@dataclass(frozen=True)
class Limits:
    """Base rules: least words, window of ``n_repeat_words``, percent of such words.
    The method: least words of a passage, covered fraction (percent), longest passage."""

    least_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    min_words: int = 5
    max_covered_percent: int = 30
    max_longest: int = 100


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long, base_failed boolean, kept boolean"


def repeat_lengths(key: np.ndarray, text_end: np.ndarray) -> np.ndarray:
    """For each word, how many words from it on occur again in its text.

    ``key``: equal for equal words of one text only; ``text_end``: the index after the
    last word of each word's text.
    """
    n = len(key)
    longest = np.zeros(n, np.int64)
    if not n:
        return longest
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order[1:]] != key[order[:-1]])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.repeat(first, size)
    rank[n] = -1
    tables = [rank.copy()]
    active = order[np.repeat(size > 1, size)]
    width = 1
    while len(active):
        after = active + width
        second = np.where(after < text_end[active], rank[np.minimum(after, n)], -1)
        by = np.lexsort((second, rank[active]))
        active, second = active[by], second[by]
        old = rank[active]
        group = np.append(True, old[1:] != old[:-1])
        part = group.copy()
        part[1:] |= second[1:] != second[:-1]
        begin = np.flatnonzero(part)
        size = np.diff(np.append(begin, len(active)))
        group_begin = np.maximum.accumulate(np.where(group, np.arange(len(active)), 0))
        rank[active] = np.repeat(old[begin] + begin - group_begin[begin], size)
        active = active[np.repeat(size > 1, size)]
        width *= 2
        tables.append(rank.copy())
    place = np.empty(n, np.int64)
    place[rank[:n]] = np.arange(n)
    tied = tables[0][place[1:]] == tables[0][place[:-1]]
    a, b = place[:-1][tied], place[1:][tied]
    common = np.zeros(len(a), np.int64)
    end_a, end_b = text_end[a], text_end[b]
    for step in range(len(tables) - 1, -1, -1):
        at_a, at_b = np.minimum(a + common, n), np.minimum(b + common, n)
        same = (a + common < end_a) & (b + common < end_b) & (tables[step][at_a] == tables[step][at_b])
        common += same.astype(np.int64) << step
    np.maximum.at(longest, a, common)
    np.maximum.at(longest, b, common)
    return longest


def covered(longest: np.ndarray, least: int, text: np.ndarray, n: int) -> np.ndarray:
    """Words in the union of the repeated passages of ``least`` words or more, by text."""
    at = np.flatnonzero(longest >= least)
    change = np.zeros(len(longest) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + longest[at], -1)
    return np.bincount(text[np.cumsum(change[:-1]) > 0], minlength=n)


def measure(data: np.ndarray, offsets: np.ndarray, limits: Limits = Limits()) -> dict[str, np.ndarray]:
    """The columns of COLUMNS for a slice of texts."""
    n = len(offsets) - 1
    starts, ends, text = flat.words(data, offsets)
    n_words = np.bincount(text, minlength=n)
    point = (data & 0xC0) != 0x80
    in_word = np.flatnonzero(point & ~flat.IS_SPACE[data])
    symbols = np.flatnonzero(_SYMBOL[data])
    # lines with a word, less the distinct ones among them
    l_start, l_end = flat.spans_between(data == 10, offsets)
    l_words = np.searchsorted(starts, l_end) - np.searchsorted(starts, l_start)
    l_start, l_end = l_start[l_words > 0], l_end[l_words > 0]
    l_text = flat.owner(offsets, l_start)
    l_key = flat.mix(flat.span_hash(data, l_start, l_end) + l_text.astype(np.uint64))
    l_first, _ = flat.distinct(l_key)
    n_dup = np.bincount(l_text, minlength=n) - np.bincount(l_text[l_first], minlength=n)

    key = flat.mix(flat.span_hash(data, starts, ends) + text.astype(np.uint64))
    text_end = np.cumsum(n_words)[text]
    longest = repeat_lengths(key, text_end)
    n_repeat = covered(longest, limits.window, text, n)
    n_covered = covered(longest, limits.min_words, text, n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, text, longest)
    base_failed = (n_words < limits.least_words) | (100 * n_repeat > limits.max_repeat_percent * n_words)
    rejected = (100 * n_covered > limits.max_covered_percent * n_words) | (top > limits.max_longest)
    return {
        "n_words": n_words,
        "word_chars": np.bincount(flat.owner(offsets, in_word), minlength=n),
        "n_symbols": np.bincount(flat.owner(offsets, symbols), minlength=n),
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "covered_words": n_covered,
        "longest_repeat": top,
        "base_failed": base_failed,
        "kept": ~(base_failed | rejected),
    }


def _measured(batch: pa.RecordBatch, column: int, limits: Limits) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    data, offsets = flat.text_bytes(batch.column(column))
    for lo, hi, part, off in flat.slices(data, offsets):
        yield lo, hi, measure(part, off, limits)


def quality(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id and COLUMNS. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, got in _measured(batch, 1, limits):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(pa.array(x.astype(bool if x.dtype == bool else np.int64)) for x in got.values())], names=["doc_id", *got])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {COLUMNS}")


def keep_good(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that pass the rules."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, got in _measured(batch, at, limits):
                yield batch.slice(lo, hi - lo).filter(pa.array(got["kept"]))

    return docs.mapInArrow(run, docs.schema)
