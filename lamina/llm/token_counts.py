"""Exact token counts at every prefix of a text, by dynamic programming.

A list of pieces is what the model makes of their text exactly if each piece, and
each pair of neighbours, is what the model makes of it alone: the first merge across
a border would also be made in the pair alone. So the encoding of a prefix is that of
a shorter prefix plus one piece that agrees with the piece before it, and

    count[j] = count[j - len(piece)] + 1

for the one piece that ends at j and agrees. The counts of all prefixes of a text
follow from its chunks: the counts of the chunks before, plus that of the chunk's own
prefix. They answer how many tokens a text or any prefix has and how long a prefix a
budget allows, without encoding again. Counts do not rise with every character, so a
budget's answer is the longest prefix whose count is within it.

Results for special cases: null and empty texts have 0 tokens and a prefix of length 0
for every budget. Repeated rows and further columns have no influence. Texts are never
cut; a run without blanks costs some 20 microseconds a character. An empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.llm.piece_codec import encode_chunks, merge_long
from lamina.llm.pieces import MARK, PieceModel, chunks, default_path, model


#: Longer chunks are counted one by one; the others place by place, all at once.
LONG_CHUNK = 64
_CACHE_BITS = 21


class _Tables:
    """Pieces by their ends (a trie read backwards), and which pieces stand alone."""

    def __init__(self, m: PieceModel):
        self.by_last: dict[str, list[int]] = {}
        states, self.piece = {"": 0}, [-1]
        keys, to = [], []
        for p, i in m.ids.items():
            self.by_last.setdefault(p[-1], []).append(len(p))
            for k in range(1, len(p) + 1):
                if p[-k:] not in states:
                    states[p[-k:]] = len(self.piece)
                    self.piece.append(-1)
                    keys.append(states[p[len(p) - k + 1 :]] << 21 | ord(p[-k]))
                    to.append(states[p[-k:]])
            self.piece[states[p]] = i
        self.piece = np.array(self.piece, np.int32)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.to = np.array(keys, np.int64)[order], np.array(to, np.int32)[order]
        self.by_last = {c: sorted(set(n), reverse=True) for c, n in self.by_last.items()}
        listed = list(m.ids.values())
        ids, count = encode_chunks(m, [m.pieces[i] for i in listed])
        first = ids[np.cumsum(count) - count]
        self.alone = np.zeros(len(m.pieces), bool)
        self.alone[listed] = (count == 1) & (first == listed)
        # one entry a slot: a bounded memory of which neighbours agree
        self.pair_key = np.full(1 << _CACHE_BITS, -1, np.int64)
        self.pair_fits = np.zeros(1 << _CACHE_BITS, bool)
        self.asked: dict[int, bool] = {}  # the same for single questions, as large at most

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) << 21 | char
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def agree(self, m: PieceModel, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the model makes the two pieces of their joined text."""
        key = a.astype(np.int64) << 20 | b
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _CACHE_BITS)).astype(np.int64)
        fits, miss = self.pair_fits[slot], np.flatnonzero(self.pair_key[slot] != key)
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            left, right = (new >> 20).tolist(), (new & 0xFFFFF).tolist()
            ids, count = encode_chunks(m, [m.pieces[x] + m.pieces[y] for x, y in zip(left, right, strict=True)])
            at = np.cumsum(count) - count
            good = (count == 2) & (ids[at] == left) & (ids[np.minimum(at + 1, len(ids) - 1)] == right)
            fits[miss] = good[back]
            self.pair_key[slot[miss]], self.pair_fits[slot[miss]] = key[miss], good[back]
        return fits


    def agree_one(self, m: PieceModel, a: int, b: int) -> bool:
        """:meth:`agree` for one pair, without arrays."""
        key = a << 20 | b
        fits = self.asked.get(key)
        if fits is None:
            if len(self.asked) >> _CACHE_BITS:
                self.asked.clear()
            fits = self.asked[key] = merge_long(m, [m.ids[c] for c in m.pieces[a] + m.pieces[b]]) == [a, b]
        return fits


@functools.lru_cache(2)
def _tables(path: str) -> _Tables:
    return _Tables(model(path))


class PrefixCounts:
    """Prefix counts of chunks. Those met before are looked up: the table holds the
    chunks of one call, and of earlier calls as long as it has no more than ``keep``."""

    def __init__(self, path: str | None = None, keep: int = 300_000):
        self.model, self.tables, self.keep = model(path or default_path()), _tables(path or default_path()), keep
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str) -> tuple[int, ...]:
        """Token counts of the prefixes of 0, 1, 2, ... characters of a marked chunk."""
        n, m, t = len(text), self.model, self.tables
        count, last = [0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            for k in t.by_last.get(text[j - 1], ()):
                p = m.ids.get(text[j - k : j]) if k <= j else None
                if p is not None and t.alone[p]:
                    a = last[j - k]
                    if a < 0 or t.agree_one(m, a, p):
                        count[j], last[j] = count[j - k] + 1, p
                        break
            else:
                count[j] = count[j - 1] + len(text[j - 1].encode())
        return tuple(count)

    def of_all(self, texts: list[str]) -> list[tuple[int, ...]]:
        """The same for many chunks of at most LONG_CHUNK characters: place by place,
        each place of all chunks at once."""
        m, t = self.model, self.tables
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        place = flat.ragged(np.zeros(len(texts), np.int64), lengths)
        # the pieces that end at each character
        at, state, found = np.arange(len(points)), np.zeros(len(points), np.int32), []
        k = 0
        while len(at):
            state = t.step(state, points[at - k])
            k += 1
            on = state >= 0
            at, state = at[on], state[on]
            piece = t.piece[state]
            good = (piece >= 0) & t.alone[piece]
            found.append((at[good], np.full(int(good.sum()), k), piece[good]))
            on = place[at] >= k
            at, state = at[on], state[on]
        ends, size, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((-size, ends, place[ends]))
        ends, size, piece = ends[order], size[order], piece[order]
        bound = np.searchsorted(place[ends], np.arange(lengths.max() + 1))
        by_place = np.argsort(place, kind="stable")
        own = np.searchsorted(place[by_place], np.arange(lengths.max() + 1))
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        count, last = np.zeros(len(points), np.int32), np.full(len(points), -1, np.int32)
        for j in range(int(lengths.max())):
            e, s, p = (x[bound[j] : bound[j + 1]] for x in (ends, size, piece))
            whole = s == j + 1
            before = np.where(whole, -1, last[e - s])
            fits = before < 0
            ask = np.flatnonzero(~fits)
            fits[ask] = t.agree(m, before[ask], p[ask])
            e, s, p, whole = e[fits], s[fits], p[fits], whole[fits]
            first = np.append(True, e[1:] != e[:-1])[: len(e)]
            e, s, p, whole = e[first], s[first], p[first], whole[first]
            count[e] = np.where(whole, 0, count[e - s]) + 1
            last[e] = p
            here = by_place[own[j] : own[j + 1]]
            none = here[count[here] == 0]
            count[none] = (count[none - 1] if j else 0) + width[none]
        cuts = np.cumsum(lengths).tolist()
        listed = count.tolist()
        return [(0, *listed[a:b]) for a, b in zip([0, *cuts], cuts, strict=False)]

    def __call__(self, texts: Sequence[str | None]) -> Iterator[list[tuple[int, ...]]]:
        """The prefix counts of the chunks of each text."""
        cut = [chunks(t or "") for t in texts]
        own = set().union(*cut)
        new = list(own.difference(self.known))
        if len(self.known) + len(new) > self.keep:
            self.known = {c: self.known[c] for c in own.intersection(self.known)}
        marked = [(MARK + c).replace(" ", MARK) for c in new]
        short = [i for i, c in enumerate(marked) if len(c) <= LONG_CHUNK]
        if short:
            self.known.update(zip([new[i] for i in short], self.of_all([marked[i] for i in short]), strict=True))
        for c, x in zip(new, marked, strict=True):
            if len(x) > LONG_CHUNK:
                self.known[c] = self.of(x)
        find = self.known.__getitem__
        for c in cut:
            yield list(map(find, c))


def prefix_counts(text: str | None, path: str | None = None) -> list[int]:
    """count[j]: how many tokens the first j characters of a text have."""
    out, before = [0], 0
    for counts in next(PrefixCounts(path)([text])):
        # a chunk's first place is its mark: a space of the text, or the dummy prefix
        out += [before + c for c in counts[1 + (len(out) == 1 and before == 0) :]]
        before += counts[-1]
    return out


def longest_within(parts: list[tuple[int, ...]], totals: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    if budget <= 0 or not parts:
        return 0
    before = totals - np.array([p[-1] for p in parts])
    reach = before + np.array([min(p[1:]) for p in parts])
    fit = np.flatnonzero(reach <= budget)
    if not len(fit):
        return 0
    k = int(fit[-1])
    inside = max(j for j in range(1, len(parts[k])) if before[k] + parts[k][j] <= budget)
    return sum(len(p) - 1 for p in parts[:k]) + inside - 1  # less the dummy prefix


def token_counts(docs: DataFrame, budgets: Sequence[int] = (4096,), id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row a row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, and for each budget
    chars_<budget>, the characters of the longest prefix within it. Map-only."""
    budgets = list(budgets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = PrefixCounts(path)
        for batch in batches:
            for part in flat.row_slices(batch, 1):
                texts = part.column(1).to_pylist()
                n_bytes = np.diff(flat.text_bytes(part.column(1))[1])
                tokens, cuts = [], [[] for _ in budgets]
                for text, parts in zip(texts, counts(texts), strict=True):
                    n = sum([p[-1] for p in parts])
                    tokens.append(n)
                    within = None
                    for cut, budget in zip(cuts, budgets, strict=True):
                        if n <= budget:
                            cut.append(len(text or ""))
                        else:
                            within = np.cumsum([p[-1] for p in parts]) if within is None else within
                            cut.append(longest_within(parts, within, budget))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64()), *(pa.array(c, pa.int64()) for c in cuts)], names=["doc_id", "n_bytes", "n_tokens", *(f"chars_{b}" for b in budgets)])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long" + "".join(f", chars_{b} long" for b in budgets))
