"""Encoding and decoding with a byte-pair piece model, in vectorised merge rounds.

Every distinct chunk of a batch is encoded once, and a bounded table keeps chunks for
the next batch. All symbols of these chunks lie in
one flat array; a round finds each chunk's smallest pair rank (a segmented minimum),
merges the leftmost pair of that rank in all chunks at once, and compacts the array.
Chunks without a pair leave the array; the rounds end when it is empty. A round merges
one pair a chunk because joined pieces of this model can outrank the pair they came
from: merging all pairs of a rank at once would change the library's ids.

Results for special cases: null and empty texts have no ids and decode to the empty
text. Repeated rows, and columns beside the two named, have no influence. Texts are
never cut; one very long text is a batch of its own. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.llm.pieces import MARK, NONE, PieceModel, chunks, default_path, model

#: Longer runs of joinable characters are merged with a heap: rounds cost their square.
LONG_RUN = 1024


def merge_long(m: PieceModel, ids: list[int]) -> list[int]:
    """The same merges in one run of symbols, by a heap of pairs: O(n log n)."""
    n = len(ids)
    left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = right[i]
        if j >= 0 and ids[i] >= 0 and ids[j] >= 0:
            p = m.ids.get(m.pieces[ids[i]] + m.pieces[ids[j]])
            if p is not None:
                heapq.heappush(heap, (int(m.rank[p]), i, p, ids[i], ids[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, p, a, b = heapq.heappop(heap)
        j = right[i] if alive[i] else -1
        if j < 0 or ids[i] != a or ids[j] != b:
            continue
        ids[i], alive[j], right[i] = p, False, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    return [x for x, on in zip(ids, alive, strict=True) if on]


def encode_chunks(m: PieceModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all chunks, one after the other, and how many each has."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).replace(" ", MARK).encode("utf-32-le"), np.uint32).astype(np.int64)
    sym = m.char_id[points]
    unknown = sym < 0
    sym[unknown] = -1 - np.flatnonzero(unknown).astype(np.int32)  # keeps the place of the character
    # runs: cut where no piece holds the two characters side by side
    both = points[:-1] << 21 | points[1:]
    at = np.searchsorted(m.inner, both)
    cut = np.ones(len(points), bool)
    cut[1:] = m.inner[np.minimum(at, len(m.inner) - 1)] != both
    cut[np.cumsum(lengths)[:-1][np.cumsum(lengths)[:-1] < len(points)]] = True
    begin = np.flatnonzero(cut)
    size = np.diff(np.append(begin, len(points)))
    place = np.repeat(begin, size) * 0 + np.arange(len(points))

    done_place, done_sym = [], []
    for r in np.flatnonzero(size > LONG_RUN):
        got = merge_long(m, sym[begin[r] : begin[r] + size[r]].tolist())
        done_sym.append(np.array(got, np.int32))
        done_place.append(begin[r] + np.arange(len(got)))
    single = size == 1
    done_place.append(begin[single])
    done_sym.append(sym[begin[single]])
    live = ~single & (size <= LONG_RUN)
    pick = flat.ragged(begin[live], size[live])
    sym, place, size = sym[pick], place[pick], size[live]
    last = np.zeros(len(sym), bool)
    last[np.cumsum(size) - 1] = True
    joined = np.full(len(sym), -1, np.int32)
    joined[:-1] = m.join(sym[:-1], sym[1:])
    joined[last] = -1
    rank = np.where(joined >= 0, m.rank[joined], NONE)
    while len(size):
        begin = np.cumsum(size) - size
        least = np.minimum.reduceat(rank, begin)
        on = least != NONE
        if not on.all():
            stay = np.repeat(on, size)
            done_place.append(place[~stay])
            done_sym.append(sym[~stay])
            sym, place, joined, rank, last = sym[stay], place[stay], joined[stay], rank[stay], last[stay]
            size, least = size[on], least[on]
            if not len(size):
                break
        word = np.repeat(np.arange(len(size)), size)
        hit = np.flatnonzero(rank == least[word])
        hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])]
        sym[hit] = joined[hit]
        last[hit] = last[hit + 1]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        to = hit - np.arange(len(hit))  # one symbol goes from every chunk before
        sym, place, joined, rank, last = sym[keep], place[keep], joined[keep], rank[keep], last[keep]
        size = size - 1
        before = to - 1
        before = before[(before >= 0) & ~last[before]]
        again = np.concatenate([to[~last[to]], before])
        joined[to[last[to]]] = -1
        rank[to[last[to]]] = NONE
        joined[again] = m.join(sym[again], sym[again + 1])
        rank[again] = np.where(joined[again] >= 0, m.rank[joined[again]], NONE)
    place, sym = np.concatenate(done_place), np.concatenate(done_sym)
    order = np.argsort(place, kind="stable")
    place, sym = place[order], sym[order]

    # characters without a piece: their bytes
    own = np.searchsorted(np.cumsum(lengths), place, "right")
    missing = np.flatnonzero(sym < 0)
    if not len(missing):
        return sym, np.bincount(own, minlength=len(texts))
    raw = [chr(points[-1 - s]).encode() for s in sym[missing].tolist()]
    width = np.ones(len(sym), np.int64)
    width[missing] = [len(x) for x in raw]
    out = np.repeat(sym, width)
    start = np.cumsum(width) - width
    out[flat.ragged(start[missing], width[missing])] = m.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.bincount(np.repeat(own, width), minlength=len(texts))


class Encoder:
    """Encodes texts; chunks met before are looked up. The table holds the chunks of
    one call, and of earlier calls as long as it has no more than ``keep``. An encoder
    is for calls or for ``packed``, not for both."""

    def __init__(self, path: str | None = None, keep: int = 200_000):
        self.model, self.keep = model(path or default_path()), keep
        self.known: dict = {}

    def _cut(self, texts: list[str | None]) -> tuple[list[list[str]], list[str]]:
        """The chunks of all texts, and those that are not in the table."""
        cut = [chunks(t or "") for t in texts]
        own = set().union(*cut)
        new = list(own.difference(self.known))
        if len(self.known) + len(new) > self.keep:
            self.known = {c: self.known[c] for c in own.intersection(self.known)}
        return cut, new

    def packed(self, texts: list[str | None], kind: str) -> list[bytes]:
        """The ids of each text as integers of a numpy type, one after the other."""
        cut, new = self._cut(texts)
        if new:
            ids, count = encode_chunks(self.model, [MARK + c for c in new])
            raw = ids.astype(kind).tobytes()
            ends = (np.cumsum(count) * np.dtype(kind).itemsize).tolist()
            self.known.update(zip(new, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        find = self.known.__getitem__
        return [b"".join(map(find, c)) for c in cut]

    def __call__(self, texts: list[str | None]) -> Iterator[list[tuple[int, bytes, bytes, bytes]]]:
        """For each text, of its chunks: number of ids, ids (little-endian, 4 bytes
        each), ids in decimal with a comma after each, decoded bytes."""
        cut, new = self._cut(texts)
        if new:
            m = self.model
            ids, count = encode_chunks(m, [MARK + c for c in new])
            listed, ends = ids.tolist(), np.cumsum(count)
            raw = ids.astype("<i4").tobytes()
            decimal = b"".join(map(m.decimal.__getitem__, listed))
            text = b"".join(map(m.piece_text.__getitem__, listed))
            at = [np.append(0, np.append(0, np.cumsum(w[ids]))[ends]).tolist() for w in (m.decimal_len, m.text_len)]
            ends = [0, *ends.tolist()]
            for c, a, b, da, db, ta, tb in zip(new, ends, ends[1:], at[0], at[0][1:], at[1], at[1][1:], strict=False):
                self.known[c] = (b - a, raw[4 * a : 4 * b], decimal[da:db], text[ta:tb])
        find = self.known.__getitem__
        for c in cut:
            yield list(map(find, c))


def encode(texts: list[str | None], path: str | None = None) -> list[np.ndarray]:
    """Ids of each text."""
    return [ids_of(parts) for parts in Encoder(path)(texts)]


def ids_of(parts: list[tuple[int, bytes, bytes, bytes]]) -> np.ndarray:
    """All ids of one encoded text."""
    return np.frombuffer(b"".join([p[1] for p in parts]), "<i4")


def decode_parts(parts: list[tuple[int, bytes, bytes, bytes]]) -> bytes:
    """The text of all ids of one encoded text, without the dummy prefix's space."""
    return b"".join([p[3] for p in parts])[1:]


def decode(ids: list[int], path: str | None = None) -> str:
    """The text of one list of ids; control pieces have no text, bytes that are no
    UTF-8 become U+FFFD each, and one leading space (the dummy prefix) goes."""
    m = model(path or default_path())
    out, raw = [], bytearray()

    def flush() -> None:
        while raw:
            for k in range(min(4, len(raw)), 0, -1):
                try:
                    out.append(bytes(raw[:k]).decode())
                    break
                except UnicodeDecodeError:
                    if k == 1:
                        out.append("�")
            del raw[:k]

    for i in map(int, ids):
        if i in m.byte_of:
            raw.append(m.byte_of[i])
            continue
        flush()
        if i == m.unknown_id:
            out.append(" ⁇ ")
        elif not m.special[i]:
            piece = m.pieces[i]
            out.append((piece[1:] if not out and piece[:1] == MARK else piece).replace(MARK, " "))
    flush()
    return "".join(out)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, digests: bool = False) -> DataFrame:
    """Each text's ids (array of int) and the text that they decode to; one row a row
    of ``docs``: (doc_id, ids, decoded). ``digests`` gives n_tokens, ids_text (decimal,
    joined by commas) and decoded instead. Map-only: nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for part in flat.row_slices(batch, 1):
                n, ids, texts = [], [], []
                for parts in encoder(part.column(1).to_pylist()):
                    n.append(sum([p[0] for p in parts]))
                    ids.append(b"".join([p[2] for p in parts])[:-1] if digests else ids_of(parts))
                    texts.append(decode_parts(parts))
                decoded = pa.array(texts, pa.binary()).cast(pa.string())
                if digests:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()).cast(pa.string()), decoded], names=["doc_id", "n_tokens", "ids_text", "decoded"])
                else:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), decoded], names=["doc_id", "ids", "decoded"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_text string, decoded string" if digests else f"doc_id {kind}, ids array<int>, decoded string")
