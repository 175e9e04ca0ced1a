"""Packing of tokenized texts into windows: best-fit decreasing.

A text's tokens end with a separator id. Texts longer than a window are first cut into
full windows; what is left over of each text goes, longest first, into the open window
with the least room that still holds it. A segment tree over the remaining capacities
finds that window in log2(capacity) steps.

Each task packs the rows of its own input partition, in pools of a bounded number of
tokens; windows with room stay open for the next pool. So nothing is shuffled, memory
is bounded by one pool, and a lost task packs the same rows into the same windows again
(a window's id is made of the partition's number and a running number). A partition
wastes at most about one window.

Results for special cases: null and empty texts are the separator alone. Repeated rows,
and rows with null or equal ids, are packed each for itself. An empty table gives no pieces. Texts are never cut short: a long one gets many pieces, and
each id lies in exactly one piece. Columns beside the two named have no influence.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.llm.pieces import default_path

VOCABULARY = "byte_bpe_50k"
#: Tokens of left-over pieces that are sorted and packed together.
POOL_TOKENS = 1 << 21


class OpenWindows:
    """Windows with room, by remaining capacity. ``tree[1]`` is the root of a segment
    tree whose leaf c counts the open windows with room for exactly c tokens."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        i = self.leaves + room
        while i:
            self.tree[i] += by
            i >>= 1

    def put(self, window: int, room: int) -> None:
        if room:
            self.at[room].append(window)
            self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(window, its room) of an open window with the least room of ``need`` or more."""
        tree, i = self.tree, self.leaves + need
        if not tree[i]:
            # up to the first node with windows to the right, then down to its first leaf
            while i > 1 and (i & 1 or not tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if tree[2 * i] else 2 * i + 1
        room = i - self.leaves
        window = self.at[room].pop()
        self._add(room, -1)
        return window, room


class Packer:
    """Places pieces; ``used`` has the filled length of every window so far."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.n = capacity, OpenWindows(capacity), 0

    def place(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window number and offset of each piece, the longest placed first."""
        window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for k in np.argsort(-lengths, kind="stable").tolist():
            need = int(lengths[k])
            got = self.open.take(need)
            if got is None:
                got = self.n, self.capacity
                self.n += 1
            window[k], room = got
            offset[k] = self.capacity - room
            self.open.put(got[0], room - need)
        return window, offset

    def full(self, count: int) -> np.ndarray:
        """Numbers of new windows that are full."""
        self.n += count
        return np.arange(self.n - count, self.n)


#: A text may be cut at a space before one of these characters: the vocabulary's own
#: cut into words begins a new word there, whatever comes before.
_CUT = re.compile(" (?=[!-~¡-ɏ])")
#: Characters on which both libraries agree in every release (Latin script, punctuation).
_PLAIN = re.compile("[\x00-ɏ‐-‧]*")


class Tokenizer:
    """Ids of texts as the tokenizers library gives them for a byte-level vocabulary.

    A text in plain characters goes to the tiktoken form of the same vocabulary, which
    is faster. Any other text is cut where the parts don't influence one another, and
    parts with other characters go to the tokenizers library itself.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import base64
        import json

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(default_path(f"{vocabulary}.json"))
        with open(default_path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(default_path(f"{vocabulary}.json"), encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.special = list(special)
        self.allowed = set(special)
        self.fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def _plain(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.fast.encode(text, allowed_special=self.allowed, disallowed_special=())
        return self.fast.encode_ordinary(text)

    def __call__(self, text: str | None) -> bytes:
        """The ids, little-endian, 4 bytes each."""
        text = text or ""
        if _PLAIN.fullmatch(text):
            return np.array(self._plain(text), "<u4").tobytes()
        first, *rest = _CUT.split(text)
        ids: list[int] = []
        for plain, group in itertools.groupby([first, *[" " + c for c in rest]], lambda c: bool(_PLAIN.fullmatch(c))):
            run = "".join(group)
            ids += self._plain(run) if plain else self.library.encode(run, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


def pack(docs: DataFrame, capacity: int = 2048, separator: int = 1, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """One row a piece: doc_id, start (ids of its text before it), length, ids (binary,
    little-endian unsigned 32-bit), doc_tokens (with the separator), sequence_id,
    offset (in the sequence, without gaps from 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = Tokenizer(vocabulary), Packer(capacity)
        base = TaskContext.get().partitionId() << 40
        kind = None
        rest: list[tuple] = []
        waiting = 0

        def rows(own: list, start: np.ndarray, ids: list[bytes], total: np.ndarray, window: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
            length = np.array([len(x) // 4 for x in ids], np.int64)
            return pa.RecordBatch.from_arrays([pa.array(own, kind), pa.array(start, pa.int64()), pa.array(length), pa.array(ids, pa.binary()), pa.array(total, pa.int64()), pa.array(base + window), pa.array(offset)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        def flush() -> pa.RecordBatch:
            own, start, ids, total = zip(*rest, strict=True)
            window, offset = packer.place(np.array([len(x) // 4 for x in ids], np.int64))
            rest.clear()
            return rows(list(own), np.array(start), list(ids), np.array(total), window, offset)

        for batch in batches:
            kind = batch.schema.field(0).type
            for part in flat.row_slices(batch, 1):
                for own, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    raw = tokenizer(text) + int(separator).to_bytes(4, "little")
                    n = len(raw) // 4
                    whole = n // capacity
                    if whole:
                        start = np.arange(whole) * capacity
                        yield rows([own] * whole, start, [raw[4 * s : 4 * (s + capacity)] for s in start.tolist()], np.full(whole, n), packer.full(whole), np.zeros(whole, np.int64))
                    if n > whole * capacity:
                        rest.append((own, whole * capacity, raw[4 * whole * capacity :], n))
                        waiting += n - whole * capacity
                if waiting >= pool_tokens:
                    yield flush()
                    waiting = 0
        if rest:
            yield flush()

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def padding(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row a sequence: its used length and padding (none at a power of two)."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.withColumn("padding", F.when(power, F.lit(0)).otherwise(F.lit(capacity) - F.col("used")))
