"""Packing of tokenized texts into as few windows as possible: Martello and Toth's
dominance reduction, then best fit for the rest.

A set of pieces that holds piece j dominates another such set if the pieces of the other
can be dealt among those of the first so that none is exceeded. If one set dominates all
sets with j that fit, some packing with the fewest windows has that very window: it is
fixed for good and the instance shrinks. What is looked at are sets of up to three
pieces (see :func:`reduce`). The rest is packed best fit decreasing.

Which pieces are equal to the packer is their length alone, so the whole instance is one
count a length: at most ``capacity`` numbers, whatever the size of the corpus. Spark counts
the lengths, the driver plans windows for these counts (each step settles a whole length
or a whole group of windows, so the plan has a few entries a length), and every piece finds
its place by its running number among the pieces of its length: its number in its own
task, and the pieces of the tasks before. One plan holds for all partitions, no task has
windows of its own to leave half empty, and a length that a third of all pieces have is
spread over all tasks.

Texts are tokenized once; the pieces are a table in the folder that the cluster shares, so
a lost executor repeats its own tasks only and gets the same places again. The ids meet
their place in a join by (task, length), whose other side has at most ``capacity`` rows a
task: Spark broadcasts it if that is small, else ids are shuffled once.

A text's tokens end with a separator id. Only texts longer than a window are cut, into
full windows; what is left over is the first piece.

Results for special cases: null and empty texts are the separator alone. Repeated rows and
null ids are packed each for itself. Very long texts get as many pieces as they need, each
id lies in exactly one. An empty table gives no pieces. Columns beside the two named have no
influence.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.llm.packing import VOCABULARY, Tokenizer
from lamina.session import workspace

#: A place's key: length, then the running number among the pieces of that length.
_NUMBER_BITS = 44


def _best_set(counts: np.ndarray, j: int, capacity: int) -> tuple[int, ...] | None:
    """The set of lengths that dominates every set with a piece of length j that fits, if
    the criteria show one. ``counts`` has the other pieces (the one of length j is out)."""
    room = capacity - j
    lengths = np.flatnonzero(counts)
    least, spent = 0, 0
    for n in lengths.tolist():
        more = min(int(counts[n]), 3 - least, (room - spent) // n)
        least, spent = least + more, spent + more * n
        if more < counts[n] or least == 3:
            break
    if least == 0:
        return (j,)
    fits = lengths[lengths <= room]
    top = int(fits[-1])
    # the largest that fits fills the window, or nothing fits beside it
    if top == room or least == 1:
        return (j, top)
    if least > 2:
        return None
    # pairs: the largest sum that fits, by the larger of the two
    larger = fits[::-1]
    at = np.searchsorted(fits, np.minimum(larger, room - larger), "right") - 1
    smaller = np.where(at >= 0, fits[at], 0)
    alone = (smaller == larger) & (counts[larger] < 2)
    smaller = np.where(alone, np.where(at > 0, fits[at - 1], 0), smaller)
    total = np.where(smaller > 0, larger + smaller, 0)
    k = int(total.argmax())
    a, b = int(larger[k]), int(smaller[k])
    if top >= a + b:
        return (j, top)
    if a != top:
        return None
    # two pieces that are both longer than b must not fit (one of length a is spoken for)
    between = counts.copy()
    between[a] -= 1
    longer = b + 1 + np.flatnonzero(between[b + 1 :])
    two = np.repeat(longer[:2], np.minimum(between[longer[:2]], 2))[:2]
    return (j, a, b) if len(two) < 2 or int(two.sum()) > room else None


def reduce(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fixes windows by dominance: (lengths in the window, how many such windows). What
    is left stays in ``counts`` (by length, 0 unused).

    With k the number of the smallest other pieces that fit beside j:

    * k = 0: j is alone.
    * the largest piece that fits beside j fills the window, or k = 1: j and that piece.
    * k = 2: j and the largest that fits, if it is not shorter than any pair that fits; or j
      and the longest pair (a, b), if a is the largest that fits and no two pieces longer
      than b fit.

    Taking pieces away never breaks a criterion that held, so a set is fixed as many times
    as its pieces last. Lengths are gone through, longest first, until none gives more."""
    fixed: list[tuple[tuple[int, ...], int]] = []
    more = True
    while more:
        more = False
        for j in np.flatnonzero(counts)[::-1].tolist():
            while counts[j]:
                counts[j] -= 1
                chosen = _best_set(counts, j, capacity)
                counts[j] += 1
                if chosen is None:
                    break
                times = min(int(counts[n]) // chosen.count(n) for n in chosen)
                for n in chosen:
                    counts[n] -= times
                fixed.append((chosen, times))
                more = True
    return fixed


class Plan:
    """Where the pieces of each length go. ``put`` adds a run: ``count`` pieces of one
    length, ``each`` to a window from window ``first`` on, at ``offset``."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.windows, self._runs, self._seen = 0, [], np.zeros(capacity + 1, np.int64)
        left = np.array(counts, np.int64)
        for lengths, times in reduce(left, capacity):
            offset = 0
            for n in lengths:
                self._put(n, times, 1, self.windows, offset)
                offset += n
            self.windows += times
        self.fixed = self.windows
        self._best_fit(left, capacity)
        runs = np.array(sorted(self._runs), np.int64).reshape(-1, 5)
        self.key, self.count, self.each, self.first, self.offset = runs.T.copy()

    def _put(self, length: int, count: int, each: int, first: int, offset: int) -> None:
        self._runs.append((length << _NUMBER_BITS | int(self._seen[length]), count, each, first, offset))
        self._seen[length] += count

    def _best_fit(self, left: np.ndarray, capacity: int) -> None:
        """Best fit decreasing. A window that takes a piece is the tightest one from then
        on, so it takes as many of that length as it holds; windows with equal room form
        groups (first, how many), which are served as one."""
        rooms: list[int] = []
        groups: dict[int, list[tuple[int, int]]] = {}

        def leave(room: int, first: int, windows: int) -> None:
            if room and windows:
                if room not in groups:
                    groups[room] = []
                    insort(rooms, room)
                groups[room].append((first, windows))

        for n in np.flatnonzero(left)[::-1].tolist():
            m = int(left[n])
            while m:
                at = bisect_left(rooms, n)
                if at == len(rooms):
                    room, first, windows = capacity, self.windows, -(-m // (capacity // n))
                    self.windows += windows
                else:
                    room = rooms[at]
                    first, windows = groups[room].pop()
                    if not groups[room]:
                        del groups[room], rooms[at]
                each = room // n
                whole = min(windows, m // each)
                if whole:
                    self._put(n, whole * each, each, first, capacity - room)
                    leave(room - each * n, first, whole)
                    m, first, windows = m - whole * each, first + whole, windows - whole
                if windows and m:
                    self._put(n, m, m, first, capacity - room)
                    leave(room - m * n, first, 1)
                    m, first, windows = 0, first + 1, windows - 1
                leave(room, first, windows)

    def places(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and offset of the pieces with these lengths and running numbers."""
        key = length.astype(np.int64) << _NUMBER_BITS | number.astype(np.int64)
        run = np.searchsorted(self.key, key, "right") - 1
        nth = key - self.key[run]
        return self.first[run] + nth // self.each[run], self.offset[run] + nth % self.each[run] * length


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Martello and Toth's bound L2: no packing has fewer windows."""
    counts = np.asarray(counts, np.int64)
    size = np.arange(capacity + 1)
    best = 0
    for small in [0, *(np.flatnonzero(counts[: capacity // 2 + 1]).tolist())]:
        large = int(counts[capacity - small + 1 :].sum())
        middle = slice(capacity // 2 + 1, capacity - small + 1)
        some = int(counts[middle].sum())
        rest = int((counts * size)[small : capacity // 2 + 1].sum())
        free = some * capacity - int((counts * size)[middle].sum())
        best = max(best, large + some + max(0, -(-(rest - free) // capacity)))
    return best


def _binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column of consecutive runs of ``values``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _pieces(source: DataFrame, capacity: int, separator: int, vocabulary: str) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids (16 bits each), task, and the
    piece's running number among those of its length in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = Tokenizer(vocabulary), TaskContext.get().partitionId()
        if max(tokenizer.library.get_vocab_size(), separator) > 1 << 16:
            raise ValueError("token ids are kept in 16 bits")
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([separator], "<u2")
        for batch in batches:
            for part in flat.row_slices(batch, 1):
                rows, total, ids = [], [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    own = np.frombuffer(tokenizer(text), "<u4").astype("<u2")
                    ids += [own, end]
                    rows.append(k)
                    total.append(len(own) + 1)
                total = np.array(total, np.int64)
                each = -(-total // capacity)
                row = np.repeat(np.array(rows, np.int64), each)
                piece = flat.ragged(np.zeros(len(each), np.int64), each)
                head = total - (each - 1) * capacity
                length = np.where(piece == 0, head[row], capacity)
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length[order], "left")
                number = np.empty(len(order), np.int64)
                number[order] = np.arange(len(order)) - first + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                flat_ids = np.concatenate(ids)
                for lo in range(0, len(row), 2048):  # bounded rows and bytes at once
                    hi = min(lo + 2048, len(row))
                    a = int(length[:lo].sum())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(row[lo:hi])), pa.array(piece[lo:hi], pa.int32()), pa.array(start[lo:hi]), pa.array(length[lo:hi]), _binary(flat_ids[a : a + int(length[lo:hi].sum())], length[lo:hi]), pa.array(np.full(hi - lo, task, np.int64)), pa.array(number[lo:hi])],
                        names=["doc_id", "piece", "start", "length", "ids", "task", "number"],
                    )

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids binary, task long, number long")


def pack(docs: DataFrame, capacity: int = 2048, separator: int = 0, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row a piece: doc_id, piece (from 0), start (ids of its text before it), length,
    ids (binary, little-endian unsigned 32-bit), sequence_id, offset (in the sequence,
    without gaps from 0)."""
    spark = docs.sparkSession
    path = f"{workspace(spark, 'pieces')}/pieces"
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    _pieces(source, capacity, separator, vocabulary).write.parquet(path)
    pieces = spark.read.parquet(path)

    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    plan = spark.sparkContext.broadcast(Plan(counts, capacity))  # a few entries a length

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    placed = pieces.join(ahead, ["task", "length"]).select("doc_id", "piece", "start", "length", "ids", (F.col("ahead") + F.col("number")).alias("number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            window, offset = plan.value.places(length, batch.column("number").to_numpy())
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u2").astype("<u4")
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), _binary(ids, length), pa.array(window), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long")
