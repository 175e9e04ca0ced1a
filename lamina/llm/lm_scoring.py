"""Cross-entropy difference: how much a text is like a target collection.

Two bigram models over the pieces of one fixed vocabulary are counted, the background
over all texts, the target over the labelled ones. They are matched: same vocabulary,
order and smoothing, and the background's counts are scaled to the target's number of
tokens. With c the counts of a model, N its tokens, V the vocabulary's size,

    p1(w)   = (c(w) + 1) / (N + V)
    p(w|v)  = (c(v, w) + mass * p1(w)) / (c(v) + mass)

A text's losses are the mean of -log p over its tokens under either model (its start is
a context of its own), and its score is the target's loss less the background's: lower
is nearer to the target. With ``leave_out`` a text is scored by models that have not seen
it: its own counts are taken off the background's, and off the target's if it is a target
text (of a repeated text only one copy's). Counts cover all texts and grow with them; no list
of n-grams is cut, hashed or broadcast.

Texts are tokenized once, into a table in the folder that the cluster shares. Its blocks are
runs of rows that a task met one after the other, of at most ``block_rows`` rows and
about ``block_tokens`` tokens, so none depends on how often an id occurs, and one longer text
is a block of its own. Target rows are found by a join of ids with (block, row), two numbers a
row; the tokens are shuffled once, by block. A block counts its own n-grams, Spark adds these up
by n-gram, and the sums go back to the blocks that asked, so a task holds the n-grams of one
block only. Losses take ``_SLICE`` tokens of a block at a time; a longer text takes about 60
bytes a token.

Results for special cases: null and empty texts have no tokens and null losses and
score. Repeated rows count as often as they occur and get a row each. Without target
texts all scores are 0 (both models are uniform then). A doc_id with several labels is
target if one of them is; a null id has no label. An empty table gives no rows. Columns beside
the two named have no influence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.llm.piece_codec import Encoder
from lamina.llm.pieces import default_path, model
from lamina.session import workspace

START = 1
#: Keys of n-grams: pairs from 0 up (context * vocabulary + token), the total, contexts
#: from -2 down, tokens below these, then the numbers of target rows.
_TOTAL = -1
#: Tokens whose losses are worked out at once.
_SLICE = 1 << 20


def _bigrams(table: pa.Table, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and tokens of a block's texts, keys of their pairs, and how many tokens
    each text has."""
    raw = table.column("ids").to_pylist()
    n = np.fromiter((len(x) // 2 for x in raw), np.int64, len(raw))
    word = np.frombuffer(b"".join(raw), "<u2")
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[(np.cumsum(n) - n)[n > 0]] = START
    wide = np.int32 if vocabulary**2 < 1 << 31 else np.int64
    return context, word, context.astype(wide) * wide(vocabulary) + word, n


def _own_counts(text: np.ndarray, pairs: np.ndarray, vocabulary: int) -> tuple[np.ndarray, ...]:
    """For each distinct (text, pair): text, pair, and how often the text has the pair, the
    pair's context and its token."""
    key, n = np.unique(text.astype(np.int64) * vocabulary**2 + pairs, return_counts=True)
    who, pair = np.divmod(key, vocabulary**2)
    sums = lambda k: (lambda u, back: np.bincount(back, weights=n, minlength=len(u))[back])(*np.unique(k, return_inverse=True))
    return who, pair, n, sums(who * vocabulary + pair // vocabulary), sums(who * vocabulary + pair % vocabulary)


def score(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    mass: float = 64.0,
    leave_out: bool = False,
    block_rows: int = 20_000,
    block_tokens: int = 1 << 23,
) -> DataFrame:
    """One row a row of ``docs``: doc_id, n_tokens, loss_target, loss_background,
    ce_difference. ``target`` has the ids (doc_id) of the target texts."""
    spark = docs.sparkSession

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, keep=100_000)
        if len(encoder.model.pieces) > 1 << 16:
            raise ValueError("token ids are kept in 16 bits")
        first = TaskContext.get().partitionId() << 32
        block, row, rows, tokens = first, first, 0, 0
        for batch in batches:
            for part in flat.row_slices(batch, 1):
                ids = encoder.packed(part.column(1).to_pylist(), "<u2")
                of_row = []
                for x in ids:
                    if rows and (rows == block_rows or tokens + len(x) // 2 > block_tokens):
                        block, rows, tokens = block + 1, 0, 0
                    rows, tokens = rows + 1, tokens + len(x) // 2
                    of_row.append(block)
                yield pa.RecordBatch.from_arrays([pa.array(of_row, pa.int64()), pa.array(np.arange(row, row + len(ids))), part.column(0), pa.array(ids, pa.binary())], names=["block", "row", "doc_id", "ids"])
                row += len(ids)

    def count(tokens: pa.Table, marks: pa.Table) -> pa.Table:
        v = len(model(path or default_path()).pieces)
        context, word, pairs, n = _bigrams(tokens, v)
        is_target = np.repeat(np.isin(tokens.column("row").to_numpy(), marks.column("row").to_numpy()), n)
        found, times = np.unique(pairs, return_counts=True)
        of_target = np.zeros(len(found), np.int64)
        t_found, t_times = np.unique(pairs[is_target], return_counts=True)
        of_target[np.searchsorted(found, t_found)] = t_times
        keys, background, own = [found], [times], [of_target]
        # contexts, then tokens
        for first, values in ((-2, context), (-2 - v, word)):
            every = np.bincount(values, minlength=v)
            seen = np.flatnonzero(every)
            keys.append(first - seen)
            background.append(every[seen])
            own.append(np.bincount(values[is_target], minlength=v)[seen])
        if len(tokens):
            keys.append(np.array([_TOTAL]))
            background.append(np.array([len(word)]))
            own.append(np.array([int(is_target.sum())]))
        keys, background, own = (np.concatenate(x).astype(np.int64) for x in (keys, background, own))
        block = tokens.column("block")[0].as_py() if len(tokens) else 0
        return pa.table({"block": np.full(len(keys), block, np.int64), "key": keys, "b": background, "t": own})

    def losses(tokens: pa.Table, counts: pa.Table) -> pa.Table:
        v = len(model(path or default_path()).pieces)
        _, _, pairs, n = _bigrams(tokens, v)
        key, b, t = (counts.column(c).to_numpy() for c in ("key", "b", "t"))
        order = np.argsort(key)
        key, b, t = key[order], b[order], t[order]
        marked = int(np.searchsorted(key, -1 - 2 * v))
        is_target = np.isin(tokens.column("row").to_numpy(), -2 - 2 * v - key[:marked])
        low = int(np.searchsorted(key, 0))
        total_b, total_t = (int(x[low - 1]) if low > marked else 0 for x in (b, t))  # key _TOTAL
        scale = total_t / total_b if total_b else 0.0
        single = -2 - key[marked : max(low - 1, marked)]
        pair_key = key[low:]
        by_single = []
        for c in (t, b):
            some = np.zeros(2 * v)
            some[single] = c[marked : marked + len(single)]
            by_single.append(some)
        sums = np.zeros((2, len(n)))
        ends = np.cumsum(n)
        lo = 0
        while lo < len(n):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - n[lo] + _SLICE, "right")))
            text = np.repeat(np.arange(lo, hi), n[lo:hi])
            who, pair, times, of_context, of_word = _own_counts(text, pairs[ends[lo] - n[lo] : ends[hi - 1]], v)
            at = np.searchsorted(pair_key, pair)
            context, word = pair // v, pair % v
            for k, (c, some, total, factor) in enumerate(((t[low:], by_single[0], total_t, 1.0), (b[low:], by_single[1], total_b, scale))):
                off = (is_target[who] if k == 0 else 1.0) * leave_out
                p1 = ((some[v + word] - off * of_word) * factor + 1) / ((total - off * n[who]) * factor + v)
                p = ((c[at] - off * times) * factor + mass * p1) / ((some[context] - off * of_context) * factor + mass)
                sums[k] += np.bincount(who, weights=-times * np.log(p), minlength=len(n))
            lo = hi
        none = n == 0
        means = sums / np.maximum(n, 1)
        out = [pa.array(x, pa.float64(), mask=none) for x in (*means, means[0] - means[1])]
        return pa.table([tokens.column("doc_id"), pa.array(n), *out], names=["doc_id", "n_tokens", "loss_target", "loss_background", "ce_difference"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    at = f"{workspace(spark, 'lm')}/tokens"
    source.mapInArrow(tokenize, f"block long, row long, doc_id {kind}, ids binary").write.option("compression", "zstd").parquet(at)
    tokens = spark.read.parquet(at)
    chosen = target.select(F.col("doc_id").cast(kind).alias("doc_id")).where("doc_id is not null").distinct()
    marks = spark.read.parquet(at).select("block", "row", "doc_id").join(chosen, "doc_id", "left_semi").select("block", "row")
    by_block = tokens.groupBy("block")
    counted = by_block.cogroup(marks.groupBy("block")).applyInArrow(count, "block long, key long, b long, t long")
    sums = counted.groupBy("key").agg(F.sum("b").alias("b"), F.sum("t").alias("t"))
    asked = counted.select("block", "key").join(sums, "key").select("block", "key", "b", "t")
    pieces = len(model(path or default_path()).pieces)
    asked = asked.unionAll(marks.select("block", (F.lit(-2 - 2 * pieces) - F.col("row")).alias("key"), F.lit(0).cast("long").alias("b"), F.lit(1).cast("long").alias("t")))
    out = f"doc_id {kind}, n_tokens long, loss_target double, loss_background double, ce_difference double"
    return by_block.cogroup(asked.groupBy("block")).applyInArrow(losses, out)
