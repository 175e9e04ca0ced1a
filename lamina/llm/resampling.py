"""Importance resampling towards a target collection, without replacement.

A text's features are its runs of 1 to ``order`` consecutive words, hashed into a fixed
number of buckets. With s of S features of the corpus and t of T of the target in a
bucket, the bucket's gain is floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))),
and a text's weight is the sum of the gains of its features. Gumbel noise that depends on
a seed and the id alone makes the highest scores a draw without replacement in proportion
to the weights (exp of a thousandth).

* Counts: every task adds up an array of one count a bucket; Spark sums these arrays, so
  a word that a third of all texts hold is one row a task. Weights: a gather from the array
  of gains, which has one number a bucket and goes to all tasks.
* Cutoff: a KLL sketch of the scores, merged from the sketches of groups of tasks, brackets
  the score of the last text drawn. Exact counts of the scores above and inside the bracket
  show whether it holds the cutoff; if it doesn't, it is widened until it does. Only the
  bracket is sorted. The sketch is random, the cutoff is not.
* Ranks: the drawn rows are sorted by ranges of (score, id, running number), so equal scores
  and ids are dealt over tasks too; a row's rank is its place in its range and the sizes of
  the ranges before, one number a range.

The corpus is read twice, texts are never shuffled. Scores are a table in the shared
folder, and so are sorted rows: a task run again finds the same numbers.

Results for special cases: null and empty texts, and texts without words, have no
features, weight 0 and no rank (they have fewer than ``least_words`` words). Very long texts are
gone through in windows, all of their words count. Repeated rows get equal scores and a rank
each; ties go to the smaller id, then to the row that is read first. A null id has the
noise of an empty id and comes after others in ties. An empty table gives no rows; without
target texts gains are those of t = T = 0. Columns beside the two named have no influence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.session import workspace

#: Bytes between words: ASCII but for digits and lower-case letters (A-Z are lowered before).
IS_CUT = np.zeros(256, bool)
IS_CUT[:128] = [not (chr(b).isdigit() or chr(b).islower()) for b in range(128)]
#: The same before lowering.
_RAW_CUT = IS_CUT[flat.LOWER]
#: Bytes of text worked on at once; a longer text is cut at a byte between words.
WINDOW_BYTES = 1 << 20
#: Size of a KLL sketch; the error of a rank is about 0.13 % then.
_SKETCH, _ERROR, _GROUPS = 4000, 0.0013, 256


def _features(data: np.ndarray, offsets: np.ndarray, order: int, buckets: int, known: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket and text of every feature, and words by text. The first ``known`` words
    are those of the window before: features inside them are not counted again."""
    starts, ends = flat.spans_between(IS_CUT[data], offsets)
    text = flat.owner(offsets, starts)
    if order > 1:  # words joined by one space each
        length = ends - starts
        at = np.cumsum(length + 1) - length - 1
        joined = np.full(int((length + 1).sum()), 32, np.uint8)
        joined[flat.ragged(at, length)] = data[flat.ragged(starts, length)]
        data, starts, ends = joined, at, at + length
    place, owner = [], []
    for n in range(1, order + 1):
        last = np.arange(max(n - 1, known), len(starts))
        last = last[text[last] == text[last - n + 1]]
        a, b = starts[last - n + 1], ends[last]
        one, inverse = flat.distinct(flat.span_hash(data, a, b))
        crc = np.fromiter((zlib.crc32(data[x:y]) for x, y in zip(a[one].tolist(), b[one].tolist(), strict=True)), np.int64, len(one))
        place.append((crc % buckets)[inverse])
        owner.append(text[last])
    return np.concatenate(place), np.concatenate(owner), np.bincount(text[known:], minlength=len(offsets) - 1)


def _parts(column: pa.Array, order: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bucket and row of every feature, words by row): a
    row that is a long text comes several times."""
    data, offsets = flat.text_bytes(column)
    for lo, hi, part, inner in flat.slices(data, offsets, WINDOW_BYTES):
        if len(part) <= WINDOW_BYTES:
            yield lo, hi, *_features(flat.LOWER[part], inner, order, buckets)
            continue
        before = np.zeros(0, np.uint8)
        known = 0
        for a, b in flat.cuts(part, _RAW_CUT, WINDOW_BYTES):
            window = np.concatenate([before, flat.LOWER[part[a:b]]])
            yield lo, hi, *_features(window, np.array([0, len(window)]), order, buckets, known)
            if order > 1:
                starts, _ = flat.spans_between(IS_CUT[window], np.array([0, len(window)]))
                known = min(order - 1, len(starts))
                before = window[starts[-known] :] if known else before[:0]


def _counts(texts: DataFrame, order: int, buckets: int) -> np.ndarray:
    """How many features of all texts are in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, place, _, _ in _parts(batch.column(0), order, buckets):
                total += np.bincount(place, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    total = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        total[r["bucket"]] = r["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain, from the counts of both collections."""
    own, other = int(target.sum()) + len(target), int(corpus.sum()) + len(corpus)
    ratio = (target + 1.0) * other / ((corpus + 1.0) * own)
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(docs: DataFrame, gain: np.ndarray, order: int) -> DataFrame:
    """doc_id, row (a running number of the scan), n_words, n_features, weight."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for lo, hi, place, owner, n in _parts(batch.column(2), order, buckets):
                words[lo:hi] += n
                np.add.at(weight, owner + lo, gain[place])
                features[lo:hi] += np.bincount(owner, minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words), pa.array(features), pa.array(weight)], names=["doc_id", "row", "n_words", "n_features", "weight"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row long, n_words long, n_features long, weight long")


def noise(seed: int, doc_id: Column) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _key(score: Column, doc_id: Column, row: Column) -> Column:
    """Ascending in the order in which rows are drawn."""
    return F.struct((-score).alias("score"), doc_id.isNull().alias("none"), doc_id.alias("doc_id"), row.alias("row"))


def _numbered(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (doc_id, row, score, ...) with their rank, from 1."""
    key = _key(F.col("score"), F.col("doc_id"), F.col("row"))
    by = [key[x] for x in ("score", "none", "doc_id", "row")]
    rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    done = rows.sparkSession.read.parquet(path)
    done = done.withColumn("range", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    ahead, before = [], 0
    for r in done.groupBy("range").agg(F.count("*").alias("n")).orderBy("range").collect():  # one row a range
        ahead.append((r["range"], before))
        before += r["n"]
    ahead = rows.sparkSession.createDataFrame(ahead, "range long, ahead long")
    return done.join(F.broadcast(ahead), "range").withColumn("rank", F.col("ahead") + F.col("at") + 1).drop("range", "ahead", "at")


def bracket(scored: DataFrame, take: int, count: int, error: float = _ERROR) -> tuple[int | None, int | None, int]:
    """Scores (low, high; null: no bound) between which the ``take``-th highest of ``count``
    scores lies, both included, and how many scores are above."""
    parts = scored.groupBy((F.spark_partition_id() % _GROUPS).alias("g")).agg(F.kll_sketch_agg_bigint("score", F.lit(_SKETCH)).alias("s"))
    sketch = parts.agg(F.kll_merge_agg_bigint("s", F.lit(_SKETCH)).alias("s"))
    at = 1 - (take - 0.5) / count
    wide = 2 * error
    sketch = sketch.select("s").first()["s"]  # its size is fixed by _SKETCH
    one = scored.sparkSession.createDataFrame([(sketch,)], "s binary")
    while True:
        ends = (at - wide, at + wide)
        inside = [min(max(x, 0.0), 1.0) for x in ends]
        low, high = one.select(*(F.kll_sketch_get_quantile_bigint("s", F.lit(x)) for x in inside)).first()
        low, high = (low if ends[0] > 0 else None), (high if ends[1] < 1 else None)
        over = F.lit(False) if high is None else F.col("score") > high
        under = F.lit(False) if low is None else F.col("score") < low
        found = scored.agg(F.count_if(over).alias("over"), F.count_if(~over & ~under).alias("inside")).first()
        if found["over"] < take <= found["over"] + found["inside"]:
            return low, high, found["over"]
        wide *= 4


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, order: int = 1, buckets: int = 10_000, least_words: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, n_words, n_features, weight, score, rank (null: not
    drawn). Of the texts with ``least_words`` words or more, ``percent`` of a hundred are
    drawn. ``target`` has the target's texts in its column ``text_col``."""
    spark = docs.sparkSession
    base = workspace(spark, "resampling")
    source = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    gain = gains(_counts(source.select("text"), order, buckets), _counts(target.select(text_col), order, buckets))
    scores = _weights(source, gain, order).withColumn("score", F.col("weight") + noise(seed, F.col("doc_id")))
    scores.write.parquet(f"{base}/scores")
    scored = spark.read.parquet(f"{base}/scores")
    fit = scored.where(F.col("n_words") >= least_words)
    count = fit.count()
    take = count * percent // 100
    if not take:
        return scored.select("doc_id", "n_words", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    low, high, over = bracket(fit, take, count)
    inside = fit
    if low is not None:
        inside = inside.where(F.col("score") >= low)
    if high is not None:
        inside = inside.where(F.col("score") <= high)
    cut = _numbered(inside.select("doc_id", "row", "score"), f"{base}/bracket").where(F.col("rank") == take - over).first()
    kind = scored.schema["doc_id"].dataType
    last = _key(F.lit(cut["score"]).cast("long"), F.lit(cut["doc_id"]).cast(kind), F.lit(cut["row"]).cast("long"))
    drawn = (F.col("n_words") >= least_words) & (_key(F.col("score"), F.col("doc_id"), F.col("row")) <= last)
    ranked = _numbered(scored.where(drawn), f"{base}/drawn")
    left = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(left).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
