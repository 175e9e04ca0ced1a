"""A convolutional text classifier for toxicity, trained in numpy.

A word's vector is the sum of three hashed embeddings: of the whole word (A-Z lower
case) and of its first four and five bytes, so inflected and compound forms share what
they begin with. Filters of several widths run over the whole text, each filter keeps
its maximum (max pooling), and a logistic layer gives the score. Labels, language,
source and id are never inputs of a score.

The model is fitted on the driver from a bounded sample of labelled rows: at most
``sample_per_class`` texts of each label, of at most ``sample_chars`` characters, taken
in the order of a hash of the id, a fifth of them not trained on; that bound does not
grow with the data. Thresholds come from all labelled rows that were neither held out
nor trained on, whole texts of any length: Spark scores them and adds up a histogram
(language, label, bin of the score), whose size depends on the number of languages only.
Rows that were trained on are made up for by weights, so that a language's labels stand
in their true proportion at every size of the table. A language's threshold has the best
F1 on its histogram; languages with few labelled rows use that of all. Scoring runs on
every whole text where it lies; texts are never shuffled.

Texts go through the network in windows of ``SCORE_BYTES``, so a task holds the word vectors of
one window whatever a text's length; a text's maxima are the maxima over its windows.

Results for special cases: null and empty texts get the score of a text without words.
Very long texts count whole. An empty table gives no rows. Columns beside the three named have no
influence and are kept where rows are kept.
Rows without a language use the common threshold. Repeated rows get equal scores. With
no labelled rows, or rows of one label only, the score is the share of label 1 among
them (0 without any). A doc_id with several labels counts as 1 if one of them is 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.session import workspace

BITS, DIM, WIDTHS, FILTERS = 15, 12, (1, 2, 3), 8
_LETTER = np.ones(256, bool)
_LETTER[:128] = [chr(b).isalpha() for b in range(128)]


#: Bytes of text whose words go through the network at once.
SCORE_BYTES = 1 << 19


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the word and of its beginnings, one row a word, where the words begin,
    and words by text. Words are runs of ASCII letters and of bytes beyond ASCII."""
    data = flat.LOWER[data]
    starts, ends = flat.spans_between(~_LETTER[data], offsets)
    text = flat.owner(offsets, starts)
    out = np.empty((3, len(starts)), np.int64)
    for row, most in enumerate((None, 4, 5)):
        h = flat.span_hash(data, starts, ends if most is None else np.minimum(ends, starts + most))
        out[row] = (flat.mix(h + np.uint64(row)) >> np.uint64(64 - BITS)).astype(np.int64)
    return out, starts, np.bincount(text, minlength=len(offsets) - 1)


@dataclass
class Classifier:
    """Embeddings, filters (one matrix; width w uses w blocks of FILTERS columns) and
    the logistic layer. ``thresholds``: by language, None for all others."""

    emb: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    constant: float | None = None
    thresholds: dict[str | None, float] = field(default_factory=lambda: {None: 0.5})

    @classmethod
    def new(cls, seed: int = 7) -> Classifier:
        rng = np.random.default_rng(seed)
        f32 = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        return cls(f32(1 << BITS, DIM, scale=0.3), f32(DIM, FILTERS * sum(WIDTHS), scale=0.3), np.zeros(FILTERS * len(WIDTHS), np.float32), f32(FILTERS * len(WIDTHS), scale=0.3), -1.0)

    def activations(self, feats: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word vectors, filter outputs before pooling), a column of outputs a filter.
        A window may reach past its text's end; what lies there counts as zero."""
        x = self.emb[feats[0]]
        x += self.emb[feats[1]]
        x += self.emb[feats[2]]
        p = x @ self.conv
        ends = np.repeat(np.cumsum(counts), counts)
        left = ends - np.arange(len(x))
        z = np.empty((len(x), FILTERS * len(WIDTHS)), np.float32)
        block = 0
        for k, w in enumerate(WIDTHS):
            own = p[:, block * FILTERS : (block + 1) * FILTERS].copy()
            for d in range(1, w):
                more = p[d:, (block + d) * FILTERS : (block + d + 1) * FILTERS]
                own[: len(more)] += more * (left[: len(more)] > d)[:, None]
            z[:, k * FILTERS : (k + 1) * FILTERS] = own
            block += w
        return x, z + self.bias

    def pooled(self, feats: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The maxima of every filter by text, 0 at least."""
        out = np.zeros((len(counts), FILTERS * len(WIDTHS)), np.float32)
        some = counts > 0
        if some.any():
            _, z = self.activations(feats, counts)
            begin = (np.cumsum(counts) - counts)[some]
            out[some] = np.maximum(np.maximum.reduceat(z, begin, axis=0), 0)
        return out

    def pooled_long(self, data: np.ndarray) -> np.ndarray:
        """The same for one text, window by window: the maximum of the windows' maxima.
        A window begins with the last words of the one before, whose filters reach into
        it, and leaves its own last words to the next."""
        out = np.zeros(FILTERS * len(WIDTHS), np.float32)
        back, before = max(WIDTHS) - 1, data[:0]
        for begin, end in flat.cuts(data, ~_LETTER, SCORE_BYTES):
            window = np.concatenate([before, data[begin:end]])
            feats, starts, counts = word_features(window, np.array([0, len(window)]))
            if end < len(data):
                own = max(0, len(starts) - back)
                before = window[starts[own] :] if len(starts) else data[:0]
            else:
                own = len(starts)
            if own:
                _, z = self.activations(feats, counts)
                np.maximum(out, z[:own].max(0), out=out)
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        pooled = np.zeros((len(offsets) - 1, FILTERS * len(WIDTHS)), np.float32)
        for lo, hi, part, inner in flat.slices(data, offsets, SCORE_BYTES):
            if len(part) <= SCORE_BYTES:
                feats, _, counts = word_features(part, inner)
                pooled[lo:hi] = self.pooled(feats, counts)
            else:
                pooled[lo] = self.pooled_long(part)
        logits = (pooled * self.out).sum(1, dtype=np.float64) + self.out_bias
        return 1 / (1 + np.exp(-logits))

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang, self.thresholds[None])


def train(texts: list[str | None], labels: np.ndarray, epochs: int = 8, rate: float = 0.05, batch: int = 32, seed: int = 7, least_steps: int = 800) -> Classifier:
    """Adagrad on the logistic loss, both labels weighted alike; the gradient of the
    maximum flows to the window that holds it. Few texts are gone through more often,
    for ``least_steps`` steps in all."""
    model, rng = Classifier.new(seed), np.random.default_rng(seed)
    labels = np.asarray(labels, np.float32)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        model.constant = share
        return model
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    data, offsets = flat.text_bytes(pa.array(texts, pa.string()))
    feats, _, counts = word_features(data, offsets)
    ends = np.cumsum(counts)
    names = ("emb", "conv", "bias", "out")
    second = {k: np.full_like(getattr(model, k), 1e-3) for k in names}
    bias_second = 1e-3
    filters = FILTERS * len(WIDTHS)
    for _ in range(max(epochs, -(-least_steps * batch // len(labels)))):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), batch):
            rows = order[lo : lo + batch]
            rows = rows[counts[rows] > 0]
            if not len(rows):
                continue
            n = counts[rows]
            own = feats[:, flat.ragged(ends[rows] - n, n)]
            x, z = model.activations(own, n)
            cut = np.cumsum(n) - n
            top = np.stack([a + z[a : a + k].argmax(0) for a, k in zip(cut.tolist(), n.tolist(), strict=True)])
            value = z[top, np.arange(filters)]
            pooled = np.maximum(value, 0)
            p = 1 / (1 + np.exp(-(pooled @ model.out + model.out_bias)))
            err = (p - labels[rows]) * weight[rows] / len(rows)
            g_out = pooled.T @ err
            g = np.outer(err, model.out) * (value > 0)
            g_conv, g_x = np.zeros_like(model.conv), {}
            stop = np.cumsum(n)[:, None]
            at_all, gx_all = [], []
            block = 0
            for k, w in enumerate(WIDTHS):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                for d in range(w):
                    at = top[:, cols] + d
                    inside = at < stop
                    gd = g[:, cols] * inside
                    at = np.minimum(at, len(x) - 1)
                    band = slice((block + d) * FILTERS, (block + d + 1) * FILTERS)
                    g_conv[:, band] += np.einsum("rfd,rf->df", x[at], gd)
                    at_all.append(at.ravel())
                    gx_all.append((gd[:, :, None] * model.conv[:, band].T[None]).reshape(-1, DIM))
                block += w
            at, gx = np.concatenate(at_all), np.concatenate(gx_all)
            word = own[:, at].ravel()
            slots, back = np.unique(word, return_inverse=True)
            g_emb = np.zeros((len(slots), DIM), np.float32)
            np.add.at(g_emb, back, np.tile(gx, (3, 1)))
            second["emb"][slots] += g_emb**2
            model.emb[slots] -= rate * g_emb / np.sqrt(second["emb"][slots])
            for key, grad in (("conv", g_conv), ("bias", g.sum(0)), ("out", g_out)):
                second[key] += grad**2
                setattr(model, key, getattr(model, key) - (rate * grad / np.sqrt(second[key])).astype(np.float32))
            bias_second += float(err.sum()) ** 2
            model.out_bias -= rate * float(err.sum()) / bias_second**0.5
    return model


#: The least score of each bin but the first, even in the logit; a threshold lies on or
#: between them, so a bin is on one side of it.
EDGES = 1 / (1 + np.exp(-np.linspace(-20, 20, 2049)))


def best_threshold(counts: np.ndarray) -> float:
    """The threshold with the best F1 on the counts (2 x bins) of labels 0 and 1; in
    the middle of the gap between the two bins that it lies between."""
    bins = np.flatnonzero(counts.sum(0))[::-1]
    hit, chosen = np.cumsum(counts[1, bins]), np.cumsum(counts[:, bins].sum(0))
    k = int((2 * hit / (chosen + counts[1].sum())).argmax())
    top = float(EDGES[bins[k] - 1]) if bins[k] else 0.0
    return (top + float(EDGES[bins[k + 1]])) / 2 if k + 1 < len(bins) else top / 2


def _weighted(counts: np.ndarray, trained: np.ndarray) -> np.ndarray:
    """Counts (2 x bins) at the true label rate, from counts by label, kind of text and
    bin (2 x 2 x bins) of the rows not trained on, and how many of each label and kind
    were: those are taken to score like the others of their label and kind."""
    left = counts.sum(2)
    out = (counts * ((left + trained) / np.maximum(left, 1))[:, :, None]).sum(1)
    return out * ((left + trained).sum(1) / np.maximum(out.sum(1), 1e-300))[:, None]


def calibrate(model: Classifier, histogram: list[tuple[str | None, int, bool, int | None, int]], least: int = 20) -> None:
    """Sets the thresholds from rows (lang, label, short, bin, count); the bin is null
    for rows that were trained on. A language needs ``least`` other rows of either label."""
    if model.constant is not None:
        return
    by_lang: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    empty = lambda: (np.zeros((2, 2, len(EDGES) + 1)), np.zeros((2, 2)))
    common = empty()
    for lang, label, short, place, n in histogram:
        for counts, trained in (common, by_lang.setdefault(lang, empty()) if lang else empty()):
            if place is None:
                trained[int(label), int(short)] += n
            else:
                counts[int(label), int(short), place] += n
    for lang, (counts, trained) in [(None, common), *by_lang.items()]:
        if counts.sum((1, 2)).min() >= (least if lang else 1):
            model.thresholds[lang] = best_threshold(_weighted(counts, trained))


def histogram(docs: DataFrame, marked: DataFrame, trained: DataFrame, model: Classifier, sample_chars: int) -> DataFrame:
    """(lang, toxic, short, bin, n) of all labelled rows of ``docs`` (doc_id, text,
    lang, place). ``marked``: doc_id, toxic; ``trained``: doc_id, place of the few rows
    that were trained on, whose bin is null; short: at most ``sample_chars`` characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in flat.row_slices(batch, 1):
                place = np.searchsorted(EDGES, m.scores(*flat.text_bytes(part.column(1))), side="right")
                place = pa.array(place, pa.int32(), mask=part.column(4).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), place], names=["doc_id", "lang", "short", "bin"])

    rows = docs.where("doc_id is not null").where(bucket(F.col("doc_id")) != 0)
    rows = rows.join(F.broadcast(trained.withColumn("trained", F.lit(True))), ["doc_id", "place"], "left")
    rows = rows.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), (F.length("text") <= sample_chars).alias("short"), F.coalesce("trained", F.lit(False)).alias("trained"))
    binned = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang string, short boolean, bin int")
    return _added_up(binned, marked)


def _added_up(binned: DataFrame, marked: DataFrame) -> DataFrame:
    """(lang, toxic, short, bin, n) from a row (doc_id, lang, short, bin) a text. Only ids and
    bins are shuffled; rows of one id are added up before they meet its label."""
    of_id = binned.where("doc_id is not null").groupBy("doc_id", "lang", "short", "bin").agg(F.count("*").alias("n"))
    return of_id.join(marked, "doc_id").groupBy("lang", "toxic", "short", "bin").agg(F.sum("n").alias("n"))


def bucket(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5: 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def _marked(labels: DataFrame) -> DataFrame:
    """doc_id, toxic of the labelled rows that aren't held out."""
    marked = labels.where("doc_id is not null and toxic is not null").where(bucket(F.col("doc_id")) != 0)
    return marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _place() -> Column:
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def learn(docs: DataFrame, marked: DataFrame, sample_per_class: int, sample_chars: int, **training) -> tuple[Classifier, DataFrame]:
    """A classifier trained on a bounded sample of the labelled rows of ``docs`` (doc_id,
    text, lang), and (doc_id, place) of the rows that were trained on."""
    spark = docs.sparkSession
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", (F.length("text") <= sample_chars).alias("short"))
    source = source.where("short").withColumn("place", _place())
    # which texts: found by ids and hashes alone, then fetched by a join with these few
    known = source.select("doc_id", "place").join(marked, "doc_id")
    picked = []
    for label in (0, 1):
        picked += known.where(F.col("toxic") == label).orderBy("place", "doc_id").limit(sample_per_class).collect()
    own = []
    if picked:
        # at most 2 * sample_per_class rows
        sample = spark.createDataFrame(picked, known.schema).dropDuplicates(["doc_id", "place"])
        texts = source.join(F.broadcast(sample), ["doc_id", "place"]).dropDuplicates(["doc_id", "place"])
        rows = texts.select("doc_id", "text", "lang", "toxic", "place").collect()
        rows.sort(key=lambda r: (r.place, r.text, r.lang or ""))
        own = [r for i, r in enumerate(rows) if i % 5]
    model = train([r.text for r in own], np.array([r.toxic for r in own]), **training)
    return model, spark.createDataFrame([(r.doc_id, r.place) for r in own], known.select("doc_id", "place").schema)


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = 2000, sample_chars: int = 6000, **training) -> Classifier:
    """Trains on a bounded sample of the labelled rows that aren't held out, and sets
    the thresholds from all of them that were not trained on."""
    marked = _marked(labels)
    model, trained = learn(docs, marked, sample_per_class, sample_chars, **training)
    if model.constant is None:
        whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang").withColumn("place", _place())
        calibrate(model, [tuple(r) for r in histogram(whole, marked, trained, model, sample_chars).collect()])
    return model


def judge(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None, sample_per_class: int = 2000, sample_chars: int = 6000, **training) -> DataFrame:
    """:func:`fit` on ``docs`` and the verdict on each of its rows, with one pass of the
    network over the texts: the ``columns`` of ``docs`` (all by default) and a last column
    ``verdict`` (score, threshold, toxic), with underscores before its name if ``docs`` has
    that name. The scores are a table in the shared folder, the histogram and the verdicts are
    taken from it."""
    spark = docs.sparkSession
    columns = docs.columns if columns is None else columns
    free = lambda name: name if name not in docs.columns else free(f"_{name}")
    short, place, known, score_, bin_, verdict = map(free, ("short", "place", "trained", "score", "bin", "verdict"))
    marked = _marked(labels)
    model, trained = learn(docs, marked, sample_per_class, sample_chars, **training)
    shared = spark.sparkContext.broadcast(model)  # its size is fixed by BITS and DIM
    rows = docs.withColumn(short, F.coalesce(F.length("text") <= sample_chars, F.lit(True))).withColumn(place, _place())
    # at most 2 * sample_per_class rows
    of_sample = trained.select(F.col("doc_id").alias("_sample_id"), F.col("place").alias("_sample_place"), F.lit(True).alias(known))
    rows = rows.join(F.broadcast(of_sample), (F.col("doc_id") == F.col("_sample_id")) & (F.col(place) == F.col("_sample_place")), "left")
    rows = rows.select(*{c: 0 for c in [*columns, "doc_id", "lang", "text"]}, short, F.coalesce(known, F.lit(False)).alias(known))
    text_at = rows.columns.index("text")
    kept = [i for i, c in enumerate(rows.columns) if c != "text" or "text" in columns]
    schema = ", ".join(f"`{rows.columns[i]}` {rows.schema[i].dataType.simpleString()}" for i in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in flat.row_slices(batch, text_at):
                s = m.scores(*flat.text_bytes(part.column(text_at)))
                b = np.searchsorted(EDGES, s, side="right")
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pa.array(s), pa.array(b, pa.int32())], names=[*(part.schema.names[i] for i in kept), score_, bin_])

    path = f"{workspace(spark, 'toxicity')}/scores"
    rows.mapInArrow(run, f"{schema}, `{score_}` double, `{bin_}` int").write.parquet(path)
    scored = spark.read.parquet(path)
    if model.constant is None:
        known_bin = F.when(~F.col(known), F.col(bin_))
        counts = scored.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col(short).alias("short"), known_bin.alias("bin"))
        calibrate(model, [tuple(r) for r in _added_up(counts, marked).collect()])
    limit = F.lit(model.thresholds[None])
    own = {k: v for k, v in model.thresholds.items() if k is not None}  # one a language
    if own:
        by_lang = F.create_map(*(F.lit(x) for pair in own.items() for x in pair))
        limit = F.coalesce(F.try_element_at(by_lang, F.col("lang").cast("string")), limit)
    said = F.struct(F.col(score_).alias("score"), limit.alias("threshold"), (F.col(score_) >= limit).alias("toxic"))
    return scored.select(*columns, said.alias(verdict))


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row a row of ``docs``: doc_id, score, lang, threshold, toxic (score at or
    over the language's threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BITS and DIM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in flat.row_slices(batch, 1):
                s = m.scores(*flat.text_bytes(part.column(1)))
                t = np.array([m.threshold(x) for x in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), part.column(2), pa.array(t, pa.float64()), pa.array(s >= t)], names=["doc_id", "score", "lang", "threshold", "toxic"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double, lang string, threshold double, toxic boolean")


def keep_clean(docs: DataFrame, model: Classifier, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all their columns, below their language's threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in flat.row_slices(batch, text_at):
                t = np.array([m.threshold(x) for x in part.column(lang_at).to_pylist()])
                yield part.filter(pa.array(m.scores(*flat.text_bytes(part.column(text_at))) < t))

    return docs.mapInArrow(run, docs.schema)
