"""Time and memory do not explode with one long text; the network and the scores against
plain versions."""

from __future__ import annotations

import collections
import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lamina.llm import flat, lm_scoring, piece_codec, secret_scan, token_counts, toxicity, url_cascade

from .conftest import sentence


# --- secrets


def test_redaction_is_that_of_merged_spans(spark):
    rng = random.Random(6)
    parts = ["token=abcdefgh1", "é", "😀", " ", "AKIAABCDEFGH123456", "0123456789abcdef" * 2, "password: 日本語", "x", "secret=" + "a1" * 20, "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secret_scan.scan(df).collect()}
    for r in secret_scan.redact(df, length_col=None).collect():
        out, at = [], 0
        for a, b in spans[r.doc_id]:
            if a >= at:
                out += [texts[r.doc_id][at:a], "[SECRET]"]
            at = max(at, b)
        assert r.text == "".join(out) + texts[r.doc_id][at:]


def test_redaction_time_is_linear(spark):
    text = "token=abcdefgh1 some wörds here\n" * 16_000
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    run = lambda d: d.write.format("noop").mode("overwrite").save()
    run(secret_scan.scan(df))
    took = []
    for job in (secret_scan.scan(df), secret_scan.redact(df, length_col=None)):
        began = time.perf_counter()
        run(job)
        took.append(time.perf_counter() - began)
    assert took[1] < 2 * took[0] + 2
    assert secret_scan.redact(df, length_col=None).first().text == "[SECRET] some wörds here\n" * 16_000


# --- toxicity


def plain_scores(model, texts):
    """The network word by word."""
    out = []
    for text in texts:
        low = "".join(c.lower() if ord(c) < 128 else c for c in text)
        words = [w for w in "".join(c if c.isalpha() or ord(c) > 127 else " " for c in low).split(" ") if w]
        vectors = []
        for w in words:
            feats, _, _ = toxicity.word_features(*flat.text_bytes(pa.array([w])))
            vectors.append(sum(model.emb[f[0]] for f in feats))
        pooled, block = [], 0
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best = 0.0
                for i in range(len(words)):
                    z = model.bias[k * toxicity.FILTERS + f]
                    for d in range(min(width, len(words) - i)):
                        z += vectors[i + d] @ model.conv[:, (block + d) * toxicity.FILTERS + f]
                    best = max(best, z)
                pooled.append(best)
            block += width
        out.append(1 / (1 + math.exp(-(np.dot(pooled, model.out) + model.out_bias))))
    return np.array(out)


def random_model(seed):
    rng = np.random.default_rng(seed)
    model = toxicity.Classifier.new(seed)
    model.bias = rng.normal(0, 0.3, len(model.bias)).astype(np.float32)
    model.out = rng.normal(0, 1, len(model.out)).astype(np.float32)
    return model


TEXTS = ["", "a", "one two", "Ünder the bridge", "x1y2 z!", "same same same same"]


def test_scores_are_those_of_the_plain_network():
    rng, model = random.Random(1), random_model(3)
    texts = [*TEXTS, *(sentence(rng, n).replace("w", "wort") for n in (3, 9, 40))]
    got = model.scores(*flat.text_bytes(pa.array(texts)))
    assert np.allclose(got, plain_scores(model, texts), atol=1e-5)


@pytest.mark.parametrize("size", [8, 30, 64, 1000])
def test_windows_give_the_same_scores(monkeypatch, size):
    rng, model = random.Random(2), random_model(4)
    texts = [*TEXTS, " , ".join("abcdefg"[: rng.randint(1, 7)] * rng.randint(1, 9) for _ in range(200)), "z" * 500 + " tail of words", "." * 300, sentence(rng, 90)]
    whole = model.scores(*flat.text_bytes(pa.array(texts)))
    monkeypatch.setattr(toxicity, "SCORE_BYTES", size)
    assert np.allclose(model.scores(*flat.text_bytes(pa.array(texts))), whole, atol=1e-5)


def test_training_follows_the_gradient(monkeypatch):
    """One step with a small rate changes the weights as a numeric gradient of the loss
    says (Adagrad's first step has the gradient's sign)."""
    texts, labels = ["bad word here", "good day to you", "bad day", "you here"], np.array([1, 0, 1, 0])
    data, offsets = flat.text_bytes(pa.array(texts))
    start = random_model(5)
    monkeypatch.setattr(toxicity.Classifier, "new", classmethod(lambda cls, seed=7: cls(start.emb.copy(), start.conv.copy(), start.bias.copy(), start.out.copy(), start.out_bias)))
    trained = toxicity.train(texts, labels, epochs=1, rate=1e-4, batch=4, least_steps=1)

    def loss():
        p = np.clip(start.scores(data, offsets), 1e-12, 1 - 1e-12)
        return float(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())

    feats, _, _ = toxicity.word_features(data, offsets)
    checked = 0
    for name, places in (("out", range(24)), ("bias", range(24)), ("conv", [(i, j) for i in range(12) for j in range(0, 48, 5)]), ("emb", [(f, j) for f in set(feats.ravel().tolist()) for j in range(3)])):
        own, new = getattr(start, name), getattr(trained, name)
        for at in places:
            held, step = own[at], 2e-3
            own[at] = held + step
            up = loss()
            own[at] = held - step
            slope = (up - loss()) / (2 * step)
            own[at] = held
            if abs(slope) > 1e-3:
                assert np.sign(new[at] - held) == -np.sign(slope), (name, at)
                checked += 1
    assert checked > 60


def peak_extra(run) -> int:
    """Bytes that numpy and arrow hold at most while ``run`` goes on."""
    import tracemalloc

    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


@pytest.mark.parametrize("size,word", [(4 << 20, "ab "), (4 << 20, "longerword "), (64 << 20, "several "), (16 << 20, "x")])
def test_memory_of_scoring_does_not_grow_with_a_text(size, word):
    model = random_model(6)
    column = pa.array([word * (size // len(word))])
    data, offsets = flat.text_bytes(column)
    # a copy of the text's one long word is all that may grow
    assert peak_extra(lambda: model.scores(data, offsets)) < (150 << 20) + (size if " " not in word else 0) * 3


# --- scores by language models


@pytest.mark.parametrize("mass", [0.5, 8.0])
def test_texts_are_scored_without_their_own_counts(spark, hard, mass):
    target = spark.createDataFrame([(12,), (13,), (13,), (14,)], "doc_id long")
    got = lm_scoring.score(hard, target, mass=mass, leave_out=True, block_rows=4).collect()
    rows = hard.collect()
    ids = [x.tolist() for x in piece_codec.encode([r.text for r in rows])]
    pairs_of = [list(zip([1, *x[:-1]], x, strict=False)) for x in ids]
    v = 32000

    def counts(which):
        pair, context, word = collections.Counter(), collections.Counter(), collections.Counter()
        for own in which:
            pair.update(own)
            context.update(a for a, _ in own)
            word.update(b for _, b in own)
        return pair, context, word, sum(word.values())

    of_target = [r.doc_id in (12, 13, 14) for r in rows]
    background, own = counts(pairs_of), counts([p for p, t in zip(pairs_of, of_target, strict=True) if t])
    scale = own[3] / background[3]

    def loss(m, s, less, pairs):
        total = 0.0
        for a, b in pairs:
            p1 = ((m[2][b] - less[2][b]) * s + 1) / ((m[3] - less[3]) * s + v)
            total -= math.log(((m[0][a, b] - less[0][a, b]) * s + mass * p1) / ((m[1][a] - less[1][a]) * s + mass))
        return total / len(pairs)

    want = []
    for r, pairs, t in zip(rows, pairs_of, of_target, strict=True):
        mine = counts([pairs])
        two = (round(loss(own, 1, mine if t else counts([]), pairs), 8), round(loss(background, scale, mine, pairs), 8)) if pairs else (None, None)
        want.append((r.doc_id is None, r.doc_id or 0, len(pairs), *two))
    key = lambda x: tuple((y is None, y or 0) for y in x)
    have = [(r.doc_id is None, r.doc_id or 0, r.n_tokens, *(None if x is None else round(x, 8) for x in (r.loss_target, r.loss_background))) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)


def test_a_text_that_occurs_twice_stands_apart(spark):
    """Its copy is in the model that scores it, of other texts nothing is."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    texts = [" ".join(word() for _ in range(60)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:6]])], "doc_id long, text string")
    target = spark.createDataFrame([(i,) for i in range(30, 60)], "doc_id long")
    got = lm_scoring.score(docs, target, mass=8.0, leave_out=True).orderBy("loss_background").collect()
    assert {r.doc_id for r in got[:12]} == {*range(6), *range(60, 66)}


# --- url filters


def test_a_list_above_the_bound_is_judged_in_shards(spark, monkeypatch):
    """Filters of at most 4,096 bits: many shards, the same verdicts."""
    rng = random.Random(3)
    hosts = [f"{rng.choice(['a', 'b.c', 'spam', 'x'])}{rng.randrange(400)}.{rng.choice(['com', 'net', 'example.com', 'org'])}" for _ in range(3000)]
    pages = spark.createDataFrame([(i, f"http://{h}/{rng.choice(['en/', 'es/', 'fr/x', ''])}") for i, h in enumerate(hosts)], "page_id long, url string").repartition(3)
    listed = pages.where("page_id % 3 = 0").select(url_cascade.host(F.col("url")).alias("key")).distinct()
    want = sorted(map(tuple, url_cascade.judge_by_join(pages, listed).collect()))
    assert sorted(map(tuple, url_cascade.judge(pages, listed).collect())) == want
    monkeypatch.setattr(url_cascade, "MAX_BITS", 1 << 12)
    built = []
    build = url_cascade.build
    monkeypatch.setattr(url_cascade, "build", lambda u, c: built.append(c) or build(u, c))
    assert sorted(map(tuple, url_cascade.judge(pages, listed).collect())) == want
    assert len(built) >= 3 * 3


# --- token counts


def test_a_long_run_is_counted_in_time():
    rng = random.Random(12)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    began = time.perf_counter()
    counts = token_counts.prefix_counts(text)
    took = time.perf_counter() - began
    import sentencepiece

    from lamina.llm.pieces import default_path

    library = sentencepiece.SentencePieceProcessor(model_file=default_path())
    for j in [*rng.sample(range(3000), 40), 99_999, 100_000]:
        assert counts[j] == len(library.encode(text[:j]))
    assert took < 30
