"""Packing by dominance, importance resampling and collocations, against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lamina.llm import collocations, dominance, flat, resampling
from lamina.llm.pieces import default_path
from lamina.session import arrow_batches
from .conftest import SCHEMA, rows, sentence


@pytest.fixture(scope="module")
def mixed(spark):
    """Words of several languages with common phrases, punctuation, nulls and repeated rows."""
    rng = random.Random(5)
    texts = []
    for _ in range(120):
        parts = [rng.choice(["New York City", "of the", "state of the art", "é ü", "a a a a", "Été"]) if rng.random() < 0.4 else sentence(rng, 2, 12) for _ in range(rng.randrange(30))]
        texts.append("".join(p + rng.choice([" ", "  ", ", ", ".\n", "\t", "; ", ":", "! "]) for p in parts))
    own = rows([*texts, None, "", ". , ;", texts[0], texts[0]])
    langs = [None, "und", "de", "en", ""]
    return spark.createDataFrame([(*r[:2], langs[i % 7 if i % 7 < 5 else 3], *r[3:]) for i, r in enumerate(own)], SCHEMA)


# --- packing by dominance


def fewest(items: list[int], capacity: int) -> int:
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i: int, used: list[int]) -> None:
        if len(used) >= best[0]:
            return
        if i == len(items):
            best[0] = len(used)
            return
        for room in {u: k for k, u in enumerate(used) if u + items[i] <= capacity}.values():
            used[room] += items[i]
            go(i + 1, used)
            used[room] -= items[i]
        go(i + 1, [*used, items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    rng, sizes = random.Random(3), collections.Counter()
    for _ in range(1500):
        capacity = rng.choice([10, 20, 50, 100])
        low = max(1, capacity // rng.choice([capacity, 5, 4, 3]))
        items = [rng.randint(low, capacity) for _ in range(rng.randrange(10))]
        counts = np.bincount(items, minlength=capacity + 1).astype(np.int64)
        left = counts.copy()
        fixed = dominance.reduce(left, capacity)
        sizes.update(len(s) for s, n in fixed for _ in range(n))
        spent = np.zeros_like(counts)
        for lengths, times in fixed:
            assert sum(lengths) <= capacity
            np.add.at(spent, list(lengths), times)
        assert (spent + left == counts).all()
        rest = np.repeat(np.arange(capacity + 1), left).tolist()
        best = fewest(items, capacity)
        assert sum(n for _, n in fixed) + fewest(rest, capacity) == best
        assert dominance.lower_bound(counts, capacity) <= best <= dominance.Plan(counts, capacity).windows
    assert min(sizes[k] for k in (1, 2, 3)) > 20


def one_by_one(items: list[int], capacity: int) -> int:
    """Best fit decreasing, piece by piece."""
    room: list[int] = []
    for n in sorted(items, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(capacity - n)
    return len(room)


def test_plan_by_counts_equals_best_fit_one_by_one(monkeypatch):
    monkeypatch.setattr(dominance, "reduce", lambda counts, capacity: [])
    rng = random.Random(8)
    for _ in range(200):
        items = [rng.randint(1, 64) for _ in range(rng.randrange(120))]
        plan = dominance.Plan(np.bincount(items, minlength=65), 64)
        assert plan.windows == one_by_one(items, 64)


def test_plan_grows_with_lengths_not_with_pieces():
    rng = np.random.default_rng(1)
    counts = np.bincount(np.clip(rng.lognormal(5.9, 1, 100_000), 2, 2048).astype(int), minlength=2049)
    plan = dominance.Plan(counts * 10**6, 2048)
    assert len(plan.key) < 4 * 2048
    assert plan.windows <= 1.001 * dominance.lower_bound(counts * 10**6, 2048)


def check_packing(docs, got, capacity):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        head = len(ids) % capacity or capacity
        cuts = [0, *range(head, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[r.doc_id, k, a, b - a, np.array(ids[a:b], "<u4").tobytes()] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    windows = collections.defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = [r.length for r in got]
    assert len(windows) <= dominance.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity) + 1


@pytest.mark.parametrize("capacity", [16, 64, 2048])
def test_dominance_packing(hard, capacity):
    flat.on_workers(hard.sparkSession)
    check_packing(hard, dominance.pack(hard.repartition(5), capacity).collect(), capacity)


def test_dominance_packing_of_one_hot_length(spark):
    docs = spark.createDataFrame(rows(["one two three"] * 400 + ["x " * k for k in range(40)] + ["y " * 9000]), SCHEMA).repartition(7)
    check_packing(docs, dominance.pack(docs, 32).collect(), 32)


def test_dominance_packing_of_nothing(nothing):
    assert dominance.pack(nothing).count() == 0


# --- importance resampling


def brute_resample(docs, target, percent, order, buckets, least_words, seed):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return words, [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]

    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (collections.Counter(place(f) for x in texts for f in features(x)[1]) for texts in ([r.text for r in docs], target))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for r in docs:
        words, own = features(r.text)
        h = int(hashlib.sha256(f"{seed}:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(place(f)) for f in own)
        out.append((r.doc_id, len(words), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((x for x in out if x[1] >= least_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = collections.Counter()
    ranks = []
    for k, x in enumerate(able[: len(able) * percent // 100]):
        drawn[x] += 1
        ranks.append((*x, k + 1))
    return ranks + [(*x, None) for x in (collections.Counter(out) - drawn).elements()]


def of(got):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(map(tuple, got), key=key)


@pytest.mark.parametrize("percent,order,least", [(10, 1, 20), (50, 2, 3), (100, 1, 0), (1, 1, 20)])
def test_resampling(mixed, hard, percent, order, least):
    docs = mixed.unionByName(hard)
    target = docs.where("doc_id % 3 = 0").select("text")
    want = brute_resample(docs.collect(), [r.text for r in target.collect()], percent, order, 97, least, 7)
    got = resampling.resample(docs, target, percent, order, 97, least, 7).collect()
    assert of(got) == of(want)


def test_bracket_is_widened_until_it_holds_the_cutoff(spark):
    scores = [(i // 3 if i % 2 else 500,) for i in range(4000)]
    scored = spark.createDataFrame(scores, "score long").repartition(6)
    down = sorted((x for x, in scores), reverse=True)
    for take in (1, 2, 40, 700, 1999, 3999, 4000):
        for error in (1e-9, 0.001):
            low, high, over = resampling.bracket(scored, take, 4000, error)
            assert low is None or low <= down[take - 1]
            assert high is None or down[take - 1] <= high
            assert over == (0 if high is None else sum(x > high for x in down))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_features_of_long_texts_in_windows(monkeypatch, order):
    rng = random.Random(2)
    texts = ["ab," * 40 + "x" * 300 + " " + sentence(rng, 200), "", None, "Z" * 90, sentence(rng, 30)]
    column = pa.array(texts, pa.string())

    def total():
        count, words = collections.Counter(), collections.Counter()
        for lo, hi, place, owner, n in resampling._parts(column, order, 1000):
            count.update(zip((owner + lo).tolist(), place.tolist(), strict=True))
            words.update({lo + k: int(x) for k, x in enumerate(n)})
        return count, +words

    whole = total()
    for size in (16, 64, 100):
        monkeypatch.setattr(resampling, "WINDOW_BYTES", size)
        assert total() == whole


def test_resampling_of_nothing(nothing, hard):
    assert resampling.resample(nothing, hard).count() == 0
    assert resampling.resample(hard, nothing).count() == hard.count()


# --- collocations


def phrases_of(text):
    """Pieces as lists of words."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^ \t]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def brute_frequent(docs, support, longest):
    f, n = collections.Counter(), collections.Counter()
    for r in docs:
        lang = "und" if r.lang is None else r.lang
        for words in phrases_of(r.text):
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    return {k: a for k, a in f.items() if a >= support}, n


def brute_collocations(docs, support, longest, top, percent):
    f, n = brute_frequent(docs, support, longest)
    found = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        longer = [b for (x, q), b in f.items() if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= percent * a for b in longer):
            continue
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for lang, own in found.items() for i, (score, a, p, left, right) in enumerate(sorted(own)[:top]))


@pytest.mark.parametrize("support,top,percent,shard_words", [(5, 2000, 100, 10**6), (8, 7, 100, 60), (3, 2000, 60, 25), (40, 2000, 100, 200)])
def test_collocations(mixed, support, top, percent, shard_words):
    want = brute_collocations(mixed.collect(), support, 5, top, percent)
    got = collocations.collocations(mixed.repartition(3), support, 5, top, percent, shard_words).collect()
    assert sorted(map(tuple, got)) == want
    assert want


@pytest.mark.parametrize("shard_words,window", [(50, 40), (50, 4096), (10**6, 64), (7, 16)])
def test_shards_and_windows_lose_no_phrase(monkeypatch, mixed, shard_words, window):
    """The sums over shards are the counts of all phrases, also where a shard or a
    window of a long text ends inside a piece."""
    monkeypatch.setattr(collocations, "WINDOW_BYTES", window)
    docs = mixed.select("text", "lang").toArrow()
    reader, got, own = collocations.Reader(shard_words, 4), collections.Counter(), 0
    every = lambda lang, times, h: np.ones(len(times), bool)
    for shard in reader.shards(iter(docs.to_batches())):
        own += sum(shard.bytes.values())
        for lang, phrase, n in collocations._grams(shard, 5, np.arange(1, 100, dtype=np.uint64), every):
            names = list(reader.langs)
            for k, p, x in zip(lang.tolist(), phrase.to_pylist(), n.tolist(), strict=True):
                got[names[k], tuple(p.split(" "))] += x
    assert own == sum(len((t or "").encode()) for t in docs.column("text").to_pylist())
    assert dict(+got) == brute_frequent(mixed.collect(), 1, 5)[0]


@pytest.mark.parametrize("shard_words", [3, 20, 10**6])
def test_candidates_do_not_grow_with_the_number_of_shards(mixed, shard_words):
    """The support holds at every level, also where there are more shards than it is: pairs are
    counted only where both words reach it in the whole table."""
    support, f = 40, brute_frequent(mixed.collect(), 1, 2)[0]
    texts = mixed.select("text", "lang").coalesce(1)
    words = collocations._level(texts, 1, None, shard_words).where("hash is not null")
    known = collocations._bit_map(words.groupBy("hash").agg({"n": "sum"}).where(f"sum(n) >= {support}"))
    often = {k for k, a in f.items() if len(k[1]) == 1 and a >= support}
    assert int(np.bitwise_count(known).sum()) == len(often) < sum(len(k[1]) == 1 for k in f) / 2
    pairs = [a for (lang, p), a in f.items() if len(p) == 2 and all((lang, (w,)) in often for w in p)]
    got = collocations._level(texts, 2, known, shard_words).where("hash is not null").collect()
    assert len(got) == len(pairs) and sum(r.n for r in got) == sum(pairs)


def test_hash_counts_held_back_are_bounded(monkeypatch):
    monkeypatch.setattr(collocations, "HELD_ROWS", 100)
    rng, sums, got, want = np.random.default_rng(5), collocations.Sums(), collections.Counter(), collections.Counter()
    for _ in range(50):
        own = rng.integers(0, 300, 60).astype(np.uint64)
        want.update(own.tolist())
        for batch in sums.add(own):
            got.update(dict(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)))
        assert sum(len(h) for h, _ in sums.parts) <= 100
    for batch in sums.rest():
        got.update(dict(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)))
    assert got == want


def test_phrase_counts_held_back_are_bounded(monkeypatch):
    """A task holds so many rows before it adds them up, whatever the last sum left."""
    monkeypatch.setattr(collocations, "HELD_ROWS", 100)
    rng, held, got, want = np.random.default_rng(5), collocations.Held(), collections.Counter(), collections.Counter()

    def take(batches):
        for b in batches:
            for lang, phrase, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got[lang, phrase] += n

    for _ in range(60):
        own, lang = rng.integers(0, 80, 20), rng.integers(0, 2, 20)
        want.update(("xy"[k], str(x)) for k, x in zip(lang.tolist(), own.tolist(), strict=True))
        held.add(collocations._batches({"x": 0, "y": 1}, lang, pa.array(map(str, own.tolist())), np.ones(20, int)))
        assert sum(map(len, held.tables)) <= 100
        take(held.over())
    take(held.rest())
    assert got == want


def test_memory_of_a_level_is_bounded():
    """Twelve MB of short words: what a task works on at once is a part of them."""
    batch = pa.record_batch([pa.array(["ab cd ef gh " * 90_000] * 12), pa.array(["en"] * 12)], names=["text", "lang"])
    seeds, every = np.arange(1, 9, dtype=np.uint64), np.full(1 << (collocations.MAP_BITS - 6), np.uint64(2**64 - 1))
    reader, pairs = collocations.Reader(collocations.SHARD_WORDS, 1), 0
    tracemalloc.start()
    try:
        for shard in reader.shards(iter([batch])):
            pairs += len(collocations._phrase_hashes(shard, 2, seeds, every))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert pairs == 12 * (4 * 90_000 - 1)
    assert peak < 100e6


def test_texts_come_in_batches_of_bounded_bytes(spark, monkeypatch):
    """Python gets few long texts at once, and the session keeps its own setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), []
    level = collocations._level
    monkeypatch.setattr(collocations, "_level", lambda *a: seen.append(spark.conf.get(key)) or level(*a))
    docs = spark.range(0, 300, 1, 1).select(F.lit("a b " * 25_000).alias("text"), F.lit("en").alias("lang"))
    collocations.frequent(docs)
    assert seen and max(map(int, seen)) * 100_000 <= collocations.BATCH_BYTES
    assert spark.conf.get(key) == before

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([len(b)])], names=["n"])

    with arrow_batches(spark, 7):
        assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) == 7


def test_scores_beyond_64_bits(spark):
    """The products of the score pass 64 bits, the score does not."""
    langs = spark.createDataFrame([("en", 4 * 10**12)], "lang string, n long")
    own = spark.createDataFrame([("en", "p", 3 * 10**9), ("en", "q", 7 * 10**9), ("en", "p q", 2 * 10**9)], "lang string, phrase string, a long")
    got = collocations.ranked(own, langs, 10, 100).collect()
    assert [(r.l, r.r, r.score) for r in got] == [(3 * 10**9, 7 * 10**9, 1000 * 2 * 10**9 * 4 * 10**12 // (3 * 10**9 * 7 * 10**9))]


def test_collocations_of_nothing(nothing):
    assert collocations.collocations(nothing).count() == 0
