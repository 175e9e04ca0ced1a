"""Packing, quality rules, piece codec, token counts, LM scoring against brute force."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import lm_scoring, packing, piece_codec, pieces, repetition, token_counts

from .conftest import HARD, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


def _odd(n: int, letters: str, seed: int, most: int = 60) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(n)]


# ---- piece codec


def test_codec_is_the_library(library):
    texts = [t or "" for t in HARD] + _odd(800, "abtheins  ▁é日😀\n1", 1) + ["the " * 50, "ab" * 3000]
    for text, ids in zip(texts, piece_codec.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text), text[:60]
        assert piece_codec.decode(ids) == library.decode(ids.tolist())


def test_decode_any_ids(library):
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(1, 32000) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randint(0, 9))]
        assert piece_codec.decode(ids) == library.decode(ids)


def test_merge_long_is_the_rounds(library):
    m = pieces.model(pieces.default_path())
    for text in _odd(200, "abcdefgh", 3, 200):
        ids, _ = piece_codec.encode_chunks(m, [text])
        assert piece_codec.merge_long(m, [m.ids[c] for c in text]) == ids.tolist()


def test_codec_table(hard, library):
    got = piece_codec.encode_documents(hard).collect()
    want = hard.select("doc_id", "text").collect()
    assert sorted((r.doc_id or -1, tuple(r.ids), r.decoded) for r in got) == sorted((r.doc_id or -1, tuple(library.encode(r.text or "")), library.decode(library.encode(r.text or ""))) for r in want)


def test_codec_empty_table(nothing):
    assert piece_codec.encode_documents(nothing, digests=True).count() == 0


# ---- token counts


def test_counts_of_all_prefixes(library):
    for text in [t or "" for t in HARD] + _odd(150, "abtheins  ▁é日😀\n1", 4):
        text = text[:300]
        assert token_counts.prefix_counts(text) == [len(library.encode(text[:j])) for j in range(len(text) + 1)]


def test_budgets(spark, hard, library):
    got = token_counts.token_counts(hard, budgets=(1, 7, 100)).collect()
    assert len(got) == hard.count()
    texts = {r.doc_id: r.text or "" for r in hard.where("doc_id is not null and doc_id <> 3").collect()}
    for r in got:
        if r.doc_id not in texts:
            continue
        text = texts[r.doc_id]
        counts = token_counts.prefix_counts(text)
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text)))
        for budget in (1, 7, 100):
            assert r[f"chars_{budget}"] == max(j for j, c in enumerate(counts) if c <= budget)


def test_counts_empty_table(nothing):
    assert token_counts.token_counts(nothing).count() == 0


# ---- packing


@pytest.fixture(scope="module")
def byte_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(pieces.default_path("byte_bpe_50k.json"))


def test_tokenizer_is_the_library(byte_library):
    tokenizer = packing.Tokenizer()
    for text in [t or "" for t in HARD] + _odd(1500, "abs' \n\t  日é1½!\x1c\x85ʰ😀ⅷ", 5, 40) + ["don't 's  <|endoftext|> x<|endoftext|>"]:
        assert np.frombuffer(tokenizer(text), "<u4").tolist() == byte_library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pieces_make_up_the_texts(hard, byte_library, capacity):
    got = packing.pack(hard.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).where("doc_id <> 3"), capacity=capacity, pool_tokens=500).collect()
    by_doc = collections.defaultdict(list)
    by_window = collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
        assert r.length == len(r.ids) // 4 > 0
    for r in hard.where("doc_id is not null and doc_id <> 3").collect():
        parts = sorted(by_doc[r.doc_id], key=lambda x: x.start)
        want = byte_library.encode(r.text or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist() == want
        assert [p.start for p in parts] == np.cumsum([0, *(p.length for p in parts)])[:-1].tolist()
        assert {p.doc_tokens for p in parts} == {len(want)}
    for parts in by_window.values():
        parts.sort(key=lambda x: x.offset)
        assert [p.offset for p in parts] == np.cumsum([0, *(p.length for p in parts)])[:-1].tolist()
        assert sum(p.length for p in parts) <= capacity


def test_best_fit_decreasing():
    rng = random.Random(6)
    for capacity in (10, 16, 37, 128):
        lengths = np.array([rng.randint(1, capacity) for _ in range(300)])
        packer = packing.Packer(capacity)
        window, offset = packer.place(lengths)
        rooms: list[int] = []
        for k in np.argsort(-lengths, kind="stable").tolist():
            fit = [r for r in rooms if r >= lengths[k]]
            room = min(fit) if fit else capacity
            if fit:
                rooms.remove(room)
            assert offset[k] == capacity - room  # the tightest window
            rooms.append(room - int(lengths[k]))
        assert packer.n == len(rooms) == window.max() + 1


def test_packing_empty_table_and_padding(spark, nothing, hard):
    assert packing.pack(nothing).count() == 0
    used = spark.createDataFrame([(0, 1500), (0, 500), (1, 1024), (2, 2048)], "sequence_id long, length long")
    assert {r.sequence_id: r.padding for r in packing.padding(used).collect()} == {0: 48, 1: 0, 2: 0}


def test_crc_is_of_the_ids(hard):
    r = packing.pack(hard.where("doc_id = 12")).withColumn("crc", F.crc32("ids")).first()
    assert r.crc == zlib.crc32(bytes(r.ids))


# ---- quality rules


def _brute(text: str | None, limits=repetition.Limits()):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)

    def grams(k):
        return collections.Counter(tuple(words[i : i + k]) for i in range(n - k + 1))

    def cover(k):
        c, s = grams(k), set()
        for i in range(n - k + 1):
            if c[tuple(words[i : i + k])] > 1:
                s.update(range(i, i + k))
        return len(s)

    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeat, covered = cover(limits.window), cover(limits.min_words)
    longest = 0
    while longest < n and max(grams(longest + 1).values()) > 1:
        longest += 1
    failed = n < limits.least_words or 100 * repeat > limits.max_repeat_percent * n
    kept = not (failed or 100 * covered > limits.max_covered_percent * n or longest > limits.max_longest)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat, covered, longest, failed, kept)


def test_quality_is_brute_force(spark):
    rng = random.Random(7)
    texts = [*HARD, *(" ".join(rng.choice("ab|") for _ in range(rng.randint(1, 60))) for _ in range(200))]
    texts += ["\n".join(" ".join(rng.choice(["the", "of", "é"]) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 20))) for _ in range(100)]
    passage = sentence(rng, 110)
    texts += [sentence(rng, 700) + " " + passage + " " + sentence(rng, 500) + " " + passage, sentence(rng, 300, 100000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    for r in repetition.quality(df).collect():
        assert tuple(r)[1:] == _brute(texts[r.doc_id]), texts[r.doc_id]


def test_keep_good(hard, nothing):
    kept = repetition.keep_good(hard)
    assert kept.columns == hard.columns
    want = [r for r in hard.collect() if _brute(r.text)[-1]]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text)
    assert sorted(kept.collect(), key=key) == sorted(want, key=key)
    assert repetition.keep_good(nothing).count() == 0 and repetition.quality(nothing).count() == 0


# ---- LM scoring


def test_lm_is_brute_force(spark, hard):
    target = spark.createDataFrame([(12,), (13,), (13,), (None,), (999,)], "doc_id long")
    got = lm_scoring.score(hard, target, block_rows=4).collect()
    rows = hard.collect()
    ids = [x.tolist() for x in piece_codec.encode([r.text for r in rows])]
    v = 32000

    def counts(which):
        pair, context, word = collections.Counter(), collections.Counter(), collections.Counter()
        for x in which:
            for a, b in zip([1, *x[:-1]], x, strict=False):
                pair[a, b] += 1
                context[a] += 1
                word[b] += 1
        return pair, context, word, sum(word.values())

    background, own = counts(ids), counts([x for x, r in zip(ids, rows, strict=True) if r.doc_id in (12, 13)])
    scale = own[3] / background[3]

    def loss(m, s, x):
        total = 0.0
        for a, b in zip([1, *x[:-1]], x, strict=False):
            p1 = (m[2][b] * s + 1) / (own[3] + v)
            total -= math.log((m[0][a, b] * s + 64 * p1) / (m[1][a] * s + 64))
        return total / len(x)

    want = sorted((r.doc_id is None, r.doc_id or 0, len(x), *((None,) * 2 if not x else (round(loss(own, 1, x), 9), round(loss(background, scale, x), 9)))) for r, x in zip(rows, ids, strict=True))
    have = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.loss_target if r.loss_target is None else round(r.loss_target, 9), None if r.loss_background is None else round(r.loss_background, 9)) for r in got)
    assert have == want


def test_lm_without_target(spark, hard, nothing):
    none = spark.createDataFrame([], "doc_id long")
    assert {r.ce_difference for r in lm_scoring.score(hard, none).collect()} == {None, 0.0}
    assert lm_scoring.score(nothing, none).count() == 0
