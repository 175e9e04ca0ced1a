"""Phrase collocations by language, found level by level behind bit maps.

A phrase is a run of words within one piece of a text (pieces end at punctuation and line
breaks). It is a candidate if it occurs ``support`` times or more in its language.

1. *Levels.* For m = 1, 2, ... a pass over the texts counts the phrases of m words by a 64-bit hash
   (language included); Spark adds the counts of all tasks up. What reaches the support sets a bit in a
   map of fixed size, and the next pass looks only at phrases whose first and whose last m - 1 words are
   in it. Equal hashes or bits of different phrases add candidates, none is lost: a phrase is never more
   frequent than its parts.
2. *Exact counts.* The maps of all levels together tell which phrases may be frequent. Every task
   counts these in its texts, one row a phrase and task, and the sums are exact: a
   phrase whose bit is set by chance is counted in all tasks alike, and costs only its rows.
   What reaches the support stays.
3. *Scores.* For each cut of a phrase in two, 1000 * a * n / (l * r) in decimals of 38 digits,
   by joins of the frequent phrases with themselves. Phrases that occur inside a longer one
   nearly as often as alone go; it is enough to look one word further, as no longer phrase is
   more frequent than those inside.

The support is that of the whole table at every level, however many tasks there are. A phrase that a
third of all texts hold is one row a task in each shuffle (some, where a task meets more phrases than half
of ``HELD_ROWS``). What goes to the driver: two numbers a language, and the bit maps. A task's memory is bounded by
``shard_words``, ``HELD_ROWS`` and ``BATCH_BYTES`` whatever its text: texts come in batches of a few MB and are read in
windows, and a shard that ends inside a piece looks ahead at the next words of it.

Results for special cases: null and empty texts have no phrases. A null language is
``und``. Repeated rows count as often as they occur, ids have no influence. Very long texts
count whole. Ties are broken as stated at :func:`collocations`. An empty table gives no rows.
Columns beside the two named have no influence.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.session import arrow_batches, workspace

#: Bytes that end a piece, and bytes between words.
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[*b".,;:!?", 10, 11, 12, 13]] = True
IS_CUT = ENDS_PIECE.copy()
IS_CUT[[32, 9]] = True

WINDOW_BYTES = 1 << 20
#: Words worked on at once; only memory and time depend on it.
SHARD_WORDS = 500_000
#: Bytes of text that a task is given at once, as far as texts are of like length.
BATCH_BYTES = 4 << 20
#: Rows that a task holds back to add them up (a merge leaves that many at most), and bytes of
#: text that a task counts at most (unless one partition has more).
HELD_ROWS, TASK_BYTES = 500_000, 1 << 30
#: log2 of the bit map's size: 8 MB.
MAP_BITS = 26
#: Parts in which the phrases of a shard and length are counted one after the other.
_PARTS = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


@dataclass
class Shard:
    """Words of consecutive windows of text, and how they hang together. The first ``size``
    words are its own; others are of the same piece as the last of them."""

    words: list[pa.DictionaryArray] = field(default_factory=list)
    lang: list[np.ndarray] = field(default_factory=list)
    joined: list[np.ndarray] = field(default_factory=list)
    bytes: dict[int, int] = field(default_factory=dict)
    size: int = 0

    def add(self, words: pa.DictionaryArray, lang: np.ndarray, joined: np.ndarray) -> None:
        self.words.append(words)
        self.lang.append(lang)
        self.joined.append(joined)

    def clear(self) -> None:
        self.words, self.lang, self.joined = [], [], []


class Reader:
    """Cuts batches of (text, language) into shards; ``langs`` numbers the languages."""

    def __init__(self, shard_words: int, ahead: int):
        self.shard_words, self.ahead = shard_words, ahead
        self.langs: dict[str, int] = {}

    def _window(self, data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, follows: bool) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray, bool]:
        """Words, their languages, whether each follows the one before in its piece, and
        whether a next window's first word would. ``follows``: the first word does if no
        piece ends before it."""
        ends_piece, cut = ENDS_PIECE[data], IS_CUT[data]
        starts, ends = flat.spans_between(cut, offsets)
        if not len(starts):
            return pa.array([], pa.string()).dictionary_encode(), codes[:0], np.zeros(0, bool), follows and not ends_piece.any()
        text = flat.owner(offsets, starts)
        passed = np.cumsum(ends_piece, dtype=np.int32)
        joined = np.zeros(len(starts), bool)
        joined[1:] = (text[1:] == text[:-1]) & (passed[starts[1:]] == passed[ends[:-1] - 1])
        joined[0] = follows and not ends_piece[: starts[0]].any()
        length = ends - starts
        at = np.zeros(len(length) + 1, np.int32)
        np.cumsum(length, out=at[1:])
        letters = flat.LOWER[data[~cut]]  # those of all words, one after the other
        words = pa.Array.from_buffers(pa.string(), len(length), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(letters.tobytes())])
        return words.dictionary_encode(), codes[text], joined, not ends_piece[ends[-1] :].any()

    def _windows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            data, offsets = flat.text_bytes(batch.column(0))
            own = [self.langs.setdefault(x if x is not None else "und", len(self.langs)) for x in batch.column(1).to_pylist()]
            codes = np.array(own, np.int16 if len(self.langs) < 1 << 15 else np.int32)
            for lo, hi, part, inner in flat.slices(data, offsets, WINDOW_BYTES):
                if len(part) <= WINDOW_BYTES:
                    size = np.bincount(codes[lo:hi], weights=np.diff(inner))
                    yield *self._window(part, inner, codes[lo:hi], False)[:3], {k: int(size[k]) for k in np.flatnonzero(size).tolist()}
                    continue
                follows = False
                for a, b in flat.cuts(part, IS_CUT, WINDOW_BYTES):
                    *window, follows = self._window(part[a:b], np.array([0, b - a]), codes[lo:hi], follows)
                    yield *window, {int(codes[lo]): b - a}

    def shards(self, batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        """Shards of about ``shard_words`` words. A task's last ones are of like size, half
        as much again at most: a small rest would have a support that everything reaches."""
        held: deque[tuple] = deque()
        total = widest = 0
        for window in self._windows(batches):
            held.append(window)
            total += len(window[0])
            widest = max(widest, len(window[0]))
            # a shard ends with a window, and the words ahead of it are held
            if total >= max(2 * self.shard_words, self.shard_words + widest + self.ahead):
                yield (shard := self._take(held, self.shard_words))
                total -= shard.size
        for left in range(2 if total > 1.5 * self.shard_words else 1, 0, -1):
            yield (shard := self._take(held, total // left if left > 1 else total))
            total -= shard.size

    def _take(self, held: deque[tuple], words: int) -> Shard:
        """The first windows with so many words, and what the last one's piece goes on with."""
        shard = Shard()
        while held and (shard.size < words or not len(held[0][0])):
            own, lang, joined, size = held.popleft()
            if len(own) and not shard.size:
                joined = joined.copy()
                joined[0] = False
            shard.add(own, lang, joined)
            shard.size += len(own)
            for k, n in size.items():
                shard.bytes[k] = shard.bytes.get(k, 0) + n
        asked = self.ahead if shard.size else 0
        for own, lang, joined, _ in held:
            run = joined[:asked]
            more = len(run) if run.all() else int(run.argmin())
            shard.add(own[:more], lang[:more], joined[:more])
            asked = asked - more if more == len(run) else 0
            if not asked:
                break
        return shard


Rule = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _blocks(x: np.ndarray) -> Iterator[np.ndarray]:
    """An array in parts, so that what is made of it is small; one empty part of none."""
    yield x[: 1 << 18]
    for lo in range(1 << 18, len(x), 1 << 18):
        yield x[lo : lo + (1 << 18)]


def _grams(shard: Shard, longest: int, hashes: np.ndarray, keep: Rule) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """For each length the phrases that ``keep`` (language, occurrences, hash) chooses:
    languages, phrases, occurrences that begin at the shard's own words. A phrase is looked at
    where its first and its last words but one were kept."""
    if not shard.size:
        return
    whole = pa.chunked_array(shard.words).unify_dictionaries()
    shard.words = []
    vocabulary = whole.chunk(0).dictionary.cast(pa.string())
    word = np.concatenate([c.indices.to_numpy() for c in whole.chunks])
    lang = np.concatenate(shard.lang)
    joined = np.concatenate(shard.joined)
    own_words = shard.size
    shard.clear()
    del whole
    letters, offsets = flat.text_bytes(vocabulary)
    word_hash = flat.span_hash(letters, offsets[:-1], offsets[1:])
    at = np.arange(len(word), dtype=np.int32)  # where the phrases looked at begin
    gram, known = word, np.zeros(0, np.uint64)  # number and hash of the kept phrase that begins here
    for m in range(1, longest + 1):
        if m > 1:
            at = np.concatenate([x[joined[x + m - 1] & (gram[x] >= 0) & (gram[x + 1] >= 0)] for x in _blocks(at[: int(np.searchsorted(at, len(word) - m + 1))])])
        after, kept, found = np.full(len(word), -1, np.int32), [], 0
        part = np.concatenate([(gram[x] % _PARTS).astype(np.int8) for x in _blocks(at)])
        for p in range(_PARTS):
            here = at[part == p]
            if not len(here):
                continue
            key = lang[here].astype(np.int64) if m == 1 else gram[here].astype(np.int64)
            key *= len(vocabulary) if m == 1 else len(known)
            key += gram[here if m == 1 else here + 1]
            coded = pa.array(key).dictionary_encode()  # numbered as they come
            inverse = coded.indices.to_numpy()
            del key, coded
            first = np.flatnonzero(np.diff(np.maximum.accumulate(inverse), prepend=-1))
            begin = here[first]
            before = hashes[lang[begin]] if m == 1 else known[gram[begin]]
            own_hash = flat.mix(before * _STEP + word_hash[word[begin + m - 1]])
            chosen = keep(lang[begin], np.bincount(inverse, minlength=len(begin)), own_hash)
            number = np.full(len(begin), -1, np.int32)
            number[chosen] = np.arange(found, found + int(chosen.sum()), dtype=np.int32)
            after[here] = number[inverse]
            found += int(chosen.sum())
            kept.append(own_hash[chosen])
            own = np.bincount(inverse[: int(np.searchsorted(here, own_words))], minlength=len(begin))[chosen]
            begin = begin[chosen]
            del inverse, first, before, own_hash, number
            words = [vocabulary.take(pa.array(word[begin + k])) for k in range(m)]
            yield lang[begin], pc.binary_join_element_wise(*words, " "), own
        if not found:
            return
        gram, known = after, np.concatenate(kept)
        del after
        at = np.concatenate([x[gram[x] >= 0] for x in _blocks(at)])


def _batches(langs: dict[str, int], lang: np.ndarray, phrase: pa.Array, f: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = np.array(list(langs), object)
    for lo in range(0, len(lang), 1 << 16):
        part = slice(lo, lo + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(names[lang[part]], pa.string()), phrase[part], pa.array(f[part].astype(np.int64))], names=["lang", "phrase", "f"])


class Held:
    """Rows (lang, phrase, numbers) that a task holds back, to add up those of one phrase."""

    def __init__(self):
        self.tables: list[pa.Table] = []
        self.merged = 0  # rows that the last merge left

    def add(self, batches: Iterator[pa.RecordBatch]) -> None:
        self.tables += [pa.Table.from_batches([b]) for b in batches]
        if sum(map(len, self.tables)) > HELD_ROWS:
            self._merge()

    def _merge(self) -> None:
        if self.tables:
            names = self.tables[0].column_names
            added = pa.concat_tables(self.tables).group_by(names[:2], use_threads=False).aggregate([(c, "sum") for c in names[2:]])
            self.tables, self.merged = [added.rename_columns(names)], len(added)

    def over(self) -> Iterator[pa.RecordBatch]:
        """All rows, once a merge leaves more than half of ``HELD_ROWS``."""
        if self.merged > HELD_ROWS // 2:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        for table in self.tables:
            yield from table.combine_chunks().to_batches(1 << 16)
        self.tables, self.merged = [], 0


def _lang_hashes(langs: dict[str, int]) -> np.ndarray:
    return np.array([_lang_hash(x) for x in langs], np.uint64)


class Sums:
    """Numbers by 64-bit hash that a task adds up, ``HELD_ROWS`` hashes at most."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(np.unique(hashes, return_counts=True))
        if sum(len(h) for h, _ in self.parts) > HELD_ROWS:
            self._merge()
            if len(self.parts[0][0]) > HELD_ROWS // 2:
                yield from self.rest()

    def _merge(self) -> None:
        if len(self.parts) > 1:
            own = np.concatenate([h for h, _ in self.parts])
            order = np.argsort(own)
            own = own[order]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
            n = np.concatenate([n for _, n in self.parts])[order]
            self.parts = [(own[first], np.add.reduceat(n, first) if len(first) else n)]

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        for hashes, n in self.parts:
            for lo in range(0, len(hashes), 1 << 16):
                h = pa.array(hashes[lo : lo + (1 << 16)].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(h), pa.string()), h, pa.array(n[lo : lo + (1 << 16)].astype(np.int64))], names=["lang", "hash", "n"])
        self.parts = []


def _in_map(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes have their bit in the map."""
    bit = h >> np.uint64(64 - MAP_BITS)
    return (known[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _phrase_hashes(shard: Shard, m: int, seeds: np.ndarray, known: np.ndarray | None) -> np.ndarray:
    """The hashes (as those of :func:`_grams`) of the phrases of ``m`` words that begin at the shard's
    own words and whose first and last ``m`` - 1 words the map knows."""
    own = []
    for words in shard.words:
        letters, offsets = flat.text_bytes(words.dictionary.cast(pa.string()))
        own.append(flat.span_hash(letters, offsets[:-1], offsets[1:])[words.indices.to_numpy()])
    word, lang, joined = np.concatenate(own), np.concatenate(shard.lang), np.concatenate(shard.joined)
    del own
    h = flat.mix(seeds[lang] * _STEP + word)
    whole = np.ones(len(word), bool)
    for k in range(2, m + 1):
        n = max(0, len(word) - k + 1)
        whole = whole[:n] & joined[k - 1 : k - 1 + n]
        if k == m:
            listed = _in_map(known, h)
            whole &= listed[:n] & listed[1 : n + 1]
        h = flat.mix(h[:n] * _STEP + word[k - 1 : k - 1 + n])
    return h[: shard.size][whole[: shard.size]]


def _level(texts: DataFrame, m: int, known: np.ndarray | None, shard_words: int) -> DataFrame:
    """Rows (lang, hash, n): occurrences of the phrases of ``m`` words, by hash (``lang`` null), and for
    ``m`` = 1 the words of each language (``hash`` null). The rows of a task's shards are added up."""
    shared = None if known is None else texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, sums, words = Reader(shard_words, m - 1), Sums(), {}
        for shard in reader.shards(batches):
            if not shard.size:
                continue
            if m == 1:
                for k, n in enumerate(np.bincount(np.concatenate(shard.lang)[: shard.size]).tolist()):
                    words[k] = words.get(k, 0) + n
            yield from sums.add(_phrase_hashes(shard, m, _lang_hashes(reader.langs), shared and shared.value))
            flat.give_back()
        yield from sums.rest()
        names = list(reader.langs)
        own = {names[k]: n for k, n in words.items() if n}
        if own:
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.nulls(len(own), pa.int64()), pa.array(list(own.values()), pa.int64())], names=["lang", "hash", "n"])

    return texts.mapInArrow(run, "lang string, hash long, n long")


def _bit_map(hashes: DataFrame) -> np.ndarray:
    """A bit for every ``hash``; the map's size is fixed."""
    bit = F.shiftrightunsigned("hash", 64 - MAP_BITS)
    slot, bits = F.shiftright(bit, 6).cast("int"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - MAP_BITS}) & 63 AS int))")
    found = hashes.select(slot.alias("slot"), bits.alias("bits")).groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _counted(texts: DataFrame, known: np.ndarray, longest: int, shard_words: int) -> DataFrame:
    """Rows (lang, phrase, f) of the phrases that the bit map knows: one a phrase and task, more
    where a task meets more than ``HELD_ROWS`` of them."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held = Reader(shard_words, longest - 1), Held()

        def listed(_, __, h: np.ndarray) -> np.ndarray:
            return _in_map(shared.value, h)

        for shard in reader.shards(batches):
            for lang, phrase, own in _grams(shard, longest, _lang_hashes(reader.langs), listed):
                some = own > 0
                held.add(_batches(reader.langs, lang[some], phrase.filter(pa.array(some)), own[some]))
                yield from held.over()
            flat.give_back()
        yield from held.rest()

    return texts.mapInArrow(run, "lang string, phrase string, f long")


def frequent(docs: DataFrame, support: int = 100, longest: int = 5, shard_words: int = SHARD_WORDS, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases of 2 to ``longest`` words that occur ``support`` times or more in a
    language, and their words (lang, phrase, a), and the words of each language (lang, n)."""
    spark = docs.sparkSession
    base = workspace(spark, "collocations")
    texts = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    size, rows = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    # several partitions to a task: a phrase is counted in fewer tasks
    texts = texts.coalesce(max(2 * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))
    known, any_level = None, np.zeros(1 << (MAP_BITS - 6), np.uint64)
    with arrow_batches(spark, max(1, BATCH_BYTES * rows // max(1, size))):
        for m in range(1, longest + 1):
            counts = _level(texts, m, known, shard_words)
            if m == 1:
                counts.write.parquet(f"{base}/words")
                counts = spark.read.parquet(f"{base}/words")
                langs = counts.where("lang is not null").groupBy("lang").agg(F.sum("n").alias("n"))
            known = _bit_map(counts.where("hash is not null").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= support))
            any_level |= known
            if not known.any():
                break
        # one row a language
        langs = spark.createDataFrame([tuple(r) for r in langs.collect()], "lang string, n long")
        counted = _counted(texts, any_level, longest, shard_words)
        counted = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("a")).where(F.col("a") >= support)
        counted.write.parquet(f"{base}/frequent")
    return spark.read.parquet(f"{base}/frequent"), langs


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, top: int = 2000, within_percent: int = 100, shard_words: int = SHARD_WORDS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank (from 1), phrase, a (occurrences), l
    and r (those of its two parts), n (words of the language), score. A phrase's score is that
    of its lowest cut, of equal ones the first; phrases within a longer one that has
    ``within_percent`` of their occurrences are left out. Order: score and a downwards, phrase
    by its bytes."""
    return ranked(*frequent(docs, support, longest, shard_words, text_col, lang_col), top, within_percent)


def ranked(all_: DataFrame, langs: DataFrame, top: int, within_percent: int) -> DataFrame:
    """:func:`collocations` from frequent phrases (lang, phrase, a) and languages (lang, n)."""
    words = F.split("phrase", " ", -1)
    several = all_.where(F.size(words) > 1)
    # the parts of every cut, and what occurs inside a phrase with one word less
    cuts = several.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring(phrase, length(head) + 2)"))
    heads = all_.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = all_.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    # one row a language
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(F.broadcast(langs), "lang")
    big = lambda c: F.col(c).cast("decimal(18,0)")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * big("a") * big("n"), big("l") * big("r"))
    scored = scored.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    scored = scored.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    longer = several.where(F.size(words) > 2)
    ends = F.expr("array(substring_index(phrase, ' ', size(split(phrase, ' ')) - 1), substring(phrase, length(substring_index(phrase, ' ', 1)) + 2))")
    inside = longer.select("lang", F.explode(ends).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = scored.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < within_percent * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    out = free.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
