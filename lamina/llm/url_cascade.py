"""URL filters by a cascade of Bloom filters: exact membership without a join.

A list of keys L is a part of the corpus's complete key universe U. Level 0 of a
cascade is a Bloom filter of L; level 1 holds the keys of U without L that pass level
0 in error; level 2 the keys of L that pass level 1 in error; and so on until no key
passes in error. A key of U is looked up level by level: the first level that it does
not pass tells the answer, and passing all levels tells it too. For all keys of U the
answer is exact; keys outside of U, which no lookup of this corpus has, may err.

The keys of a url are its host and every parent domain, each with the beginnings of
its path that are as long as some rule's path (0 for listed hosts). The longest rule
among those that an allow or a block cascade holds decides; without one, a url is
blocked if the cascade of listed hosts has its host or a parent domain.

Levels are built by Spark: bits are set in tasks, combined by word before and after
the shuffle, and only the filter itself comes to the driver, some 12 bits a key of its
level. ``MAX_BITS`` bounds a filter. Where the keys need more, they are dealt by their hash into
shards with cascades of their own, and the urls go through the shards one after the other, each
pass looking up the keys of its shard: as many passes over the urls, no join, and never more
than one shard's cascades in memory. (``judge_by_join`` gives the same answers by joins.)

Results for special cases: a null url, or one without ``://``, has an empty host and
path, no keys and the verdict allow. Empty tables and empty lists are allowed. Repeated
rows are judged each for itself. Further columns have no influence.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.session import ensure_checkpoint_dir

HASHES, BITS_PER_KEY = 7, 12
MAX_BITS = 1 << 28
MAX_LEVELS = 64

#: Fixed values: (verdict, rule); a rule is a host and the beginning of a path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

#: Hosts with one of these words between dots and hyphens are listed by ``listed_hosts``.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")


def host(url: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), upper, lower), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_hosts(pages: DataFrame, words: Sequence[str] = LISTED_WORDS, url_col: str = "url") -> DataFrame:
    """A block list (key): the hosts of ``pages`` with a listed word."""
    pattern = r"(^|[.-])(" + "|".join(words) + r")([.-]|$)"
    return pages.select(host(F.col(url_col)).alias("key")).where(F.col("key").rlike(pattern)).distinct()


def keys_of(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """The keys of a url, the longest first among those with equal hosts."""
    if not host:
        return []
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    return [h + path[:n] for h in hosts if h for n in lengths if n <= len(path)]


def key_hashes(keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each key."""
    data, offsets = flat.text_bytes(pa.array(keys, pa.string()))
    return tuple(flat.span_hash(d, offsets[:-1], offsets[1:]) for d in (data, data ^ np.uint8(0x5A)))


@dataclass
class Bloom:
    level: int
    bits: int
    words: np.ndarray

    @staticmethod
    def places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
        """Bit numbers (keys x HASHES); every level deals its keys anew."""
        salt = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
        a, b = flat.mix(h1 + salt), flat.mix(h2 + salt) | np.uint64(1)
        return ((a[:, None] + np.arange(HASHES, dtype=np.uint64)[None] * b[:, None]) % np.uint64(bits)).astype(np.int64)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.places(h1, h2, self.level, self.bits)
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(1)


@dataclass
class Cascade:
    levels: list[Bloom]

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key of the universe is in the list."""
        answer = np.full(len(h1), len(self.levels) % 2 == 1)
        todo = np.arange(len(h1))
        for f in self.levels:
            passed = f.has(h1[todo], h2[todo])
            answer[todo[~passed]] = f.level % 2 == 1
            todo = todo[passed]
        return answer


def build(universe: DataFrame, listed: str) -> Cascade:
    """A cascade for the keys with ``listed`` (a boolean column) of the universe
    (h1, h2, key flags)."""
    spark = universe.sparkSession
    levels: list[Bloom] = []
    source = universe.select("h1", "h2", F.col(listed).alias("listed"))
    for level in range(MAX_LEVELS):
        shared = spark.sparkContext.broadcast(levels[:])

        def alive(batches: Iterator[pa.RecordBatch], level: int = level, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h1, h2 = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
                on = batch.column(2).to_numpy(zero_copy_only=False) == (level % 2 == 0)
                for f in shared.value:
                    if f.level % 2 != level % 2:
                        on[on] = f.has(h1[on], h2[on])
                yield batch.select([0, 1]).filter(pa.array(on))

        members = source.mapInArrow(alive, "h1 long, h2 long")
        n = members.count()
        if not n:
            return Cascade(levels)
        bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)
        if bits > MAX_BITS:
            raise ValueError(f"a filter of {bits} bits is too large to broadcast; judge shards the keys, judge_by_join needs no filter")

        def set_bits(batches: Iterator[pa.RecordBatch], level: int = level, bits: int = bits) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = Bloom.places(*(batch.column(i).to_numpy().view(np.uint64) for i in (0, 1)), level, bits).ravel()
                word, back = np.unique(at >> 6, return_inverse=True)
                value = np.zeros(len(word), np.uint64)
                np.bitwise_or.at(value, back, np.uint64(1) << (at & 63).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], names=["word", "value"])

        # the filter itself: at most bits / 64 rows
        rows = members.mapInArrow(set_bits, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
        words = np.zeros(bits // 64, np.uint64)
        words[rows.column("word").to_numpy()] = rows.column("value").to_numpy().view(np.uint64)
        levels.append(Bloom(level, bits, words))
    raise RuntimeError(f"keys still pass in error after {MAX_LEVELS} levels")


def _parts(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    return pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))


def _lengths(rules: Sequence[tuple[str, str]]) -> list[int]:
    return sorted({0, *(len(r[r.index("/") :]) for _, r in rules)}, reverse=True)


def universe_of(parts: DataFrame, rules: Sequence[tuple[str, str]], listed: DataFrame) -> DataFrame:
    """All keys of the urls and lists, each once: (h1, h2, allow, block, listed)."""
    lengths = _lengths(rules)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for h, p in set(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                found.update(keys_of(h, p, lengths))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["key"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = key_hashes(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), *batch.columns[1:]], names=["h1", "h2", "allow", "block", "listed"])

    own = parts.select("host", "path").mapInArrow(keys, "key string")
    flag = lambda verdict: F.col("key").isin([r for v, r in rules if v == verdict])
    every = own.select("key", flag("allow").alias("allow"), flag("block").alias("block"), F.lit(False).alias("listed"))
    every = every.union(listed.where("key <> ''").select("key", F.lit(False), F.lit(False), F.lit(True)))
    once = every.groupBy("key").agg(*(F.bool_or(c).alias(c) for c in ("allow", "block", "listed")))
    return once.mapInArrow(hashed, "h1 long, h2 long, allow boolean, block boolean, listed boolean")


def _shards(universe: DataFrame) -> int:
    """How many shards the keys need: a first filter holds a list, a second one some hundredth
    of all keys; half of ``MAX_BITS`` is left free for shards that get more than their share."""
    names = ("allow", "block", "listed")
    n = universe.agg(F.count("*").alias("all"), *(F.count_if(F.col(c)).alias(c) for c in names)).first()
    most = max(n["all"] / 100, *(n[c] for c in names))
    return max(1, -(-int(2 * most * BITS_PER_KEY) // MAX_BITS))


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row a row of ``pages``: page_id, host, path, rule, verdict, listed."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    parts = _parts(pages, id_col, url_col)
    universe = universe_of(parts, rules, listed).checkpoint()
    shards, lengths = _shards(universe), _lengths(rules)
    kind = parts.schema["page_id"].dataType.simpleString()
    names = ["page_id", "host", "path", "rule", "allowed", "listed"]
    found = parts.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(False).alias("allowed"), F.lit(False).alias("listed"))
    for shard in range(shards):
        own = universe if shards == 1 else universe.where(F.pmod("h1", F.lit(shards)) == shard)
        cascades = spark.sparkContext.broadcast([build(own, c) for c in ("allow", "block", "listed")])

        def run(batches: Iterator[pa.RecordBatch], shard: int = shard, cascades=cascades) -> Iterator[pa.RecordBatch]:
            allow, block, on_list = cascades.value
            for batch in batches:
                urls = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
                keys = [keys_of(h, p, lengths) for h, p in urls]
                h1, h2 = key_hashes([k for own in keys for k in own])
                here = h1.view(np.int64) % shards == shard  # keys of other shards are in none of these lists
                is_allow, is_block, is_listed = (_has(c, h1, h2, here) for c in (allow, block, on_list))
                rule, allowed, hit, at = [], [], [], 0
                for own, best, good, seen in zip(keys, *(batch.column(k).to_pylist() for k in (3, 4, 5)), strict=True):
                    for i, key in enumerate(own, at):
                        if (is_allow[i] or is_block[i]) and (best is None or len(key) > len(best)):
                            best, good = key, is_allow[i]
                    hit.append(seen or any(is_listed[at : at + len(own)]))
                    rule.append(best)
                    allowed.append(good)
                    at += len(own)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rule, pa.string()), pa.array(allowed, pa.bool_()), pa.array(hit, pa.bool_())], names=names)

        found = found.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, allowed boolean, listed boolean")
        if shard + 1 < shards:  # the next pass has other cascades
            found = found.checkpoint()
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    by_rule = F.when(F.col("allowed"), F.lit("allow")).otherwise(F.lit("block"))
    return found.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNull(), by_list).otherwise(by_rule).alias("verdict"), "listed")


def _has(cascade: Cascade, h1: np.ndarray, h2: np.ndarray, here: np.ndarray) -> list[bool]:
    out = np.zeros(len(h1), bool)
    out[here] = cascade.has(h1[here], h2[here])
    return out.tolist()


def judge_by_join(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The same rows as ``judge`` by joins, for lists too long to broadcast."""
    parts = _parts(pages, id_col, url_col)
    labels = F.split("host", r"\.")
    parents = F.filter(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")), lambda h: h != "")
    hosts = parts.select("host").distinct()
    hit = hosts.select("host", F.explode(parents).alias("key")).join(listed, "key", "left_semi").select("host", F.lit(True).alias("listed")).distinct()
    best = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        cut = r.index("/")
        own = F.col("host").isin(r[:cut]) | F.col("host").endswith("." + r[:cut])
        fits = own & F.col("path").startswith(r[cut:])
        best, verdict = F.when(fits, F.lit(r)).otherwise(best), F.when(fits, F.lit(v)).otherwise(verdict)
    out = parts.join(hit, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", best.alias("rule"), F.coalesce(verdict, by_list).alias("verdict"), "listed")
