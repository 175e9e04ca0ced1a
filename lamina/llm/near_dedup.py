"""Near duplicates by MinHash signatures and a multi-index Hamming join.

A text's set holds its distinct 5-word shingles (all words as one if it has fewer; A-Z
lower case). Its signature has CHUNKS x PLACES places of b = 16 bits, a MinHash each.
Texts with equal sets are one node, so copies cost nothing further.

Join. The signature is split into CHUNKS chunks. If two signatures differ in at most
2 * CHUNKS - 1 places, some chunk differs in at most one (pigeonhole). Each chunk's
allowed errors are enumerated: a key for each place left out, made of all others. So
every pair within that distance shares a key. With 18 chunks of 6 places the distance
is 35 of 108. A pair at the similarity 0.75 differs in 27 places on average, and with
more than 35 still shares a key unless all 18 chunks have two errors or more: one pair
in a million at exactly 0.75, far fewer above.

Linking. No group is paired up as a whole.

1. In a key's group each node is compared with the group's least node only, which is
   linear. Pairs are held against set sizes and signatures first (a pair at 0.75 has a
   distance beyond MAX_DISTANCE once in some millions): those that pass are near, and
   near pairs are confirmed on full sets with exact integers, 100 * intersection >= 75 *
   union. The confirmed links have components; nodes of one component needn't be
   compared with one another, so a group of copies, however large, ends here.
2. Two nodes within CLUSTER_DISTANCE of a group's least node lie in one cluster (a
   component of all such pairs). In clusters with several components all pairs of nodes
   from different components are compared exactly, in blocks of BLOCK nodes: the nodes
   outside the cluster's largest component with each other and with those in it. Blocks
   of large sets have fewer nodes, for BLOCK_BYTES of sets. A
   block gives at most one link for each of its nodes.
3. In each group, the pairs of different components of which a node is farther from
   the least node are compared, also in blocks, and confirmed if near.

So every pair that shares a key is either in one component or compared, and no link is
lost to a cap.

Results for special cases: null, empty and wordless texts have an empty set, no links
and are their own component. Rows with equal texts share a component. Rows that share a
doc_id are told apart by their texts. A null doc_id never is a component's least; a
component without any doc_id has component_id null and is kept. An empty table gives no rows.
Very long texts count whole (a text's words and shingles are held at once, some 60 bytes a
word). Columns beside the two named have no influence; ``keep_one`` keeps them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import flat
from lamina.llm.components import components, sized
from lamina.session import ensure_checkpoint_dir, parquet_stage, workspace

SHINGLE = 5
CHUNKS, PLACES = 18, 6
K = CHUNKS * PLACES
MAX_DISTANCE = 50
CLUSTER_DISTANCE = 65
BLOCK = 512
#: Bytes of sets in a block of a cluster, on average.
BLOCK_BYTES = 1 << 24
#: 32 MB: the filter of the nodes whose sets are wanted, some 22 million of them.
MAX_FILTER_BITS = 1 << 28

_seed = np.random.default_rng(97)
_MULT = _seed.integers(1, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _seed.integers(0, 1 << 63, K, dtype=np.uint64)
_PLACE_KEY = _seed.integers(1, 1 << 63, (CHUNKS, PLACES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice."""
    n = len(offsets) - 1
    data = flat.LOWER[data]
    starts, ends, text = flat.words(data, offsets)
    words = flat.span_hash(data, starts, ends)
    count = np.bincount(text, minlength=n)
    first = np.cumsum(count) - count
    run = np.zeros(len(words), np.uint64)
    for d in range(SHINGLE):
        power = flat.powers(SHINGLE + 1)[d + 1]
        run[: max(len(words) - d, 0)] += flat.mix(words[d:] * power)
    run = flat.mix(run)
    for i in range(n):
        k, a = int(count[i]), int(first[i])
        if not k:
            yield run[:0]
        elif k < SHINGLE:
            own = words[a : a + k] * flat.powers(SHINGLE + 1)[1 : k + 1]
            yield flat.mix(np.array([flat.mix(own).sum() + np.uint64(k)], np.uint64))
        else:
            yield np.unique(run[a : a + k - SHINGLE + 1])


def signature(hashes: np.ndarray) -> np.ndarray:
    """The MinHash of each place, its 16 bits."""
    least = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048]
        np.minimum(least, (part[None, :] * _MULT[:, None] + _ADD[:, None]).min(1), out=least)
    return flat.mix(least).astype(np.uint16)


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """The K keys of each signature (rows x K), chunk by chunk, a place left out each."""
    parts = flat.mix((sig.astype(np.uint64).reshape(len(sig), CHUNKS, PLACES) + np.uint64(1)) * _PLACE_KEY[None])
    keys = parts.sum(2)[:, :, None] - parts
    return flat.mix(keys).reshape(len(sig), K).view(np.int64)


def _sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row a row of ``docs``: doc_id, n_shingles, h (of the set), sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.text_bytes(batch.column(1))
            for lo, hi, part, off in flat.slices(data, offsets):
                size, h, sig = [], [], []
                for s in shingle_sets(part, off):
                    size.append(len(s))
                    h.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sig.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), pa.array(h, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "h", "sig"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_shingles long, h binary, sig binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, K)


def _key_rows(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                keys = chunk_keys(_matrix(part.column(1)))
                node = np.repeat(part.column(0).to_numpy(), K)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], names=["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) within CLUSTER_DISTANCE; ``near``: their sizes and signatures
    allow a similarity of 0.75."""
    of = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = (_matrix(batch.column(3)) != _matrix(batch.column(4))).sum(1)
                near = (apart <= MAX_DISTANCE) & batch.column(2).to_numpy(zero_copy_only=False)
                out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near)], names=["a", "b", "near"])
                yield out.filter(pa.array(apart <= CLUSTER_DISTANCE))

    joined = pairs.join(of("a"), "a").join(of("b"), "b")
    alike = F.expr("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)").alias("alike")
    return joined.select("a", "b", alike, "sig_a", "sig_b").mapInArrow(run, "a long, b long, near boolean")


def _bits_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of keys in a Bloom filter (keys x 7)."""
    a, b = flat.mix(keys), flat.mix(keys + np.uint64(1)) | np.uint64(1)
    return ((a[:, None] + np.arange(7, dtype=np.uint64) * b[:, None]) % np.uint64(bits)).astype(np.int64)


def _filter_of(keys: DataFrame) -> np.ndarray | None:
    """The words of a Bloom filter of a column of hashes, or None if it would be larger
    than MAX_FILTER_BITS. Bits are combined by Spark; only the filter is collected."""
    n = keys.count()
    bits = max(64, -(-n * 12 // 64) * 64)
    if bits > MAX_FILTER_BITS:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bits_of(batch.column(0).to_numpy().view(np.uint64), bits).ravel()
            word, back = np.unique(at >> 6, return_inverse=True)
            value = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(value, back, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], names=["word", "value"])

    rows = keys.mapInArrow(run, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("value").to_numpy().view(np.uint64)
    return words


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, s): the full sets of the wanted nodes (node, doc_id, h), from their texts.

    A Bloom filter of the wanted ids lets the scan skip all other texts, so that only
    sets are shuffled; if it would be too large, the texts are joined instead."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("k"))
    words = _filter_of(wanted.select(F.xxhash64("doc_id").alias("k")))
    if words is None:
        ids = wanted.select(F.col("doc_id").alias("w")).distinct()
        own = own.join(ids, F.col("doc_id").eqNullSafe(F.col("w")), "left_semi")
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            if held is not None:
                at = _bits_of(batch.column(1).to_numpy().view(np.uint64), 64 * len(held))
                batch = batch.filter(pa.array(((held[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(1)))
            data, offsets = flat.text_bytes(batch.column(0))
            for _, _, part, off in flat.slices(data, offsets):
                found = [s.tobytes() for s in shingle_sets(part, off) if len(s)]
                h = [hashlib.blake2b(s, digest_size=16).digest() for s in found]
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.binary()), pa.array(found, pa.binary())], names=["h", "s"])

    sets = own.select("text", "k").mapInArrow(run, "h binary, s binary")
    return sets.join(wanted.select("node", "h"), "h").groupBy("node").agg(F.first("s").alias("s"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with 100 * intersection >= 75 * union, as (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select([0, 1]).rename_columns(["u", "v"]).filter(pa.array(good, pa.bool_()))

    of = lambda c: sets.select(F.col("node").alias(c), F.col("s").alias(f"s_{c}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b")
    return joined.select("a", "b", "s_a", "s_b").mapInArrow(run, "u long, v long")


def _dealt(rows: DataFrame, core: str, rest: str) -> DataFrame:
    """Deals rows into blocks and pairs of blocks (i <= j), of which j is one of the
    rest. ``core``, ``rest``: how many rows of either kind stand in a group; a row has
    ``in_core``. Adds own, i and j; a row occurs once for each pair of its block."""
    rows = rows.withColumn("c_blocks", F.ceil(F.col(core) / BLOCK).cast("int")).withColumn("r_blocks", F.ceil(F.col(rest) / BLOCK).cast("int"))
    h = F.xxhash64("node")
    own = F.when(F.col("in_core"), F.pmod(h, F.greatest("c_blocks", F.lit(1)))).otherwise(F.col("c_blocks") + F.pmod(h, F.greatest("r_blocks", F.lit(1))))
    rows = rows.withColumn("own", own.cast("int"))
    first = F.when(F.col("in_core"), F.col("c_blocks")).otherwise(F.lit(0))
    rows = rows.where("r_blocks > 0").withColumn("other", F.explode(F.sequence(first, F.col("c_blocks") + F.col("r_blocks") - 1)))
    return rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of either block of a pair; the same ones for a block with itself."""
    i, j, own = (table.column(c).to_numpy() for c in ("i", "j", "own"))
    left = np.flatnonzero(own == i[0])
    return left, left if i[0] == j[0] else np.flatnonzero(own == j[0])


def _cluster_rows(pairs: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """(cluster, node, root, in_core, core, rest) of the clusters with several
    components; core and rest are the numbers of nodes in and outside the largest, or
    more where their sets need more blocks than so many nodes."""
    placed = components(pairs.toDF("u", "v")).toDF("node", "cluster")
    placed = sized(placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).checkpoint())
    sizes = placed.join(nodes.select("node", F.col("n").alias("hashes")), "node")
    count = sizes.groupBy("cluster", "root").agg(F.count("*").alias("n"), F.sum("hashes").alias("hashes"))
    size = count.groupBy("cluster").agg(F.max(F.struct("n", "root", "hashes")).alias("top"), F.sum("n").alias("all"), F.sum("hashes").alias("hashes")).where("all > top.n")
    rows = lambda n, hashes: F.greatest(n, F.ceil(hashes * F.lit(8.0 * BLOCK / BLOCK_BYTES)).cast("long"))
    core, rest = rows(F.col("top.n"), F.col("top.hashes")), rows(F.col("all") - F.col("top.n"), F.col("hashes") - F.col("top.hashes"))
    size = size.select("cluster", F.col("top.root").alias("core_root"), core.alias("core"), rest.alias("rest"))
    # one row a cluster, as a table: its real size tells the planner whether to send it to the nodes,
    # which then aren't dealt by cluster; a large one is joined by a shuffle that AQE can split
    size = parquet_stage(workspace(pairs.sparkSession, "near"))(size, "clusters")
    return placed.join(size, "cluster").select("cluster", "node", "root", (F.col("root") == F.col("core_root")).alias("in_core"), "core", "rest")


def _cluster_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v): links between different components of a cluster."""
    rows = _dealt(rows, "core", "rest").select("cluster", "i", "j", "own", "node", "root").join(sets, "node")

    def compare(table: pa.Table) -> pa.Table:
        node, root = (table.column(c).to_numpy() for c in ("node", "root"))
        left, right = _sides(table)
        own = [np.frombuffer(v, np.uint64) for v in table.column("s").to_pylist()]
        size = np.array([len(x) for x in own])
        names, ids = np.unique(np.concatenate(own), return_inverse=True)
        ids = np.split(ids, np.cumsum(size)[:-1])
        held, begin = np.concatenate([ids[y] for y in right]), np.cumsum(size[right]) - size[right]
        group = {int(r): int(r) for r in root}

        def find(r: int) -> int:
            while group[r] != r:
                r = group[r]
            return r

        u, v, mark = [], [], np.zeros(len(names), np.int32)
        for x in left.tolist():
            mark[ids[x]] = 1
            both = np.add.reduceat(mark[held], begin)
            mark[ids[x]] = 0
            for y in right[100 * both >= 75 * (size[x] + size[right] - both)].tolist():
                a, b = find(int(root[x])), find(int(root[y]))
                if a != b:
                    group[max(a, b)] = min(a, b)
                    u.append(node[x])
                    v.append(node[y])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.groupBy("cluster", "i", "j").applyInArrow(compare, "u long, v long")


def _far_pairs(groups: DataFrame, pairs: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of a key's group, in different components and near, of which a
    node isn't near the group's least node; each once. ``groups``: (key, node, m)."""
    close = pairs.select(F.col("a").alias("m"), F.col("b").alias("node"), F.lit(True).alias("close"))
    rows = groups.join(close, ["m", "node"], "left").withColumn("in_core", F.coalesce("close", F.col("m") == F.col("node")))
    rows = rows.select("key", "node", "in_core")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    size = rows.groupBy("key").agg(count(F.col("in_core")).alias("core"), count(~F.col("in_core")).alias("rest")).where("rest > 0")
    rows = _dealt(rows.join(size, "key"), "core", "rest").select("key", "i", "j", "own", "node")
    rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(nodes.select("node", "n", "sig"), "node")

    def compare(table: pa.Table) -> pa.Table:
        node, root, n = (table.column(c).to_numpy() for c in ("node", "root", "n"))
        sig = _matrix(table.column("sig"))
        left, right = _sides(table)
        a, b = [], []
        for x in left.tolist():
            y = right[(root[right] != root[x]) & (4 * np.minimum(n[right], n[x]) >= 3 * np.maximum(n[right], n[x]))]
            y = y[node[y] > node[x]] if left is right else y
            y = y[(sig[y] != sig[x]).sum(1) <= MAX_DISTANCE]
            a.append(np.minimum(node[x], node[y]))
            b.append(np.maximum(node[x], node[y]))
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})

    return rows.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _placed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and the distinct sets: node, doc_id (the set's least),
    h, root (of the component)."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = _sketches(docs, id_col, text_col).checkpoint()
    found = rows.where("h is not null").groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    # written once: a node's number must not change when a task runs again
    nodes = found.withColumn("node", F.monotonically_increasing_id()).checkpoint()
    keys = _key_rows(nodes)
    shared = keys.groupBy("key").agg(F.min("node").alias("m"), F.max("node").alias("last")).where("m < last").select("key", "m")
    groups = keys.join(shared, "key").checkpoint()
    stars = groups.where("node <> m").select(F.col("m").alias("a"), F.col("node").alias("b")).distinct()
    pairs = sized(_near(stars, nodes).checkpoint())
    near = pairs.where("near").select("a", "b")
    ends = lambda p: p.select(F.col("a").alias("node")).union(p.select("b"))
    wanted = lambda n: _sets(docs, nodes.select("node", "doc_id", "h").join(n.distinct(), "node").checkpoint(), id_col, text_col)
    sets = wanted(ends(near)).checkpoint()
    links = sized(_confirmed(near, sets).checkpoint())
    roots = components(links)
    clusters = sized(_cluster_rows(pairs.select("a", "b"), roots, nodes).checkpoint())
    far = sized(_far_pairs(groups, pairs, roots, nodes).checkpoint())
    more = clusters.select("node").union(ends(far)).join(sets.select("node"), "node", "left_anti")
    sets = sets.union(wanted(more).checkpoint())
    roots = components(links.union(_cluster_links(clusters, sets)).union(_confirmed(far, sets)))
    placed = nodes.select("node", "doc_id", "h").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rows, placed


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, n_shingles, h (128-bit hash of its set, null
    for an empty one), component_id, kept (doc_id = component_id)."""
    rows, placed = _placed(docs, id_col, text_col)
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_set = placed.join(least, "root").select("h", "component_id")
    own = rows.select("doc_id", "n_shingles", "h")
    linked = own.where("h is not null").join(by_set, "h", "left")
    empty = own.where("h is null").withColumn("component_id", F.col("doc_id"))
    out = linked.select("doc_id", "n_shingles", "h", "component_id").union(empty)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: of each component one
    row, and every row with an empty set. It is a row with the component's least id (null
    if there is none), of these with the least set hash."""
    at, columns = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.text_bytes(batch.column(at))
            for lo, hi, part, off in flat.slices(data, offsets):
                h = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in shingle_sets(part, off)]
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(h, pa.binary())], names=[*names, "set_hash"])

    names = [f"c{i}" for i in range(len(columns))]
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
    tagged = docs.toDF(*names).mapInArrow(run, f"{kinds}, set_hash binary")
    sketches, placed = _placed(docs, id_col, text_col)
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("first"))
    first = first.select(F.col("first.doc_id").alias("stay_id"), F.col("first.h").alias("stay_h"))
    copies = sketches.where("h is not null").groupBy("doc_id", "h").agg(F.count("*").alias("copies"))
    stay = first.join(copies, F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("h") == F.col("stay_h"))).select("stay_id", "stay_h", "copies").checkpoint()
    key = f"c{columns.index(id_col)}"
    found = F.col(key).eqNullSafe(F.col("stay_id")) & (F.col("set_hash") == F.col("stay_h"))
    some = tagged.join(stay, found, "left").where("stay_h is not null or set_hash is null")
    if not stay.where("copies > 1").isEmpty():  # rows with equal ids and sets: one of them
        some = some.where("set_hash is not null").dropDuplicates([key, "set_hash"]).union(some.where("set_hash is null"))
    return some.select(*names).toDF(*columns)
