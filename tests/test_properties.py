"""Seeded random graphs against union-find, and invariants of the view."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import canon_map, pageviews, user_edges
from lamina.operators import identity as I
from lamina.operators import pageviews as PV
from lamina.operators.urls import normalize_urls


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    out = {}
    for x in list(parent):
        r = find(x)
        if r != x:
            out[x] = r
    return out


def random_graph(seed):
    rng = random.Random(seed)
    n = rng.randint(2, 60)
    m = rng.randint(0, 80)
    pairs = [(rng.randint(0, n), rng.randint(0, n)) for _ in range(m)]
    if rng.random() < 0.3:  # a hub
        hub = rng.randint(0, n)
        pairs += [(hub, rng.randint(0, n)) for _ in range(20)]
    return pairs


@pytest.mark.parametrize("seed", range(6))
def test_canonical_ids_match_union_find(spark, seed):
    pairs = random_graph(seed)
    expected = union_find(pairs)
    edges = user_edges(spark, pairs) if pairs else None
    if edges is None:
        return
    for method in ("star", "relink"):
        assert canon_map(I.canonical_ids(edges, method=method)) == expected
    assert canon_map(I.canonical_ids(edges, method="star", encode=True)) == expected
    assert canon_map(I.canonical_ids(edges, method="relink", encode=True)) == expected


def test_canonical_ids_invariant_to_order_direction_duplicates(spark):
    pairs = random_graph(99)
    rng = random.Random(5)
    shuffled = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in pairs] + pairs[:10]
    rng.shuffle(shuffled)
    a = canon_map(I.canonical_ids(user_edges(spark, pairs)))
    b = canon_map(I.canonical_ids(user_edges(spark, shuffled)))
    assert a == b == union_find(pairs)


def test_star_edges_never_grow(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(1, i) for i in range(41, 60)]
    edges = user_edges(spark, pairs)
    stars, _ = I.star_fixpoint(edges)
    assert stars.count() <= len(pairs)


def test_rerun_of_canonical_map_is_noop(spark):
    pairs = random_graph(3)
    canon = I.canonical_ids(user_edges(spark, pairs))
    again = I.canonical_ids(canon.select(F.col("canonical_id").alias("a"), F.col("id").alias("b")))
    assert canon_map(again) == canon_map(canon)


def test_view_sums_equal_per_granularity_and_idempotence(spark):
    rng = random.Random(11)
    urls = ["http://a.com/x?q=1", "https://B.org/y#f", "http://c.net:8080/z"]
    rows = [(rng.randint(1, 5), rng.choice(urls), rng.randint(0, 90 * 24 * 3600)) for _ in range(300)]
    views = normalize_urls(pageviews(spark, rows))
    unique = PV.dedup_pageviews(views)
    sums = {r[0]: r[1] for r in PV.pageview_batch_view(unique).groupBy("granularity").agg(F.sum("pageviews")).collect()}
    n = unique.count()
    assert sums == {"h": n, "d": n, "w": n, "m": n}
    assert PV.dedup_pageviews(unique).count() == n
    twice = normalize_urls(views)
    assert twice.exceptAll(views).count() == 0


@pytest.mark.parametrize("seed", [1, 4])
@pytest.mark.parametrize("encode", [True, False])
def test_codes_or_structs_match_union_find(spark, encode, seed):
    pairs = random_graph(seed)
    for method in ("star", "relink"):
        assert canon_map(I.canonical_ids(user_edges(spark, pairs), method=method, encode=encode)) == union_find(pairs)
