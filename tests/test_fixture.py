"""The reference's 10-fact fixture through every stage (FIXTURES.md §2)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import P1, P2, P3, canon_map, fixture_facts, user_pairs
from lamina.functions.facts import flatten
from lamina.operators import identity as I
from lamina.operators import pageviews as PV
from lamina.operators.urls import normalize_urls
from lamina.sources import store as ST


@pytest.fixture(scope="module")
def facts(spark):
    return fixture_facts(spark).cache()


def test_shred_targets(facts):
    got = {(r.unit_id, r.property_id): r.facts for r in ST.validate_target(ST.shred(facts)).collect()}
    assert got == {(4, 0): 8, (3, 0): 2}


def test_normalize_urls_unchanged(facts):
    before = sorted(map(tuple, flatten(facts).collect()), key=str)
    after = sorted(map(tuple, flatten(normalize_urls(facts)).collect()), key=str)
    assert before == after and len(after) == 10


def test_equiv_rounds(facts):
    edges = I.equiv_pairs(facts)
    r1 = I.equiv_round(edges)
    assert user_pairs(r1) == [(1, 3), (1, 5), (3, 5)]
    assert user_pairs(I.progress_edges(r1)) == [(1, 3), (1, 5)]
    r2 = I.equiv_round(r1.select("a", "b"))
    assert user_pairs(r2) == [(1, 3), (1, 5)]
    assert user_pairs(I.progress_edges(r2)) == [(1, 3), (1, 5)]
    r3 = I.equiv_round(r2.select("a", "b"))
    assert user_pairs(r3) == [(1, 3), (1, 5)]
    assert I.progress_count(r3) == 0


def test_fixpoint_and_canonical(facts):
    final, rounds = I.equiv_fixpoint(I.equiv_pairs(facts))
    assert rounds == 3
    assert user_pairs(final) == [(1, 3), (1, 5)]
    for method in ("star", "relink"):
        assert canon_map(I.canonical_ids(I.equiv_pairs(facts), method=method)) == {3: 1, 5: 1}


def _unique(facts):
    canon = I.canonical_ids(I.equiv_pairs(facts))
    users = I.normalize_user_ids(normalize_urls(facts), canon)
    return users, PV.dedup_pageviews(users)


def test_normalize_user_ids_and_dedup(facts):
    users, unique = _unique(facts)
    ids = sorted(r[0] for r in users.select("dataunit.page_view.person.user_id").collect())
    assert ids == [1, 1, 1, 1, 1, 1, 2, 2]
    assert unique.count() == 8


def test_hourly_and_view(facts):
    _, unique = _unique(facts)
    hourly = {(r.url, r.bucket): r.pageviews for r in PV.hourly_rollup(unique).collect()}
    assert hourly == {(P1, 0): 3, (P1, 1): 1, (P2, 1): 1, (P2, 2): 1, (P3, 0): 1, (P3, 2): 1}
    view = PV.pageview_batch_view(unique)
    rows = {(r.url, r.granularity, r.bucket): r.pageviews for r in view.collect()}
    assert len(rows) == 15
    for g in "dwm":
        assert {u: rows[(u, g, 0)] for u in (P1, P2, P3)} == {P1: 4, P2: 2, P3: 2}
    assert {k[:2] + (k[2],): v for k, v in rows.items() if k[1] == "h"} == {
        (u, "h", b): c for (u, b), c in hourly.items()
    }


def test_sort_view_order(facts):
    _, unique = _unique(facts)
    grans = [r.granularity for r in PV.sort_view(PV.pageview_batch_view(unique)).collect()]
    assert grans == sorted(grans) and grans[0] == "d" and grans[-1] == "w"
    assert [g for i, g in enumerate(grans) if i == 0 or grans[i - 1] != g] == ["d", "h", "m", "w"]


def test_sort_facts_natural_order(facts):
    _, unique = _unique(facts)
    rows = PV.sort_facts(unique).select(
        F.col("pedigree.true_as_of_secs").alias("t"),
        F.col("dataunit.page_view.person.user_id").alias("u"),
        F.col("dataunit.page_view.page.url").alias("url"),
    ).collect()
    keys = [(r.t, r.u, r.url) for r in rows]
    assert keys == sorted(keys)
