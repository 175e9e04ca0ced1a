"""Increments against the full computation: canonical ids, unique page views, batch view."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import canon_map, equivs, pageviews, user_edges
from lamina.functions.facts import flatten
from lamina.operators import identity as I
from lamina.operators import incremental as INC
from lamina.operators import pageviews as PV
from lamina.plans.live import LiveView, live_workflow
from lamina.plans.workflow import unique_pageviews
from lamina.sources import store as ST
from lamina.streaming import ingest

DAY = 86400


def rows(df):
    return sorted(map(str, df.collect()))


def components(pairs):
    """id: smallest id of its component, for the others of it."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root if find(x) != x}


@pytest.mark.parametrize("seed", [1, 2])
def test_extended_map_is_that_of_all_edges(spark, seed):
    rng = random.Random(seed)
    stage = I.parquet_stage(I.workspace(spark, f"extend-{seed}"))
    canon, seen = spark.createDataFrame([], I.S.CANONICAL), []
    for k in range(5):
        new = [(rng.randrange(60), rng.randrange(60)) for _ in range(rng.choice([0, 1, 8, 15]))] + [(k, k)]
        out = INC.extend_canonical_ids(canon, user_edges(spark, new))
        before, seen = canon_map(canon), seen + new
        contracted = INC.contract_edges(user_edges(spark, new), canon, stage, f"c{k}")
        assert contracted.count() <= len({tuple(sorted(e)) for e in new if e[0] != e[1]}) * 2
        canon = stage(out.canon, f"canon{k}")
        after = canon_map(canon)
        assert after == components(seen)
        moved = {r.id.user_id: (r.before.user_id, r.canonical_id.user_id) for r in out.moved.collect()}
        assert moved == {x: (before.get(x, x), c) for x, c in after.items() if before.get(x, x) != c}


def test_an_edge_inside_a_component_costs_nothing(spark):
    stage = I.parquet_stage(I.workspace(spark, "inside"))
    canon = I.canonical_ids(user_edges(spark, [(i, i + 1) for i in range(1, 50)]))
    assert INC.contract_edges(user_edges(spark, [(3, 40), (2, 2), (17, 5)]), canon, stage).isEmpty()
    out = INC.extend_canonical_ids(canon, user_edges(spark, [(3, 40)]))
    assert out.merged.isEmpty() and out.moved.isEmpty() and canon_map(out.canon) == canon_map(canon)


def test_the_map_is_not_shuffled_for_few_edges(spark):
    """Few persons are sent to the map, which is read where it lies."""
    stage = I.parquet_stage(I.workspace(spark, "few"))
    canon = stage(I.canonical_ids(user_edges(spark, [(i, i + 1000) for i in range(500)])), "canon")
    asked = stage(user_edges(spark, [(1, 2)]).select(F.col("a").alias("p")), "asked")
    found = asked.join(canon, F.col("p") == F.col("id"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def random_facts(spark, rng):
    """Page views over a few weeks and sides of the epoch, spellings of URLs, redeliveries, and edges."""
    views = []
    for _ in range(rng.randrange(25)):
        url = rng.choice(["http://a.com/x", "http://a.com:80/x?q", "HTTP://b.com/y#f", "nonsense"])
        views.append((rng.randrange(12), url, rng.choice([-2, -1, 0, 1, 5, 40]) * DAY + rng.randrange(3) * 1800))
    links = [(rng.randrange(12), rng.randrange(12)) for _ in range(rng.randrange(3))]
    views += views[:3]
    parts = ([pageviews(spark, views)] if views else []) + ([equivs(spark, links)] if links else [])
    return parts


def check(live, store):
    facts = store.read_master()
    canon = I.canonical_ids(I.equiv_pairs(ST.scan_unit(facts, ST.S.UNIT_EQUIV)))
    unique = unique_pageviews(facts, canon)
    assert canon_map(live.canon()) == canon_map(canon)
    assert rows(flatten(live.unique_views())) == rows(flatten(unique))
    assert rows(live.view()) == rows(PV.pageview_batch_view(unique).select("url", "granularity", "bucket", "pageviews"))


def test_ten_random_arrivals_equal_a_rebuild(spark, tmp_root):
    rng = random.Random(9)
    store, live = ST.FactStore(spark, f"{tmp_root}/store").create(), LiveView(spark, f"{tmp_root}/live")
    for k in range(10):
        for part in random_facts(spark, rng):
            store.append_new(part)
        live_workflow(spark, store, live)
        if k in (4, 9):
            check(live, store)


def test_only_what_is_touched_is_read_and_written(spark, tmp_root, monkeypatch):
    store, live = ST.FactStore(spark, f"{tmp_root}/store").create(), LiveView(spark, f"{tmp_root}/live")
    store.append_new(pageviews(spark, [(u, "http://a.com/x", d * DAY) for d in range(100) for u in (1, 2)]))
    ingest(store, consolidate=False)
    live.catch_up(store)
    read, parts = [], LiveView._parts

    def watched(self, kind, which):
        read.append((kind, set(which)))
        return parts(self, kind, which)

    monkeypatch.setattr(LiveView, "_parts", watched)
    store.append_new(pageviews(spark, [(1, "http://a.com/x", 7 * DAY), (3, "http://a.com/x", 7 * DAY + 5)]))
    ingest(store, consolidate=False)
    got = live.catch_up(store)
    assert got == {"days": [7], "months": [0], "canon": False}
    assert set().union(*(w for k, w in read if k == "views")) == {"7"}
    assert set().union(*(w for k, w in read if k == "view")) == {"0"}
    assert live.state()["views"] == {str(d): int(d == 7) for d in range(100)}
    assert live.state()["view"] == {str(m): int(m == 0) for m in range(4)}
    monkeypatch.undo()
    # two persons turn out to be one: their days change, the others don't
    store.append_new(equivs(spark, [(3, 1)]))
    ingest(store, consolidate=False)
    assert live.catch_up(store) == {"days": [7], "months": [], "canon": True}
    check(live, store)
    store.append_new(equivs(spark, [(2, 1)]))
    ingest(store, consolidate=False)
    assert live.catch_up(store) == {"days": list(range(100)), "months": [0, 1, 2, 3], "canon": True}
    check(live, store)


def test_a_run_that_died_is_run_again(spark, tmp_root, monkeypatch):
    store, live = ST.FactStore(spark, f"{tmp_root}/store").create(), LiveView(spark, f"{tmp_root}/live")
    store.append_new(pageviews(spark, [(1, "http://a.com/x", 5), (2, "http://a.com/x", 5)]))
    live_workflow(spark, store, live)
    before = rows(live.view())
    store.append_new(equivs(spark, [(1, 2)]))
    store.append_new(pageviews(spark, [(3, "http://a.com/y", 5)]))
    write = LiveView._write

    def dies(self, df, kind, *rest):
        write(self, df, kind, *rest)
        if kind == "view":
            raise RuntimeError("driver lost before the state was replaced")

    monkeypatch.setattr(LiveView, "_write", dies)
    with pytest.raises(RuntimeError, match="driver lost"):
        live_workflow(spark, store, live)
    monkeypatch.undo()
    assert rows(live.view()) == before
    live_workflow(spark, store, live)
    check(live, store)
    live_workflow(spark, store, live)  # nothing new
    check(live, store)


def test_master_compacted_past_the_view_is_a_rebuild(spark, tmp_root):
    store, live = ST.FactStore(spark, f"{tmp_root}/store").create(), LiveView(spark, f"{tmp_root}/live")
    store.append_new(pageviews(spark, [(1, "http://a.com/x", 5), (2, "http://a.com/x", 5)]))
    live_workflow(spark, store, live)
    held = live.view()
    store.append_new(pageviews(spark, [(1, "http://a.com/x", 99 * DAY)]))
    store.append_new(equivs(spark, [(1, 2)]))
    ingest(store)  # compacts
    live.catch_up(store)
    check(live, store)
    assert held.count() == 4  # readers of the state before still find it


def test_a_workflow_that_died_goes_on_with_its_written_steps(spark, tmp_root, monkeypatch):
    from lamina.plans import workflow as W

    store = ST.FactStore(spark, f"{tmp_root}/store").create()
    store.append_new(pageviews(spark, [(1, "http://a.com:80/x", 5), (2, "http://a.com/x", 5), (3, "http://a.com/y", 7)]))
    store.append_new(equivs(spark, [(1, 2)]))
    want = rows(PV.sort_view(PV.pageview_batch_view(unique_pageviews(store.read_new()))))
    run = lambda: rows(W.batch_workflow(spark, store, stage_root=f"{tmp_root}/stages"))

    def dies(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(W.I, "normalize_user_ids", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            run()
    with monkeypatch.context() as m:  # the first two steps are read
        m.setattr(W, "normalize_urls", dies)
        m.setattr(W.I, "canonical_ids", dies)
        assert run() == want
    store.append_new(pageviews(spark, [(4, "http://a.com/z", 9)]))  # another state of master
    assert len(run()) == len(want) + 4
