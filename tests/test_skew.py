"""Hot keys: one person, URL, fact or node holding a third of all rows."""

from __future__ import annotations

import random
from contextlib import contextmanager

from pyspark.sql import functions as F

from helpers import canon_map, pageviews, user_edges
from lamina.operators import identity as I
from lamina.operators import pageviews as PV

N = 3000


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed_views(spark):
    rng = random.Random(7)
    rows = []
    for i in range(N):
        user = 1 if i % 3 == 0 else rng.randint(2, 400)
        url = "http://hot.com/x" if i % 3 == 1 else f"http://a.com/{rng.randint(1, 50)}"
        rows.append((user, url, 1_700_000_000 + rng.randint(0, 40 * 86400)))
    rows += [rows[0]] * (N // 2)  # a hot group of copies of one fact
    return pageviews(spark, rows), rows


def test_hot_person_join_with_skew_split(spark):
    views, rows = _skewed_views(spark)
    canon = I.canonical_ids(user_edges(spark, [(0, 1), (0, 2), (5, 6)]))
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    ):
        out = I.normalize_user_ids(views, canon).select("dataunit.page_view.person.user_id")
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    counts = {}
    for r in got:
        counts[r[0]] = counts.get(r[0], 0) + 1
    expect = {}
    for u, _, _ in rows:
        c = {1: 0, 2: 0, 6: 5}.get(u, u)
        expect[c] = expect.get(c, 0) + 1
    assert counts == expect
    assert "SortMergeJoin(skew=true)" in plan  # AQE split the hot person's partition


def test_hot_url_and_copies_view_sums(spark):
    views, rows = _skewed_views(spark)
    unique = PV.dedup_pageviews(views)
    n_unique = len(set(rows))
    assert unique.count() == n_unique
    view = PV.pageview_batch_view(unique)
    sums = {r[0]: r[1] for r in view.groupBy("granularity").agg(F.sum("pageviews")).collect()}
    assert sums == {g: n_unique for g in "hdwm"}
    hot = view.where((F.col("url") == "http://hot.com/x") & (F.col("granularity") == "m")).agg(F.sum("pageviews")).first()[0]
    assert hot == len({r for r in set(rows) if r[1] == "http://hot.com/x"})


def test_hub_is_split_in_every_join(spark):
    """With the per-node facts written first, AQE splits a hub in both star joins and in
    the relinking round."""
    rng = random.Random(3)
    edges = [(1, 10 + i) for i in range(20000)] + [(rng.randint(30000, 60000), rng.randint(30000, 60000)) for _ in range(4000)]
    # both directions of the hub: as the larger end and as the smaller one
    edges += [(90000, 100 + i) for i in range(20000)]
    df = user_edges(spark, edges)
    plain = spark.createDataFrame([(max(e), min(e)) for e in edges if e[0] != e[1]], "a bigint, b bigint").distinct()
    stage = I.parquet_stage(I.workspace(spark, "hub"))
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    ):
        joins = {
            "large": I._large_star(plain, "t_large", stage)[0],
            "small": I._small_star(plain, "t_small", stage)[0],
            "round": I.equiv_round(df, stage),
        }
        bi = I.bidirectional_edges(df)
        relinked = I.relink_to_smallest(bi, stage(I.node_stats(bi), "t_stats"))
        joins |= {"relink": relinked, "flagged": I.distinct_flagged_edges(relinked)}
        for name, out in joins.items():
            out.collect()
            assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString(), name


def test_hub_node_components(spark):
    pairs = [(1000, i) for i in range(1, 900)] + [(i, i + 1) for i in range(900, 960)] + [(959, 5)]
    expected = {i: 1 for i in list(range(2, 900)) + list(range(900, 961)) + [1000]}
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for method in ("star", "relink"):
            assert canon_map(I.canonical_ids(user_edges(spark, pairs), method=method)) == expected
