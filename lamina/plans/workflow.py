"""The batch workflow (W1): ingest → normalize URLs → normalize user ids → dedup →
batch view, as a chain of DataFrame functions.

With ``stage_root`` every step is written (vertical layout) and read back; without it
the steps fuse into one plan per action and Catalyst prunes partitions and columns
through them. A workflow that died is run again with the same ``stage_root``: steps that it had
written from the same state of master are read, not done again (see :class:`Stages`). The result
without ``view_path`` is a plan over master: it stays readable until the second compaction
after it, as every held reader of master does.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lamina import schema as S
from lamina.functions.facts import with_target
from lamina.operators import identity as I
from lamina.operators import pageviews as PV
from lamina.operators.urls import normalize_urls
from lamina.sources import fs
from lamina.sources.store import FactStore, scan_unit, stage_facts
from lamina.streaming.ingest import ingest


class Stages:
    """Written steps under a folder. ``key`` says what they are made from: a step is done
    again unless ``_DONE`` lists it under the same key, and is listed once it is whole. Without a
    key nothing is listed and every step is done."""

    def __init__(self, spark: SparkSession, root: str, key: str | None = None):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        held = json.loads((key and fs.read_text(spark, f"{self.root}/_DONE")) or "{}")
        self.done = held["steps"] if held.get("key") == key else []

    def __call__(self, name: str, build: Callable[[], DataFrame], facts: bool = True) -> DataFrame:
        path = f"{self.root}/{name}"
        if name not in self.done:
            df = build()
            if facts:
                stage_facts(df, path)
            else:
                df.write.mode("overwrite").parquet(path)
            if self.key:
                self.done = [*self.done, name]
                fs.write_text(self.spark, f"{self.root}/_DONE", json.dumps({"key": self.key, "steps": self.done}))
        return self.spark.read.schema(S.STAGED if facts else S.CANONICAL).parquet(path)


def unique_pageviews(
    facts: DataFrame,
    canon: DataFrame | None = None,
    stage_root: str | None = None,
    method: str = "star",
    key: str | None = None,
) -> DataFrame:
    """Normalized, deduplicated page-view facts from any fact dataset.

    Facts are tagged with ``unit_id``/``property_id`` from the raw union first, so
    every later "page views only" filter tests a column computed before the URL
    rewrite (on stored data: the partition column itself)."""
    facts = with_target(facts)
    canonical = lambda: I.canonical_ids(I.equiv_pairs(scan_unit(facts, S.UNIT_EQUIV)), method=method)
    if not stage_root:
        views = normalize_urls(scan_unit(facts, S.UNIT_PAGE_VIEW))
        return PV.dedup_pageviews(I.normalize_user_ids(views, canonical() if canon is None else canon))
    stage = Stages(facts.sparkSession, stage_root, key)
    views = scan_unit(stage("normalized_urls", lambda: normalize_urls(facts)), S.UNIT_PAGE_VIEW)
    canon = stage("canonical_ids", canonical, facts=False) if canon is None else canon
    users = stage("normalized_pageview_users", lambda: I.normalize_user_ids(views, canon))
    return stage("unique_pageviews", lambda: PV.dedup_pageviews(users))


def batch_workflow(
    spark: SparkSession,
    store: FactStore,
    stage_root: str | None = None,
    view_path: str | None = None,
    method: str = "star",
) -> DataFrame:
    """Ingest new facts, then build the sorted page-view batch view from all of
    master. Late facts are handled by recomputing from master each run
    (:func:`lamina.plans.live.live_workflow` takes in what is new)."""
    ingest(store)
    key = json.dumps([store.state(), store.batch_ids(), method])
    unique = unique_pageviews(store.read_master(), stage_root=stage_root, method=method, key=key)
    view = PV.pageview_batch_view(unique)
    if view_path:
        view = PV.cache_view(view, view_path)
    return PV.sort_view(view)
