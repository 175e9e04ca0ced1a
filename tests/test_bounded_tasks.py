"""What a task holds and what goes to the driver follows rows, not the sizes of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.operators import identity as I
from lamina.session import open_writers
from lamina.sources import store as ST
from lamina.sources.store import FactStore, shred
from tests.helpers import pageviews, user_edges

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _views(spark, n):
    return pageviews(spark, [(i % 7, f"http://a.com/{i % 5}", 1_700_000_000 + i) for i in range(n)])


def test_a_compaction_deals_rows_to_tasks_not_files(spark, tmp_root, monkeypatch):
    """Repeated strings make small files of many facts: they are sorted in several tasks."""
    store = FactStore(spark, tmp_root).create()
    store.absorb(shred(_views(spark, 1000)), 0)
    monkeypatch.setattr(ST, "TASK_FACTS", 200)
    report = store.consolidate()
    assert report["rows"] == store.read_master().count() == 1000
    files = store.read_master().groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(files) >= 4 and max(r["count"] for r in files) <= 500


def test_a_compaction_deals_text_to_tasks(spark, tmp_root, monkeypatch):
    store = FactStore(spark, tmp_root).create()
    store.absorb(shred(_views(spark, 1000)), 0)
    per_fact = sum(map(len, ("http://a.com/1", "SELF", "page_view")))
    assert store.read_master().agg(F.sum(ST.text_bytes())).first()[0] == 1000 * per_fact
    monkeypatch.setattr(ST, "TASK_TEXT_BYTES", 1000 * per_fact // 4)
    assert store.consolidate()["files_after"] >= 3


def test_partitioned_writes_keep_files_open_whatever_the_session_says(spark, tmp_root):
    """Without the setting each task would sort its rows by partition."""
    own = spark.conf.get(WRITERS)
    seen, store = [], FactStore(spark, tmp_root).create()
    try:
        spark.conf.set(WRITERS, "0")
        with open_writers(spark):
            seen.append(spark.conf.get(WRITERS))
        seen.append(spark.conf.get(WRITERS))
        for write in (lambda: store.absorb(shred(_views(spark, 50)), 0), lambda: ST.stage_facts(_views(spark, 50), f"{tmp_root}/staged")):
            before = ST.open_writers
            called = []
            try:
                ST.open_writers = lambda s: called.append(s) or before(s)
                write()
            finally:
                ST.open_writers = before
            seen.append(len(called))
    finally:
        spark.conf.set(WRITERS, own)
    assert seen == ["8", "0", 1, 1]


def test_large_sides_are_not_broadcast(spark, monkeypatch):
    """Sides of joins with more rows than ``BROADCAST_ROWS`` are shuffled, however small their files."""
    plain = spark.range(300).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    plan = lambda df: (df.collect(), df._jdf.queryExecution().executedPlan().toString())[1]
    monkeypatch.setattr(I, "BROADCAST_ROWS", 100)
    for star in (I._large_star, I._small_star):
        assert "Broadcast" not in plan(star(plain, "t", None, 300)[0])
        assert "Broadcast" in plan(star(plain, "t", None, 30)[0])
    edges = user_edges(spark, [(i, i + 1) for i in range(150)])
    codes = I.person_codes(edges, I.default_stage(spark))
    assert "Broadcast" not in plan(I.encode_edges(edges, codes))
    assert {(r.id.user_id, r.canonical_id.user_id) for r in I.canonical_ids(edges).collect()} == {(i, 0) for i in range(1, 151)}
