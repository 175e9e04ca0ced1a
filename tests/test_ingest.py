"""Ingest, absorb, compaction and staging over temporary folders."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from helpers import equivs, fixture_facts, pageviews
from lamina import schema as S
from lamina.sources import fs
from lamina.sources import store as ST
from lamina.streaming import InvalidFactsError, ingest, snapshot_new


def data_files(path):
    return [f for _, _, names in os.walk(path.removeprefix("file:")) for f in names if f.startswith("part-")]


def test_ingest_twice_equals_once(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    store.append_new(fixture_facts(spark))
    first = ingest(store)
    assert first.rows == 10
    second = ingest(store)
    assert second.rows == 0 and second.batches == []
    master = store.read_master()
    assert master.count() == 10
    got = {(r.unit_id, r.property_id): r[2] for r in master.groupBy("unit_id", "property_id").count().collect()}
    assert got == {(4, 0): 8, (3, 0): 2}


def test_facts_between_runs_are_taken_once(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    store.append_new(pageviews(spark, [(1, "http://a.com/x", 1)]))
    ingest(store, consolidate=False)
    store.append_new(pageviews(spark, [(2, "http://a.com/x", 2), (3, "http://a.com/y", 3)]))
    report = ingest(store)
    assert report.rows == 2
    assert store.read_master().count() == 3
    assert ingest(store).rows == 0


def test_consolidate_keeps_rows_and_merges_files(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    facts = ST.shred(fixture_facts(spark).repartition(5))
    for i in range(3):
        store.absorb(facts, i)
    before = store.read_master().count()
    res = store.consolidate()
    assert res["rows"] == before == 30 and res["batches"] == 3
    assert res["files_after"] <= 2 < res["files_before"]
    assert store.compacted_through() == 2 and store.batch_ids() == [-4]
    assert store.read_master().count() == 30
    # the next one takes the first in: it is not much larger than the new batch
    store.absorb(facts, 3)
    res = store.consolidate()
    assert res["batches"] == 1 and store.batch_ids() == [-5]
    assert store.read_master().count() == 40
    # a compaction much larger than what is new stays as it is
    store.absorb(facts, 4)
    assert store.consolidate(growth=0.0)["rows"] == 10 and store.batch_ids() == [-6, -5]
    assert store.read_master().count() == 50
    assert store.consolidate()["batches"] == 0


def test_uncommitted_compaction_is_invisible(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    facts = ST.shred(fixture_facts(spark))
    store.absorb(facts, 0)
    # a compaction written but not committed (pointer not moved), as after a crash
    store._write(facts.withColumn("ingest_id", F.lit(-2).cast("bigint")))
    assert store.read_master().count() == 10
    res = store.consolidate()  # rewrites the same compaction id, then commits
    assert res["rows"] == 10 and store.read_master().count() == 10


def test_absorb_replay_overwrites_itself(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    shredded = ST.shred(fixture_facts(spark))
    store.absorb(shredded, 7)
    store.absorb(shredded, 7)
    assert store.read_master().count() == 10


def test_invalid_facts_are_rejected_and_the_run_goes_on(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    bad = equivs(spark, [(1, 2)]).withColumn("dataunit", F.col("dataunit").withField("equiv", F.lit(None).cast(S.EQUIV_EDGE)))
    old = equivs(spark, [(1, 3)]).withColumn("pedigree", F.col("pedigree").withField("true_as_of_secs", F.lit(None).cast("int")))
    store.append_new(bad)
    store.append_new(old)
    store.append_new(fixture_facts(spark))
    report = ingest(store)
    assert (report.rows, report.rejected) == (12, 2) and store.read_master().count() == 10
    reasons = sorted(r.reason for r in store.read_rejected().collect())
    assert reasons == ["missing or unknown pedigree field", "not one union arm"]
    assert ingest(store).rows == 0 and store.read_master().count() == 10
    store.append_new(bad)
    with pytest.raises(InvalidFactsError, match="1 facts rejected"):
        ingest(store, fail_on_rejects=True)
    assert store.read_rejected().count() == 3


def test_snapshot_freezes_new_facts(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    store.append_new(fixture_facts(spark))
    path = f"{tmp_root}/snap"
    snapshot_new(store, path)
    store.append_new(pageviews(spark, [(9, "http://a.com/x", 1)]))
    assert ST.scan_facts(spark, path).count() == 10
    snapshot_new(store, path)
    assert ST.scan_facts(spark, path).count() == 11


def test_stage_facts_and_reset(spark, tmp_root):
    path = f"{tmp_root}/stage"
    staged = ST.stage_facts(fixture_facts(spark), path)
    assert sorted(staged.select("unit_id").distinct().toPandas()["unit_id"]) == [3, 4]
    ST.reset_workspace(spark, path)
    assert fs.exists(spark, path) and data_files(path) == []


def test_scan_with_path(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    store.absorb(ST.shred(fixture_facts(spark)), 0)
    paths = {r[0] for r in ST.scan_with_path(spark, store.master_path()).select("rel_path").collect()}
    assert paths == {"3", "4"}


def test_consumed_files_are_archived(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    for i in range(3):
        store.append_new(pageviews(spark, [(i, "http://a.com/x", i)]))
    n_files = len(data_files(store.new_path))
    from lamina.streaming.ingest import ingest_snapshot

    # one file per micro-batch, so the source can archive all but the newest batch
    q = (
        ingest_snapshot(store, max_files=1)
        .writeStream.foreachBatch(lambda df, bid: store.absorb(ST.shred(df), bid))
        .option("checkpointLocation", store.ingest_checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    left = len(data_files(store.new_path))
    archived = len(data_files(store.ingest_archive))
    assert store.read_master().count() == 3
    assert archived >= 1 and left + archived == n_files
    assert ingest(store).rows == 0


def test_batch_replayed_after_crash_is_not_duplicated(spark, tmp_root):
    """A batch written to master whose commit never happened is replayed on the next
    run and overwrites its own partition: exactly once."""
    from lamina.streaming.ingest import IngestReport, absorb_batch, ingest_snapshot

    store = ST.FactStore(spark, tmp_root).create()
    store.append_new(fixture_facts(spark))
    absorb = absorb_batch(store, IngestReport())

    def crash_after_write(df, batch_id):
        absorb(df, batch_id)
        raise RuntimeError("driver lost after the write, before the commit")

    q = (
        ingest_snapshot(store)
        .writeStream.foreachBatch(crash_after_write)
        .option("checkpointLocation", store.ingest_checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    with pytest.raises(Exception):
        q.awaitTermination()
    assert store.read_master().count() == 10  # written, not committed
    report = ingest(store)  # the same batch id again
    assert report.batches == [0] and report.rows == 10
    assert store.read_master().count() == 10
    assert ingest(store).rows == 0


def test_orphan_compaction_does_not_resurface(spark, tmp_root):
    """A compaction written but not committed must stay invisible even after later
    batches move the pointer past its id."""
    store = ST.FactStore(spark, tmp_root).create()
    facts = ST.shred(fixture_facts(spark))
    store.absorb(facts, 0)
    store.absorb(facts, 1)
    # crash while compacting batches 0..1 into -(1 + 2): written, pointer not moved
    orphan = store.read_master().withColumn("ingest_id", F.lit(-3).cast("bigint"))
    store._write(orphan)
    store.absorb(facts, 2)
    assert store.read_master().count() == 30
    res = store.consolidate()  # batches 0..2 into -(2 + 2); the pointer moves to 2
    assert res["rows"] == 30
    assert store.read_master().count() == 30
    assert store.batch_ids() == [-4]


def test_pointer_is_replaced_in_one_step(spark, tmp_root):
    """A reader that polls while the pointer is replaced always finds a value."""
    path = f"{tmp_root}/pointer"
    fs.write_text(spark, path, "0")
    seen, stop = [], threading.Event()

    def poll():
        while not stop.is_set():
            seen.append(fs.read_text(spark, path))

    reader = threading.Thread(target=poll)
    reader.start()
    for i in range(1, 60):
        fs.write_text(spark, path, str(i))
    stop.set()
    reader.join()
    assert None not in seen and fs.read_text(spark, path) == "59"


def _stored(spark, root, batches=3):
    store = ST.FactStore(spark, root).create()
    facts = ST.shred(fixture_facts(spark))
    for i in range(batches):
        store.absorb(facts, i)
    return store


def test_a_held_reader_outlives_a_compaction(spark, tmp_root):
    store = _stored(spark, tmp_root)
    held = store.read_master()
    store.consolidate()
    assert held.count() == 30 and store.read_master().count() == 30
    store.absorb(ST.shred(fixture_facts(spark)), 3)
    after = store.read_master()
    store.consolidate()
    assert after.count() == 40 and store.read_master().count() == 40


@pytest.mark.parametrize("when", ["before listing", "after listing"])
def test_a_compaction_commits_while_master_is_read(spark, tmp_root, monkeypatch, when):
    """Either side of the listing: the reader gets all rows, from one state."""
    store = _stored(spark, tmp_root)
    other = ST.FactStore(spark, tmp_root)
    scan, done = ST.scan_facts, []

    def racing(*args, **kw):
        if done or len(args) < 3:
            return scan(*args, **kw)
        done.append(1)
        if when == "before listing":
            other.consolidate()
            return scan(*args, **kw)
        listed = scan(*args, **kw)
        other.consolidate()
        return listed

    monkeypatch.setattr(ST, "scan_facts", racing)
    assert store.read_master().count() == 30 and done


def test_many_small_ingests_leave_few_compactions(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    facts = ST.shred(fixture_facts(spark)).cache()
    for i in range(20):
        store.absorb(facts, i)
        store.consolidate()
    assert store.read_master().count() == 200
    assert len(store.batch_ids()) <= 5
    assert store._files(store.batch_ids()) <= 2 * 5  # two kinds


def test_batches_are_counted_from_the_commit_log(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    for i in range(5):
        store.append_new(pageviews(spark, [(i, "http://a.com/x", i)]).coalesce(1))
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        assert snapshot_new(store, f"{tmp_root}/snap", max_files=1) == 5
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_published_view_switches_atomically(spark, tmp_root):
    from lamina.operators import pageviews as PV

    root = f"{tmp_root}/view"
    v1 = spark.createDataFrame([("u", "h", 0, 1)], "url string, granularity string, bucket int, pageviews bigint")
    v2 = spark.createDataFrame([("u", "h", 0, 2)], "url string, granularity string, bucket int, pageviews bigint")
    PV.cache_view(v1, root)
    assert PV.read_view(spark, root).first().pageviews == 1
    PV.cache_view(v2, root)
    assert PV.read_view(spark, root).first().pageviews == 2
    PV.cache_view(v1, root)
    assert PV.read_view(spark, root).first().pageviews == 1
    assert len(fs.glob_dirs(spark, f"{root}/v-*")) == 2  # current and previous only


def _ids(df):
    return sorted(r[0] for r in df.select("dataunit.page_view.person.user_id").collect())


def test_facts_after_a_lost_checkpoint_are_visible(spark, tmp_root):
    """The new stream's batches begin at 0 again, below K: they get ids above it."""
    store = ST.FactStore(spark, tmp_root).create()
    for i in range(3):
        store.append_new(pageviews(spark, [(i, "http://a.com/x", i)]))
        assert ingest(store).rows == 1
    assert store.compacted_through() == 2
    fs.delete(spark, store.ingest_checkpoint)
    store.append_new(pageviews(spark, [(10 + i, "http://a.com/y", i) for i in range(10)]))
    report = ingest(store, consolidate=False)
    assert report.batches == [3] and report.rows == 10  # no file that master has is read again
    assert _ids(store.read_master()) == [0, 1, 2, *range(10, 20)]
    store.consolidate()
    assert _ids(store.read_master()) == [0, 1, 2, *range(10, 20)]
    store.append_new(pageviews(spark, [(30, "http://a.com/y", 1)]))
    assert ingest(store).batches == [4] and store.read_master().count() == 14


def test_replays_stay_idempotent_after_a_lost_checkpoint(spark, tmp_root):
    from lamina.streaming.ingest import IngestReport, absorb_batch, ingest_snapshot

    store = ST.FactStore(spark, tmp_root).create()
    store.append_new(pageviews(spark, [(1, "http://a.com/x", 1)]))
    ingest(store)
    fs.delete(spark, store.ingest_checkpoint)
    store.append_new(pageviews(spark, [(2, "http://a.com/x", 1), (3, "http://a.com/x", 1)]))
    absorb = absorb_batch(store, IngestReport())

    def crash(df, batch_id):
        absorb(df, batch_id)
        raise RuntimeError("driver lost before the commit")

    for _ in range(2):  # the batch dies twice and is run three times
        q = ingest_snapshot(store, consume="off").writeStream.foreachBatch(crash)
        with pytest.raises(Exception):
            q.option("checkpointLocation", store.ingest_checkpoint).trigger(availableNow=True).start().awaitTermination()
    assert ingest(store).batches == [1]
    assert _ids(store.read_master()) == [1, 2, 3]


def test_a_batch_without_legal_facts_keeps_its_id(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    bad = equivs(spark, [(1, 2)]).withColumn("dataunit", F.col("dataunit").withField("equiv", F.lit(None).cast(S.EQUIV_EDGE)))
    for _ in range(3):
        store.append_new(bad)
        assert ingest(store).rejected == 1
    assert store.read_rejected().count() == 3


def test_a_checkpoint_put_back_raises(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    assert [store.ingest_id("s", 0), store.ingest_id("s", 1), store.ingest_id("s", 1), store.ingest_id("t", 0)] == [0, 1, 1, 2]
    with pytest.raises(ST.StaleCheckpointError):
        store.ingest_id("s", 0)


@pytest.mark.parametrize("how", ["archive", "delete"])
def test_new_data_holds_what_arrived_later(spark, tmp_root, how, monkeypatch):
    """A file that arrives while a run goes on stays, all others leave at its end."""
    store = ST.FactStore(spark, tmp_root).create()
    store.append_new(fixture_facts(spark).repartition(3))
    taken = set(data_files(store.new_path))
    absorb = ST.FactStore.absorb

    def late(self, *args):
        absorb(self, *args)
        self.append_new(pageviews(spark, [(77, "http://a.com/late", 1)]).coalesce(1))

    monkeypatch.setattr(ST.FactStore, "absorb", late)
    report = ingest(store, consume=how)
    monkeypatch.undo()
    left = set(data_files(store.new_path))
    assert report.rows == 10 and report.consumed == len(taken)
    assert len(left) == 1 and not left & taken
    assert set(data_files(store.ingest_archive)) == (taken if how == "archive" else set())
    assert ingest(store, consume=how).rows == 1 and data_files(store.new_path) == []
    assert store.read_master().count() == 11


def test_a_run_that_died_before_it_took_files_out_is_made_up_for(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    for i in range(3):
        store.append_new(pageviews(spark, [(i, "http://a.com/x", i)]).coalesce(1))
        ingest(store, consume="off")
    assert len(data_files(store.new_path)) == 3
    report = ingest(store)
    assert (report.rows, report.consumed) == (0, 3) and data_files(store.new_path) == []
    assert ingest(store).consumed == 0


def test_files_leave_over_many_runs_of_a_compacting_log(spark, tmp_root):
    """The source folds its file log from time to time: no file is missed."""
    store = ST.FactStore(spark, tmp_root).create()
    before = spark.conf.get("spark.sql.streaming.fileSource.log.compactInterval", "10")
    spark.conf.set("spark.sql.streaming.fileSource.log.compactInterval", "2")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    try:
        for i in range(7):
            store.append_new(pageviews(spark, [(i, "http://a.com/x", i)]).coalesce(1))
            assert ingest(store, consolidate=False).consumed == 1 and data_files(store.new_path) == []
    finally:
        spark.conf.set("spark.sql.streaming.fileSource.log.compactInterval", before)
        spark.conf.unset("spark.sql.streaming.minBatchesToRetain")
    assert store.read_master().count() == 7


def test_snapshots_are_counted_when_commits_are_purged(spark, tmp_root):
    store = ST.FactStore(spark, tmp_root).create()
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    got = []
    try:
        for i in range(7):
            store.append_new(pageviews(spark, [(i, "http://a.com/x", i)]).coalesce(1))
            got.append(snapshot_new(store, f"{tmp_root}/snap"))
    finally:
        spark.conf.unset("spark.sql.streaming.minBatchesToRetain")
    assert got == [1] * 7 and ST.scan_facts(spark, f"{tmp_root}/snap").count() == 7
