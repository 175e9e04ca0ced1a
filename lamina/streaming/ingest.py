"""Incremental ingest of new facts into master.

The file-source stream over the new-data folder with ``trigger(availableNow=True)``
and a checkpoint *is* the snapshot: each run takes exactly the files not yet
committed, and facts arriving during or after the run wait for the next run (S7).
Each micro-batch is shredded and absorbed by ``foreachBatch`` into master with dynamic
partition overwrite, under the ingest id that the store's ledger has for this batch of this
stream: a batch replayed after a failure overwrites its own output instead of duplicating
it, and a stream whose checkpoint was lost starts with ids above all that master has.

When a run has ended, the files of all committed batches leave new data (S8): what lies
there then are exactly the files that arrived later. They are taken from the stream's own
log of files, from where the run before stopped, so a run that died before this is made up
for by the next, and a lost checkpoint finds no file again that master already has (but those
of a batch whose run died between its commit and this step).

Every batch is checked: facts with more or fewer than one union arm, missing
pedigree fields or an illegal target are rejected. Legal facts are written to master,
rejected ones with their reason to the ``rejected`` dataset of the store, under the
same batch id; the run goes on and reports their number.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lamina import schema as S
from lamina.functions.facts import arm_count
from lamina.sources import fs
from lamina.sources.store import FACT_COLUMNS, FactStore, legal_target, shred, well_formed


class InvalidFactsError(ValueError):
    """Raised at the end of a run that rejected facts, if that is asked for."""


@dataclass
class IngestReport:
    batches: list[int] = field(default_factory=list)  # their ingest ids
    rows: int = 0  # facts in the batches, rejected ones included
    rejected: int = 0
    consumed: int = 0  # files that left new data
    consolidated: dict | None = None


def ingest_snapshot(store: FactStore, consume: bool | str = True, max_bytes: int | None = None, max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame over the not-yet-ingested new facts (S7). ``consume``: what
    the source does with files it has committed (S8), ``"off"`` (or False),
    ``"delete"`` or ``"archive"`` (or True). Without ``max_bytes`` or ``max_files`` all
    that has arrived is one batch."""
    how = {True: "archive", False: "off"}.get(consume, consume)
    reader = store.spark.readStream.schema(S.FACT).option("cleanSource", how)
    if how == "archive":
        reader = reader.option("sourceArchiveDir", store.ingest_archive)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(int(max_bytes)))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.parquet(store.new_path)


def snapshot_new(store: FactStore, path: str, checkpoint: str | None = None, **limits) -> int:
    """Copy the not-yet-snapshotted new facts to ``path`` (S7 as a dataset).

    The file sink commits each batch to its ``_spark_metadata`` log, so readers of
    ``path`` see exactly the committed snapshot. Returns the number of batches."""
    checkpoint = checkpoint or f"{path}_checkpoint"
    before = _last(store, f"{checkpoint}/commits")
    query = (
        ingest_snapshot(store, consume=False, **limits)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    # batches are numbered without gaps; Spark keeps only the last of its reports and commits
    return _last(store, f"{checkpoint}/commits") - before


def _last(store: FactStore, log: str) -> int:
    """The largest number in one of a checkpoint's logs, -1 without any."""
    return max((int(n) for n in fs.names(store.spark, f"{log}/[0-9]*") if n.isdigit()), default=-1)


def stream_id(store: FactStore, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint from its first start on."""
    return json.loads(fs.lines(store.spark, f"{checkpoint}/metadata")[0])["id"]


def take_out(store: FactStore, how: str, threads: int = 8) -> int:
    """Take the files of all committed batches out of new data (S8): ``"delete"`` or
    ``"archive"`` them. Returns how many. Files that are gone already are passed over, so this
    can be run again after any failure."""
    spark, checkpoint = store.spark, store.ingest_checkpoint
    committed = _last(store, f"{checkpoint}/commits")
    if committed < 0:
        return 0
    stream, after = stream_id(store, checkpoint), store.consumed(stream_id(store, checkpoint))
    through = int(json.loads(fs.lines(spark, f"{checkpoint}/offsets/{committed}")[-1])["logOffset"])
    if through <= after:
        return 0
    entry = F.from_json("value", "path string, batchId long")
    log = spark.read.text(f"{checkpoint}/sources/0/*").where(F.col("value").startswith("{")).select(entry.alias("e"))
    files = log.where((F.col("e.batchId") > after) & (F.col("e.batchId") <= through)).select("e.path").distinct()
    into = store.ingest_archive if how == "archive" else None
    with ThreadPoolExecutor(threads) as pool:  # the names of this run's files
        done = sum(pool.map(lambda r: fs.remove_file(spark, r["path"], into), files.collect()))
    store.set_consumed(stream, through)
    return done


def reject_reason() -> Column:
    """Why a shredded fact cannot be routed; null for a legal one."""
    return (
        F.when(arm_count() != 1, "not one union arm")
        .when(~F.coalesce(well_formed(), F.lit(False)), "missing or unknown pedigree field")
        .when(~F.coalesce(legal_target(), F.lit(False)), "no legal target")
    )


def absorb_batch(store: FactStore, report: IngestReport):
    """``foreachBatch`` body: shred, check and absorb one micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        ingest_id = store.ingest_id(stream_id(store, store.ingest_checkpoint), batch_id)
        shredded = shred(batch).withColumn("reason", reject_reason())
        obs = Observation(f"ingest_{batch_id}_{uuid.uuid4().hex[:8]}")
        observed = shredded.observe(
            obs,
            F.count(F.lit(1)).alias("rows"),
            F.count("reason").alias("rejected"),
        )
        store.absorb(observed.where(F.col("reason").isNull()).drop("reason"), ingest_id)
        metrics = obs.get
        rejected = int(metrics.get("rejected") or 0)
        if rejected:
            store.reject(shredded.where(F.col("reason").isNotNull()).select(*FACT_COLUMNS, "reason"), ingest_id)
        report.batches.append(ingest_id)
        report.rows += int(metrics.get("rows") or 0)
        report.rejected += rejected

    return run


def ingest(
    store: FactStore,
    consume: bool | str = True,
    consolidate: bool = True,
    fail_on_rejects: bool = False,
    max_bytes: int | None = None,
    **consolidate_args,
) -> IngestReport:
    """Move all new facts into master, then compact it (S13). ``consume``: what happens to
    the files that master has (S8), ``"off"`` (or False), ``"delete"`` or ``"archive"`` (or
    True). With ``fail_on_rejects`` the run raises at its end if facts were rejected; legal ones
    are in master then."""
    store.create()
    report = IngestReport()
    how = {True: "archive", False: "off"}.get(consume, consume)
    query = (
        ingest_snapshot(store, consume="off", max_bytes=max_bytes)
        .writeStream.foreachBatch(absorb_batch(store, report))
        .option("checkpointLocation", store.ingest_checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if how != "off":
        report.consumed = take_out(store, how)
    if consolidate and report.batches:
        report.consolidated = store.consolidate(**consolidate_args)
    if fail_on_rejects and report.rejected:
        raise InvalidFactsError(f"{report.rejected} facts rejected, see {store.rejected}")
    return report
