"""The batch layer kept up to date: canonical ids, unique page views and the batch view
as tables that new facts change where they must (I3, A6, A10, O3).

Layout under one root (a folder in the cluster's shared storage)::

    canon/run=4/                    the canonical map
    views/day=18262/run=4/          unique page views of a day
    view/month=648/run=4/           the batch view of a month bucket
    _STATE                          the run, master's ingest id it has come to, the tables that are live

A run reads the new facts, the days that they fall on, and days with views of persons whose
canonical id changed; it writes these days, the months of the view that changed, and (if
components merged) the map. All of it becomes live at once, when ``_STATE`` is replaced.
A run that died leaves tables that nothing names; the next overwrites them. What a run
replaced stays on disk until the next one, for readers that hold the state of before.

Days and months are as many as the time that the facts span has, so the state is small:
the largest has one number a day.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import schema as S
from lamina.functions.facts import page_view_arm, with_target
from lamina.operators import identity as I
from lamina.operators import incremental as INC
from lamina.operators import pageviews as PV
from lamina.operators.urls import normalize_urls
from lamina.session import parquet_stage, workspace
from lamina.sources import fs
from lamina.sources.store import FactStore, scan_unit
from lamina.streaming.ingest import ingest

_DAY = T.StructField("day", T.IntegerType())
VIEWS = T.StructType([S.FACT["pedigree"], T.StructField("pv", S.PAGE_VIEW_EDGE), _DAY, T.StructField("run", T.LongType())])
VIEW = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("granularity", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("pageviews", T.LongType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("run", T.LongType()),
    ]
)
_EMPTY = {"run": -1, "through": -1, "canon": None, "views": {}, "view": {}}


class LiveView:
    """Canonical ids, unique page views and batch view under one root. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.pointer = f"{self.root}/_STATE"

    # reads
    def state(self) -> dict:
        text = fs.read_text(self.spark, self.pointer)
        return json.loads(text) if text else dict(_EMPTY)

    def _parts(self, kind: str, live: dict) -> DataFrame:
        """The live partitions of ``views`` or ``view``, by their folders: no other one is
        listed."""
        schema, by = (VIEWS, "day") if kind == "views" else (VIEW, "month")
        if not live:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{kind}/{by}={k}/run={run}" for k, run in live.items()]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*paths)

    def canon(self, state: dict | None = None) -> DataFrame:
        """The canonical map (id, canonical_id)."""
        state = self.state() if state is None else state
        if state["canon"] is None:
            return self.spark.createDataFrame([], S.CANONICAL)
        return self.spark.read.schema(S.CANONICAL).parquet(f"{self.root}/canon/run={state['canon']}")

    def unique_views(self) -> DataFrame:
        """Unique page-view facts, URLs and persons normalized."""
        return self._parts("views", self.state()["views"]).select("pedigree", page_view_arm(F.col("pv")).alias("dataunit"))

    def view(self) -> DataFrame:
        """The batch view (url, granularity, bucket, pageviews)."""
        return self._parts("view", self.state()["view"]).select("url", "granularity", "bucket", "pageviews")

    # writes
    def catch_up(self, store: FactStore) -> dict:
        """Take in the facts of master that came after those it has. Call it before the store
        is compacted: facts in a compaction can't be told apart by age any more, so if master was
        compacted past what is live here, all is built anew. Returns what was touched."""
        state, compacted = self.state(), store.compacted_through()
        last = max([compacted, *store.batch_ids()])
        if compacted > state["through"]:
            return self.update(store.read_master(), last, _EMPTY | {"run": state["run"]})
        if last == state["through"]:
            return {"days": [], "months": [], "canon": False}
        return self.update(store.read_master().where(F.col("ingest_id") > state["through"]), last, state)

    def update(self, new_facts: DataFrame, through: int, state: dict | None = None) -> dict:
        """Add facts to what ``state`` has (the live state by default)."""
        was = self.state()
        state = was if state is None else state
        run = state["run"] + 1
        stage = parquet_stage(workspace(self.spark, "live"))
        facts = with_target(new_facts)

        canon = self.canon(state)
        extension = INC.extend_canonical_ids(canon, I.equiv_pairs(scan_unit(facts, S.UNIT_EQUIV)), stage)
        merged = I.shuffled(extension.merged)
        changed = state["canon"] is None or not merged.isEmpty()
        if changed:
            extension.canon.write.mode("overwrite").parquet(f"{self.root}/canon/run={run}")
        now = state | {"run": run, "through": through, "canon": run if changed else state["canon"]}

        incoming = stage(self._incoming(facts, self.canon(now), stage), "incoming")
        touched = incoming.select("day")
        if changed:
            persons = self._parts("views", state["views"]).select("day", F.col("pv.person").alias("p"))
            touched = touched.unionByName(persons.join(merged, F.col("p") == F.col("id"), "left_semi").select("day"))
        days = {str(r["day"]) for r in touched.distinct().collect()}  # at most one a day of the facts' time

        before = self._parts("views", {d: r for d, r in state["views"].items() if d in days})
        after = self._moved(before, merged) if changed else before.select("pedigree", "pv", "day")
        after = after.unionByName(incoming).distinct()
        self._write(after, "views", "day", run, "pedigree.true_as_of_secs", F.xxhash64("pv"))
        now["views"] = state["views"] | dict.fromkeys(sorted(days, key=int), run)

        as_facts = lambda v: v.select("pedigree", page_view_arm(F.col("pv")).alias("dataunit"))
        written = self._parts("views", {d: run for d in days})
        delta = stage(INC.view_delta(INC.signed_hours(as_facts(before), as_facts(written))), "delta")
        months = {str(r["month"]) for r in delta.select("month").distinct().collect()}
        held = self._parts("view", {m: r for m, r in state["view"].items() if m in months})
        self._write(INC.merge_view(held.drop("run"), delta), "view", "month", run, "url", "bucket")
        now["view"] = state["view"] | dict.fromkeys(sorted(months, key=int), run)
        # a partition whose rows have all gone has no folder
        for kind, by in (("views", "day"), ("view", "month")):
            there = set(fs.glob_dirs(self.spark, f"{self.root}/{kind}/{by}=*/run={run}"))
            found = {p.rstrip("/").rsplit(f"{by}=", 1)[1].split("/")[0] for p in there}
            now[kind] = {k: r for k, r in now[kind].items() if r != run or k in found}
        fs.write_text(self.spark, self.pointer, json.dumps(now))
        self._clean(now, was)
        return {"days": sorted(map(int, days)), "months": sorted(map(int, months)), "canon": changed}

    def _incoming(self, facts: DataFrame, canon: DataFrame, stage: I.Stage) -> DataFrame:
        """The new page views, normalized and with their day."""
        views = normalize_urls(scan_unit(facts, S.UNIT_PAGE_VIEW))
        known = I.shuffled(INC.known_ids(views.select(F.col("dataunit.page_view.person").alias("p")), canon, stage, "viewers"))
        resolved = I.resolve_person(I.person_left_join(views.select("pedigree", "dataunit"), known))
        day = INC.day_of(F.col("pedigree.true_as_of_secs")).alias("day")
        return resolved.select("pedigree", F.col("dataunit.page_view").alias("pv"), day).distinct()

    def _moved(self, views: DataFrame, merged: DataFrame) -> DataFrame:
        """Stored views with the persons that are no longer canonical replaced."""
        m = merged.select(F.col("id").alias("_id"), F.col("canonical_id").alias("_canonical"))
        joined = views.join(m, F.col("pv.person") == F.col("_id"), "left")
        person = F.coalesce("_canonical", "pv.person")
        return joined.select("pedigree", F.col("pv").withField("person", person).alias("pv"), "day")

    def _write(self, df: DataFrame, kind: str, by: str, run: int, *within) -> None:
        """Ranges of (``by``, ``within``): a day or month has few files, a large one as many
        as it has ranges."""
        (
            df.repartitionByRange(by, *within)
            .withColumn("run", F.lit(run).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(by, "run")
            .parquet(f"{self.root}/{kind}")
        )

    def _clean(self, now: dict, before: dict) -> None:
        """Remove the tables that neither this state nor the one before names."""
        keep = {f"canon/run={s['canon']}" for s in (now, before)}
        for kind, by in (("views", "day"), ("view", "month")):
            keep |= {f"{kind}/{by}={k}/run={r}" for s in (now, before) for k, r in s[kind].items()}
        gone = []
        for pattern, depth in (("canon/run=*", 2), ("views/day=*/run=*", 3), ("view/month=*/run=*", 3)):
            for d in fs.glob_dirs(self.spark, f"{self.root}/{pattern}"):
                if "/".join(d.rstrip("/").split("/")[-depth:]) not in keep:
                    gone.append(d)
        with ThreadPoolExecutor(8) as pool:
            list(pool.map(lambda d: fs.delete(self.spark, d), gone))


def live_workflow(spark: SparkSession, store: FactStore, live: LiveView) -> DataFrame:
    """The batch workflow (W1) by increments: ingest, take the new facts in, compact master;
    the sorted batch view. Its result is that of :func:`workflow.batch_workflow` on all facts. A run that
    died is run again: each of the three steps knows what it has done."""
    ingest(store, consolidate=False)
    live.catch_up(store)
    store.consolidate()
    return PV.sort_view(live.view())
