"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) ->
DataFrame`` over the driver tables, with flat aliased columns matching
:mod:`lamina.plans.oracle`.

Queries that exercise the store write into a fresh folder under the shared
checkpoint folder and read back, so their result is the facts that went through
the sink. Intermediate products shared by many queries (the canonical map, the
adapter facts) are derived once per session and table folder and cut from the
lineage by a written table (the canonical map) or a checkpoint (the first round).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import schema as S
from lamina.functions.facts import flat_columns, flat_person, flatten, set_nested
from lamina.functions.urls import normalize_url
from lamina.operators import identity as I
from lamina.operators import pageviews as PV
from lamina.operators.urls import normalize_urls
from lamina.plans.live import LiveView, live_workflow
from lamina.plans.oracle import URL_SPELLINGS
from lamina.plans.workflow import batch_workflow, unique_pageviews
from lamina.session import checkpoint_stage, default_stage, ensure_checkpoint_dir, parquet_stage, workspace
from lamina.sources import adapters as A
from lamina.sources import fs
from lamina.sources import store as ST
from lamina.streaming.ingest import ingest, snapshot_new

Query = Callable[[SparkSession, str], DataFrame]

_cache: dict = {}


def _key(spark: SparkSession, sf_dir: str, what: str):
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)


def _memo(spark: SparkSession, sf_dir: str, what: str, build):
    k = _key(spark, sf_dir, what)
    if k not in _cache:
        ensure_checkpoint_dir(spark)
        _cache[k] = build()
    return _cache[k]


def canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical map of the adapter's equiv edges (star fixpoint), a written table."""
    return _memo(
        spark, sf_dir, "canon", lambda: I.shuffled(I.canonical_ids(I.equiv_pairs(A.equiv_facts(spark, sf_dir))))
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's new facts (S1); the canonical map is a written input table."""
    return A.adapter_facts(spark, sf_dir, canon(spark, sf_dir))


def _equiv_edges(spark, sf_dir) -> DataFrame:
    return I.equiv_pairs(A.equiv_facts(spark, sf_dir))


def _bi(spark, sf_dir) -> DataFrame:
    return I.bidirectional_edges(_equiv_edges(spark, sf_dir))


def _round1(spark, sf_dir) -> DataFrame:
    """The first relinking round, its per-node facts written first so that a hub is split."""
    edges = _equiv_edges(spark, sf_dir)
    return _memo(spark, sf_dir, "round1", lambda: checkpoint_stage(I.equiv_round(edges, default_stage(spark))))


def _staged_stats(spark, bi: DataFrame) -> DataFrame:
    return default_stage(spark)(I.node_stats(bi), "node_stats")


def _edges_out(df: DataFrame, a: str = "a", b: str = "b", pa: str = "a", pb: str = "b", *extra) -> DataFrame:
    return df.select(*flat_person(a, pa), *flat_person(b, pb), *extra)


def _unique(spark, sf_dir) -> DataFrame:
    return unique_pageviews(facts(spark, sf_dir), canon(spark, sf_dir))


def _views(spark, sf_dir) -> DataFrame:
    return ST.scan_unit(facts(spark, sf_dir), S.UNIT_PAGE_VIEW)


def _view(spark, sf_dir) -> DataFrame:
    return PV.pageview_batch_view(_unique(spark, sf_dir))


def _fresh_store(spark: SparkSession, name: str) -> ST.FactStore:
    return ST.FactStore(spark, workspace(spark, name)).create()


# --- sources and sinks -----------------------------------------------------------------


def q_make_facts(spark, sf_dir):
    return flatten(facts(spark, sf_dir))


def q_append_new(spark, sf_dir):
    store = _fresh_store(spark, "append_new")
    f = facts(spark, sf_dir)
    store.append_new(ST.scan_unit(f, S.UNIT_PAGE_VIEW))
    store.append_new(f.where(F.col("dataunit.page_view").isNull()))
    return flatten(store.read_new())


def _ingested_store(spark, sf_dir) -> ST.FactStore:
    def build():
        store = _fresh_store(spark, "master")
        store.append_new(facts(spark, sf_dir))
        ingest(store)
        return store

    return _memo(spark, sf_dir, "store", build)


def q_scan_facts(spark, sf_dir):
    store = _ingested_store(spark, sf_dir)
    return flatten(ST.scan_facts(spark, store.master_path(), S.MASTER).where(store.visible()))


def q_scan_unit(spark, sf_dir):
    return flatten(ST.scan_unit(_ingested_store(spark, sf_dir).read_master(), S.UNIT_PAGE_VIEW))


def q_scan_with_path(spark, sf_dir):
    store = _ingested_store(spark, sf_dir)
    df = ST.scan_with_path(spark, store.master_path()).where(store.visible())
    return df.select(*flat_columns(), "rel_path")


def q_scan_tolerant(spark, sf_dir):
    store = _ingested_store(spark, sf_dir)
    scan = ST.scan_tolerant(spark, store.master_path(), S.MASTER)
    return flatten(scan.facts.where(store.visible()))


GOOD_FILES, DAMAGED_FILES = 6, 2


def q_scan_tolerant_damaged(spark, sf_dir):
    """All facts beside copies of some files that break off half way: what is read of either,
    and how many files were listed and lost rows."""
    root = workspace(spark, "damaged")
    facts(spark, sf_dir).repartition(GOOD_FILES).write.parquet(root)
    for k, path in enumerate(sorted(fs.glob_dirs(spark, f"{root}/part-*"))[:DAMAGED_FILES]):
        fs.copy_beginning(spark, path, f"{root}/part-damaged-{k}.parquet")
    scan = ST.scan_tolerant(spark, root)
    counts = ST.shred(scan.facts).groupBy("unit_id", "property_id").agg(F.count(F.lit(1)).alias("facts"))
    files = scan.files.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.expr("expected is null or read < expected")).alias("lost"), F.sum("read").alias("rows_read"))
    return counts.select("*", *(F.lit(v).cast("bigint").alias(k) for k, v in files.first().asDict().items()))


def q_ingest_snapshot(spark, sf_dir):
    store = _fresh_store(spark, "snapshot")
    store.append_new(facts(spark, sf_dir))
    path = f"{store.root}/snapshot"
    snapshot_new(store, path)
    return flatten(ST.scan_facts(spark, path))


def q_ingest_consume(spark, sf_dir):
    """Facts arriving between runs are taken exactly once; a run with nothing new adds nothing."""
    store = _fresh_store(spark, "consume")
    f = facts(spark, sf_dir)
    store.append_new(ST.scan_unit(f, S.UNIT_PAGE_VIEW))
    ingest(store, consolidate=False)
    store.append_new(f.where(F.col("dataunit.page_view").isNull()))
    ingest(store, consolidate=False)
    ingest(store)
    return flatten(store.read_master())


def q_shred(spark, sf_dir):
    shredded = ST.shred(facts(spark, sf_dir))
    return shredded.select("unit_id", "property_id", *flat_columns()[2:])


def q_validate_target(spark, sf_dir):
    return ST.validate_target(ST.shred(facts(spark, sf_dir)))


def q_validate_target_illegal(spark, sf_dir):
    """All facts, and the edges again without their arm: these have no legal target."""
    edges = A.equiv_facts(spark, sf_dir)
    nothing = F.col("dataunit").cast(S.DATAUNIT).withField("equiv", F.lit(None).cast(S.EQUIV_EDGE))
    return ST.validate_target(ST.shred(facts(spark, sf_dir).unionByName(edges.withColumn("dataunit", nothing))))


def q_absorb(spark, sf_dir):
    store = _fresh_store(spark, "absorb")
    store.absorb(ST.shred(facts(spark, sf_dir)), 0)
    return flatten(store.read_master())


def q_consolidate(spark, sf_dir):
    store = _fresh_store(spark, "consolidate")
    shredded = ST.shred(facts(spark, sf_dir))
    for i, unit in enumerate([S.UNIT_PAGE_VIEW, S.UNIT_EQUIV, S.UNIT_PAGE_PROPERTY, S.UNIT_PERSON_PROPERTY]):
        store.absorb(shredded.where(F.col("unit_id") == unit), i)
    store.consolidate()
    return flatten(store.read_master())


def q_ingest(spark, sf_dir):
    store = _fresh_store(spark, "ingest")
    store.append_new(facts(spark, sf_dir))
    ingest(store)
    return flatten(store.read_master())


def q_stage_edges(spark, sf_dir):
    root = workspace(spark, "stage_edges")
    final, _ = I.equiv_fixpoint(_equiv_edges(spark, sf_dir), stage=parquet_stage(root))
    return I.swap_pair(final).select(*flat_person("id", "id"), *flat_person("canonical_id", "canonical"))


def q_stage_facts(spark, sf_dir):
    staged = ST.stage_facts(normalize_urls(facts(spark, sf_dir)), workspace(spark, "stage_facts"))
    return flatten(staged)


def q_reset_workspace(spark, sf_dir):
    root = workspace(spark, "reset")
    f = facts(spark, sf_dir)
    ST.append_new(f, root)
    ST.reset_workspace(spark, root)
    ST.append_new(f, root)
    return flatten(ST.scan_facts(spark, root))


# --- projections and row functions --------------------------------------------------------


def q_fact_target(spark, sf_dir):
    return (
        ST.shred(facts(spark, sf_dir))
        .groupBy("unit_id", "property_id")
        .agg(F.count(F.lit(1)).alias("facts"))
    )


def q_equiv_pairs(spark, sf_dir):
    return _edges_out(_equiv_edges(spark, sf_dir))


def q_normalize_url(spark, sf_dir):
    pages = A.read_table(spark, sf_dir, "pages")
    return pages.select("url", normalize_url("url").alias("normalized_url"))


def q_normalize_url_spellings(spark, sf_dir):
    """Every page's URL in the spellings of :mod:`lamina.plans.oracle`."""
    cut = F.substring_index(F.substring_index("url", "#", 1), "?", 1)
    pages = A.read_table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("u"), cut.alias("cut"))
    scheme, rest = F.substring_index("cut", "://", 1), F.expr("substring(cut, length(substring_index(cut, '://', 1)) + 4)")
    pages = pages.withColumn("scheme", scheme).withColumn("host", F.substring_index(rest, "/", 1))
    pages = pages.withColumn("path", F.expr("substring(cut, length(scheme) + length(host) + 4)"))
    spellings = F.array(*(F.expr(text) for text, _ in URL_SPELLINGS))
    each = pages.select("page_id", F.posexplode(spellings).alias("spelling", "url"))
    return each.withColumn("normalized_url", normalize_url("url"))


def q_normalize_urls(spark, sf_dir):
    return flatten(normalize_urls(facts(spark, sf_dir)))


def q_set_nested(spark, sf_dir):
    views = _views(spark, sf_dir)
    du = set_nested(F.col("dataunit"), "page_view", "page.url", normalize_url(F.col("dataunit.page_view.page.url")))
    return flatten(views.withColumn("dataunit", du))


def q_is_url_page(spark, sf_dir):
    return flatten(PV.is_url_page(_views(spark, sf_dir)))


def q_drop_self_loops(spark, sf_dir):
    return _edges_out(I.drop_self_loops(_equiv_edges(spark, sf_dir)))


def q_progress_edges(spark, sf_dir):
    return _edges_out(I.progress_edges(_round1(spark, sf_dir)))


def q_swap_pair(spark, sf_dir):
    return I.swap_pair(_round1(spark, sf_dir)).select(
        *flat_person("id", "id"), *flat_person("canonical_id", "canonical")
    )


def q_key_by_person(spark, sf_dir):
    return _views(spark, sf_dir).select(
        *flat_person("dataunit.page_view.person", "person"),
        F.col("pedigree.true_as_of_secs").alias("true_as_of_secs"),
        F.col("dataunit.page_view.page.url").alias("page_url"),
        F.col("dataunit.page_view.nonce").alias("nonce"),
    )


def q_hour_bucket(spark, sf_dir):
    return PV.hour_rows(_unique(spark, sf_dir))


def q_coarse_buckets(spark, sf_dir):
    hours = PV.hour_rows(_unique(spark, sf_dir)).select("hour").distinct()
    return PV.coarse_buckets(hours)


def q_visit_keys(spark, sf_dir):
    return PV.visit_keys(_unique(spark, sf_dir))


def q_view_row(spark, sf_dir):
    return _view(spark, sf_dir).select("url", "granularity", "bucket", "pageviews")


def q_resolve_person(spark, sf_dir):
    views = normalize_urls(_views(spark, sf_dir)).select(
        "pedigree", "dataunit", F.col("dataunit.page_view.person").alias("_raw")
    )
    resolved = I.resolve_person(I.person_left_join(views, canon(spark, sf_dir)))
    return resolved.select(
        *flat_person("_raw", "person"),
        *flat_person("dataunit.page_view.person", "resolved"),
        F.col("pedigree.true_as_of_secs").alias("true_as_of_secs"),
        F.col("dataunit.page_view.page.url").alias("page_url"),
        F.col("dataunit.page_view.nonce").alias("nonce"),
    )


# --- row generators --------------------------------------------------------------------


def q_bidirectional_edges(spark, sf_dir):
    return _edges_out(_bi(spark, sf_dir).distinct())


def q_relink_to_smallest(spark, sf_dir):
    bi = _bi(spark, sf_dir)
    rel = I.relink_to_smallest(bi, _staged_stats(spark, bi)).distinct()
    return rel.select(*flat_person("node", "node"), *flat_person("m", "m"), *flat_person("x", "x"), "progress")


def q_granularity_rows(spark, sf_dir):
    return PV.granularity_rows(PV.hourly_rollup(_unique(spark, sf_dir)))


# --- joins ---------------------------------------------------------------------------------


def q_person_left_join(spark, sf_dir):
    joined = I.person_left_join(_views(spark, sf_dir), canon(spark, sf_dir))
    return joined.select(
        *flat_person("dataunit.page_view.person", "person"),
        *flat_person("_canonical", "canonical"),
        F.col("pedigree.true_as_of_secs").alias("true_as_of_secs"),
        F.col("dataunit.page_view.page.url").alias("page_url"),
        F.col("dataunit.page_view.nonce").alias("nonce"),
    )


def q_normalize_user_ids(spark, sf_dir):
    return flatten(I.normalize_user_ids(normalize_urls(_views(spark, sf_dir)), canon(spark, sf_dir)))


# --- aggregation and distinct ----------------------------------------------------------------


def q_neighbors_by_node(spark, sf_dir):
    nb = I.neighbors_by_node(_bi(spark, sf_dir))
    return nb.select(
        *flat_person("a", "node"), F.col("neighbors").cast("bigint").alias("neighbors"),
        *flat_person("min_b", "min"), *flat_person("max_b", "max"),
    )


def q_smallest_in_group(spark, sf_dir):
    return I.node_stats(_bi(spark, sf_dir)).select(*flat_person("a", "node"), *flat_person("m", "smallest"))


def q_group_progress(spark, sf_dir):
    return I.node_stats(_bi(spark, sf_dir)).select(*flat_person("a", "node"), "progress")


def q_distinct_flagged_edges(spark, sf_dir):
    bi = _bi(spark, sf_dir)
    flagged = I.distinct_flagged_edges(I.relink_to_smallest(bi, _staged_stats(spark, bi)))
    return _edges_out(flagged, "a", "b", "a", "b", "progress")


def q_distinct_edges(spark, sf_dir):
    return _edges_out(I.distinct_edges(_round1(spark, sf_dir)))


def q_dedup_pageviews(spark, sf_dir):
    return flatten(_unique(spark, sf_dir))


def q_hourly_rollup(spark, sf_dir):
    return PV.hourly_rollup(_unique(spark, sf_dir))


def q_granularity_sum(spark, sf_dir):
    return PV.granularity_sum(PV.granularity_rows(PV.hourly_rollup(_unique(spark, sf_dir))))


def q_progress_count(spark, sf_dir):
    r1 = _round1(spark, sf_dir)
    progress = F.lit(I.progress_count(r1)).cast("bigint")
    return r1.agg(F.count(F.lit(1)).alias("edges")).withColumn("progress_edges", progress)


def q_pageview_batch_view(spark, sf_dir):
    return _view(spark, sf_dir)


# --- sort and cache --------------------------------------------------------------------------


def q_sort_facts(spark, sf_dir):
    return flatten(PV.sort_facts(_unique(spark, sf_dir)))


def q_sort_view(spark, sf_dir):
    return PV.sort_view(_view(spark, sf_dir))


def q_cache_view(spark, sf_dir):
    return PV.cache_view(_view(spark, sf_dir), workspace(spark, "view"))


# --- iteration and workflow -------------------------------------------------------------------


def q_equiv_round(spark, sf_dir):
    return _edges_out(_round1(spark, sf_dir), "a", "b", "a", "b", "progress")


def q_equiv_fixpoint(spark, sf_dir):
    final, _ = I.equiv_fixpoint(_equiv_edges(spark, sf_dir))
    return _edges_out(final)


def q_canonical_ids(spark, sf_dir):
    found = I.canonical_ids(_equiv_edges(spark, sf_dir))
    return found.select(*flat_person("id", "id"), *flat_person("canonical_id", "canonical"))


def q_batch_workflow(spark, sf_dir):
    store = _fresh_store(spark, "workflow")
    store.append_new(facts(spark, sf_dir))
    return batch_workflow(spark, store, stage_root=f"{store.root}/stages", view_path=f"{store.root}/view")


# --- increments ----------------------------------------------------------------------------------


ARRIVALS = 3


def _live(spark, sf_dir) -> LiveView:
    """All facts, come in three arrivals that are taken in one after the other."""

    def build():
        arrived = parquet_stage(workspace(spark, "arrivals"))(facts(spark, sf_dir), "facts")
        store, live = _fresh_store(spark, "live-master"), LiveView(spark, workspace(spark, "live"))
        for k in range(ARRIVALS):
            store.append_new(arrived.where(F.pmod(F.xxhash64("dataunit"), F.lit(ARRIVALS)) == k))
            live_workflow(spark, store, live)
        return live

    return _memo(spark, sf_dir, "live", build)


def q_canonical_ids_live(spark, sf_dir):
    found = _live(spark, sf_dir).canon()
    return found.select(*flat_person("id", "id"), *flat_person("canonical_id", "canonical"))


def q_dedup_pageviews_live(spark, sf_dir):
    return flatten(_live(spark, sf_dir).unique_views())


def q_pageview_batch_view_live(spark, sf_dir):
    return _live(spark, sf_dir).view()


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
