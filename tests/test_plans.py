"""Plan shape: pruning, pushdown, no Python UDFs, exchanges."""

from __future__ import annotations

import pytest

from helpers import fixture_facts
from lamina import schema as S
from lamina.operators import pageviews as PV
from lamina.plans import catalog
from lamina.sources import store as ST

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def master(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("master"))
    store = ST.FactStore(spark, root).create()
    store.absorb(ST.shred(fixture_facts(spark)), 0)
    return store


def test_scan_unit_prunes_partitions(master):
    plan = _plan(ST.scan_unit(master.read_master(), S.UNIT_PAGE_VIEW))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "isnotnull(unit_id#" in filters and "(unit_id#" in filters and "ingest_id#" in filters


def test_view_reads_only_needed_leaves(master):
    unique = PV.dedup_pageviews(ST.scan_unit(master.read_master(), S.UNIT_PAGE_VIEW))
    plan = _plan(PV.hourly_rollup(ST.scan_unit(master.read_master(), S.UNIT_PAGE_VIEW)))
    assert "person_property" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert unique is not None


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_udf_in_any_query(spark, name):
    if name in {"batch_workflow", "ingest", "ingest_consume", "ingest_snapshot", "consolidate", "absorb",
                "append_new", "reset_workspace", "stage_facts", "stage_edges", "cache_view", "scan_tolerant_damaged"}:
        pytest.skip("writes data; covered by test_ingest")
    plan = _plan(catalog.queries()[name](spark, SMALL))
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in plan, name


def test_batch_view_has_two_aggregation_shuffles(spark):
    plan = _plan(catalog.q_pageview_batch_view(spark, SMALL))
    assert plan.count("HashAggregate") >= 4


def test_full_view_path_prunes_other_arms(master):
    from lamina.operators import identity as I
    from lamina.operators.urls import normalize_urls

    m = master.read_master()
    canon = I.canonical_ids(I.equiv_pairs(ST.scan_unit(m, S.UNIT_EQUIV)))
    views = normalize_urls(ST.scan_unit(m, S.UNIT_PAGE_VIEW))
    view = PV.pageview_batch_view(PV.dedup_pageviews(I.normalize_user_ids(views, canon)))
    plan = _plan(view)
    scan_schema = [line for line in plan.split("\n") if "ReadSchema" in line and "page_view" in line][0]
    for arm in ("person_property", "page_property", "equiv"):
        assert arm not in scan_schema
    filters = [line for line in plan.split("\n") if "Filter " in line]
    assert filters and not any("regexp" in line for line in filters)  # the URL rule is never re-run in a filter


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from lamina.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    for master, raises in (("local[4]", False), ("local", False), ("local-cluster[2,1,1024]", True), ("spark://h:7077", True)):
        context = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        session = SimpleNamespace(sparkContext=context, conf=conf)
        if raises:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                ensure_checkpoint_dir(session)
        else:
            assert ensure_checkpoint_dir(session)


def test_workspaces_are_removed(spark):
    from lamina.session import remove_workspaces, workspace
    from lamina.sources import fs

    path = workspace(spark, "scratch")
    spark.range(3).write.parquet(path)
    kept = __import__("lamina.session", fromlist=["_made"])._made
    others = kept[spark.sparkContext.applicationId][:]
    kept[spark.sparkContext.applicationId] = [path]
    assert remove_workspaces(spark) == 1 and not fs.exists(spark, path)
    kept[spark.sparkContext.applicationId] = others
