"""Benchmark of the headline jobs.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
and prints one JSON line. Each job is run once to warm up, then
``$BENCH_REPEATS`` times (default 3); the median is reported. Jobs are forced with
the ``noop`` sink, so the whole plan runs and nothing is collected.

Setup (not timed): the adapter's facts are ingested once into a fact store;
``canonical_ids``, ``dedup_pageviews`` and ``pageview_batch_view`` read that master.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from lamina import schema as S  # noqa: E402
from lamina.operators import identity as I  # noqa: E402
from lamina.operators import pageviews as PV  # noqa: E402
from lamina.operators.urls import normalize_urls  # noqa: E402
from lamina.plans.workflow import batch_workflow  # noqa: E402
from lamina.session import ensure_checkpoint_dir, workspace  # noqa: E402
from lamina.sources import adapters as A  # noqa: E402
from lamina.sources import store as ST  # noqa: E402
from lamina.streaming.ingest import ingest  # noqa: E402


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lamina-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(cpus) if cpus.isdigit() else 16)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = session(cpus)

    t0 = time.perf_counter()
    facts_path = workspace(spark, "bench-facts")
    A.adapter_facts(spark, sf_dir).write.parquet(facts_path)
    facts = ST.scan_facts(spark, facts_path)
    store = ST.FactStore(spark, workspace(spark, "bench-master")).create()
    store.append_new(facts)
    ingest(store)
    master = store.read_master()
    canon = I.canonical_ids(I.equiv_pairs(ST.scan_unit(master, S.UNIT_EQUIV)))
    setup = time.perf_counter() - t0

    def q_ingest():
        s = ST.FactStore(spark, workspace(spark, "bench-ingest")).create()
        s.append_new(facts)
        ingest(s)

    def q_normalize_urls():
        run(normalize_urls(master))

    def q_canonical_ids():
        run(I.canonical_ids(I.equiv_pairs(ST.scan_unit(master, S.UNIT_EQUIV))))

    def q_canonical_ids_relink():
        run(I.canonical_ids(I.equiv_pairs(ST.scan_unit(master, S.UNIT_EQUIV)), method="relink"))

    def q_dedup_pageviews():
        views = normalize_urls(ST.scan_unit(master, S.UNIT_PAGE_VIEW))
        run(PV.dedup_pageviews(I.normalize_user_ids(views, canon)))

    def q_pageview_batch_view():
        views = normalize_urls(ST.scan_unit(master, S.UNIT_PAGE_VIEW))
        run(PV.pageview_batch_view(PV.dedup_pageviews(I.normalize_user_ids(views, canon))))

    def q_batch_workflow():
        s = ST.FactStore(spark, workspace(spark, "bench-workflow")).create()
        s.append_new(facts)
        run(batch_workflow(spark, s))

    jobs = {
        "ingest": q_ingest,
        "normalize_urls": q_normalize_urls,
        "canonical_ids": q_canonical_ids,
        "canonical_ids_relink": q_canonical_ids_relink,
        "dedup_pageviews": q_dedup_pageviews,
        "pageview_batch_view": q_pageview_batch_view,
        "batch_workflow": q_batch_workflow,
    }
    results = {name: timed(fn, repeats) for name, fn in jobs.items()}
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_sec",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": float(m.group(1)) if m else sf_dir,
                "setup_sec": round(setup, 3),
                "facts": master.count(),
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )


if __name__ == "__main__":
    main()
