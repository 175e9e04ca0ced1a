"""Page views: deduplication and the batch view.

The view is one lazy DataFrame with two aggregations: page views are counted per
``(url, hour)`` first (partial + final aggregate, so a hot URL collapses map-side),
and only the much smaller hourly table fans out ×4 into day/week/month buckets
before the second aggregate. Catalyst does not move an aggregate below an
``explode``, so this pre-aggregation is done here by hand.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina import schema as S
from lamina.functions import buckets as B
from lamina.functions.facts import only_unit, page_view_arm, property_id, unit_id
from lamina.sources import fs

FACT_COLUMNS = ["pedigree", "dataunit"]


def dedup_pageviews(views: DataFrame) -> DataFrame:
    """Distinct page-view facts (A6): equal pedigree (time, source, system), person,
    page and nonce. Hash aggregate with partial distinct before the shuffle, so many
    redeliveries of one fact cost one row per map task.

    A page-view fact has its other three arms null (that is what ``unit_id = 4``
    means), so the key is ``(pedigree, page_view)`` and the union is rebuilt after
    the shuffle: the scan reads only the page-view leaves, and the shuffle carries
    no null arms."""
    pv = only_unit(views, S.UNIT_PAGE_VIEW).select("pedigree", F.col("dataunit.page_view").alias("pv")).distinct()
    return pv.select("pedigree", page_view_arm(F.col("pv")).alias("dataunit"))


def is_url_page(views: DataFrame) -> DataFrame:
    """Page views of pages identified by URL."""
    return views.where(F.col("dataunit.page_view.page.kind") == S.PAGE_URL)


def hour_rows(views: DataFrame) -> DataFrame:
    """``(url, user_id, hour)`` per URL page view (P11); user id is null for cookies."""
    return is_url_page(views).select(
        F.col("dataunit.page_view.page.url").alias("url"),
        F.col("dataunit.page_view.person.user_id").alias("user_id"),
        B.hour_bucket(F.col("pedigree.true_as_of_secs")).alias("hour"),
    )


def visit_keys(views: DataFrame) -> DataFrame:
    """``(url, bucket)`` per URL page view, the user dropped."""
    return is_url_page(views).select(
        F.col("dataunit.page_view.page.url").alias("url"),
        B.hour_bucket(F.col("pedigree.true_as_of_secs")).alias("bucket"),
    )


def hourly_rollup(views: DataFrame) -> DataFrame:
    """``(url, bucket=hour, pageviews)``: page views (not visitors) per URL and hour."""
    return visit_keys(views).groupBy("url", "bucket").agg(F.count(F.lit(1)).alias("pageviews"))


def coarse_buckets(hours: DataFrame, hour_col: str = "hour") -> DataFrame:
    """Add day, week and month buckets to an hour column."""
    h = F.col(hour_col)
    return hours.withColumn("day", B.day_bucket(h)).withColumn("week", B.week_bucket(h)).withColumn(
        "month", B.month_bucket(h)
    )


def granularity_rows(hourly: DataFrame) -> DataFrame:
    """Each ``(url, hour, count)`` as four rows tagged h, d, w, m (G3, P14):
    ``(url, granularity, bucket, pageviews)`` before summing."""
    g = F.explode(B.granularity_array(F.col("bucket"))).alias("g")
    return hourly.select("url", "pageviews", g).select(
        "url", F.col("g.granularity").alias("granularity"), F.col("g.bucket").alias("bucket"), "pageviews"
    )


def granularity_sum(rows: DataFrame) -> DataFrame:
    """Sum counts per ``(url, granularity, bucket)``."""
    return rows.groupBy("url", "granularity", "bucket").agg(F.sum("pageviews").cast("bigint").alias("pageviews"))


def pageview_batch_view(unique_views: DataFrame) -> DataFrame:
    """The batch view ``(url, granularity, bucket, pageviews)`` (A10)."""
    return granularity_sum(granularity_rows(hourly_rollup(unique_views)))


def sort_view(view: DataFrame) -> DataFrame:
    """The view in granularity order d, h, m, w; url and bucket break ties (O2).
    A range-partitioned sort, not a single task."""
    return view.orderBy("granularity", "url", "bucket")


def _code(col: str, codes: dict) -> Column:
    expr = None
    for name, code in codes.items():
        expr = (F.when(F.col(col) == name, F.lit(code))) if expr is None else expr.when(F.col(col) == name, F.lit(code))
    return expr.otherwise(F.lit(None))


def sort_facts(facts: DataFrame) -> DataFrame:
    """Total ascending sort of facts by their natural order (O1): pedigree (time,
    source code, system code), then the union (arm tag, then arm value; enums by
    code, not by name)."""
    pp = "dataunit.person_property"
    return facts.orderBy(
        F.col("pedigree.true_as_of_secs"),
        _code("pedigree.source", S.SOURCE_CODES),
        _code("pedigree.system", S.SYSTEM_CODES),
        unit_id(),
        F.col(f"{pp}.id"),
        property_id(),
        F.col(f"{pp}.property.full_name"),
        _code(f"{pp}.property.gender", S.GENDER_CODES),
        F.col(f"{pp}.property.location"),
        F.col("dataunit.page_property"),
        F.col("dataunit.equiv"),
        F.col("dataunit.page_view"),
    )


def cache_view(view: DataFrame, path: str | None = None) -> DataFrame:
    """Keep the view for later readers (O3): published as a Parquet table when a
    path is given (survives executor loss and the session, see
    :func:`publish_view`), else persisted."""
    if path is None:
        return view.persist()
    return publish_view(view, path)


def publish_view(view: DataFrame, root: str) -> DataFrame:
    """Write the view as a new version under ``root`` and switch ``root/_CURRENT``
    to it. Readers (:func:`read_view`) see the old or the new view, never a half
    written one; the previous version is kept for readers that resolved it
    already, older ones are removed."""
    spark = view.sparkSession
    version = f"v-{uuid.uuid4().hex[:12]}"
    view.write.mode("overwrite").parquet(f"{root}/{version}")
    pointer = f"{root}/_CURRENT"
    previous = fs.read_text(spark, pointer)
    fs.write_text(spark, pointer, version)
    for d in fs.glob_dirs(spark, f"{root}/v-*"):
        if d.rstrip("/").rsplit("/", 1)[1] not in (version, previous):
            fs.delete(spark, d)
    return spark.read.parquet(f"{root}/{version}")


def read_view(spark, root: str) -> DataFrame:
    """The current published view under ``root``."""
    version = fs.read_text(spark, f"{root}/_CURRENT")
    if version is None:
        raise FileNotFoundError(f"no view published under {root}")
    return spark.read.parquet(f"{root}/{version}")
