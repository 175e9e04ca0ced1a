"""Increments: what new facts change in the canonical map, the unique page views and the
batch view, without going through what they don't touch.

* The canonical map is extended by contraction: both ends of a new edge are replaced by
  their canonical ids, so an edge inside a component is a loop and goes, and what is left
  connects components. The fixpoint runs on those edges only.
* Equal page views share their time, so a day can be made distinct alone.
* The batch view is a sum, so it changes by signed counts: those of the touched days as
  they are now, less those as they were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina import schema as S
from lamina.functions import buckets as B
from lamina.operators import identity as I
from lamina.operators import pageviews as PV
from lamina.session import parquet_stage, workspace

SECONDS_A_DAY = B.HOUR_SECS * B.HOURS_PER_DAY


def day_of(secs: Column) -> Column:
    """The day that holds a time, any time: rounds down, also before the epoch."""
    return F.floor(secs / F.lit(SECONDS_A_DAY)).cast("int")


def known_ids(persons: DataFrame, canon: DataFrame, stage: I.Stage, name: str) -> DataFrame:
    """The rows of ``canon`` for a set of persons (column ``p``), as a table. The persons
    are a table first: if they are few the planner sends them to the map, which is read where it
    lies and not shuffled."""
    asked = stage(persons.distinct(), f"{name}_asked")
    found = I.shuffled(asked).join(canon, F.col("p") == F.col("id")).select("id", "canonical_id")
    return stage(found, f"{name}_known")


def contract_edges(edges: DataFrame, canon: DataFrame, stage: I.Stage, name: str = "contract") -> DataFrame:
    """Edges between the canonical ids of their ends, without loops and repetitions."""
    work = I.drop_self_loops(edges.select("a", "b"))
    persons = work.select(F.col("a").alias("p")).unionByName(work.select(F.col("b").alias("p")))
    known = I.shuffled(known_ids(persons, canon, stage, name))
    for end in ("a", "b"):
        of_end = known.select(F.col("id").alias("_id"), F.col("canonical_id").alias("_canonical"))
        work = work.join(of_end, F.col(end) == F.col("_id"), "left")
        work = work.withColumn(end, F.coalesce("_canonical", end)).drop("_id", "_canonical")
    return I.drop_self_loops(work).distinct()


@dataclass(frozen=True)
class Extension:
    """A canonical map with new edges. ``merged``: (id, canonical_id) of the ids that were
    the smallest of their component, or new, and no longer are; ``moved``: (id, before,
    canonical_id) of every id whose canonical id changed, ``before`` its own where it had none."""

    canon: DataFrame
    merged: DataFrame
    moved: DataFrame


def extend_canonical_ids(canon: DataFrame, new_edges: DataFrame, stage: I.Stage | None = None, method: str = "star") -> Extension:
    """``canon`` (id, canonical_id; see :func:`identity.canonical_ids`) extended by new edges
    (I3). The result is the map of all edges, old and new: a component's canonical id is its
    smallest id, so the smallest of the merged components' canonical ids is that of their union.
    Work: the new edges, and one pass over the map for the ids of the merged components."""
    spark = new_edges.sparkSession
    stage = stage or parquet_stage(workspace(spark, "extension"))
    edges = stage(contract_edges(new_edges, canon, stage), "contracted")
    # mostly, new edges join what was joined already
    found = spark.createDataFrame([], S.CANONICAL) if edges.isEmpty() else I.canonical_ids(edges, method=method)
    merged = stage(found, "merged")
    root = I.shuffled(merged).select(F.col("id").alias("_root"), F.col("canonical_id").alias("_new"))
    members = canon.join(root, F.col("canonical_id") == F.col("_root"))
    moved = members.select("id", F.col("canonical_id").alias("before"), F.col("_new").alias("canonical_id"))
    moved = moved.unionByName(merged.select("id", F.col("id").alias("before"), "canonical_id"))
    kept = canon.join(root, F.col("canonical_id") == F.col("_root"), "left")
    extended = kept.select("id", F.coalesce("_new", "canonical_id").alias("canonical_id")).unionByName(merged)
    return Extension(extended, merged, moved)


def signed_hours(before: DataFrame, after: DataFrame) -> DataFrame:
    """(url, bucket=hour, pageviews): how the hourly counts changed, 0 left out."""
    less = PV.hourly_rollup(before).withColumn("pageviews", -F.col("pageviews"))
    change = less.unionByName(PV.hourly_rollup(after)).groupBy("url", "bucket").agg(F.sum("pageviews").alias("pageviews"))
    return change.where(F.col("pageviews") != 0)


def month_of(granularity: Column, bucket: Column) -> Column:
    """The month bucket that a bucket of any granularity lies in: hours, days, weeks and
    months nest."""
    per = F.when(granularity == "h", B.HOURS_PER_DAY * B.DAYS_PER_MONTH).when(granularity == "d", B.DAYS_PER_MONTH)
    per = per.when(granularity == "w", B.DAYS_PER_MONTH // B.DAYS_PER_WEEK).otherwise(1)
    return F.call_function("div", bucket, per).cast("int")


def view_delta(hours: DataFrame) -> DataFrame:
    """The batch view's change (url, granularity, bucket, pageviews, month) from signed
    hourly counts."""
    rows = PV.granularity_sum(PV.granularity_rows(hours)).where(F.col("pageviews") != 0)
    return rows.withColumn("month", month_of(F.col("granularity"), F.col("bucket")))


def merge_view(view: DataFrame, delta: DataFrame) -> DataFrame:
    """A batch view (with its month) and its change added up; buckets without views go."""
    both = view.unionByName(delta).groupBy("month", "url", "granularity", "bucket")
    return both.agg(F.sum("pageviews").cast("bigint").alias("pageviews")).where(F.col("pageviews") != 0)
