"""Session helpers: the shared workspace and lineage cuts.

Intermediate results (iteration rounds, staged datasets, the fact store of a run)
live under the cluster's shared checkpoint folder, ``spark.checkpoint.dir``. It is
read from the session; a local folder is created only when the setting is unset,
as in tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "lamina") -> SparkSession:
    """A session with the settings the jobs expect (AQE, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # partitioned writes hit at most six kinds per task: keep their files open
        # instead of sorting each task's rows by partition value first
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def open_writers(spark: SparkSession, files: int = 8) -> Iterator[None]:
    """Partitioned writes in here keep up to ``files`` files of a task open; else a task sorts all its
    rows by partition value first and holds them for that. A setting of the session's own stays; the
    one made here ends with the block."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, "0")
    if int(before) <= 0:
        spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python functions on Arrow data that run in here get at most ``rows`` rows at once. A smaller
    setting of the session's own stays; the one made here ends with the block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(min(rows, 2**31 - 1)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and run data.

    Order: ``spark.checkpoint.dir``, then the context's checkpoint dir; only when
    both are unset and the master is local is a local folder made. On a cluster the
    executors would not share it, so there a missing setting raises."""
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if conf_dir:
        if not current:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="lamina-ckpt-")
    sc.setCheckpointDir(local)
    return local


def workspace(spark: SparkSession, name: str = "run") -> str:
    """A fresh directory under the shared checkpoint folder for one run's data."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base}/lamina/{name}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_made: dict[str, list[str]] = {}


def remove_workspaces(spark: SparkSession) -> int:
    """Delete every folder :func:`workspace` has given to this application; returns how
    many. For the end of a run, once its results are read or copied."""
    from lamina.sources import fs

    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        fs.delete(spark, path)
    return len(paths)


def checkpoint_stage(df: DataFrame, name: str = "") -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parquet_stage(root: str, keep_last: int | None = None) -> "callable":
    """A stage function that writes each named step as a Parquet table under ``root``
    and reads it back (S14): the rounds survive the session, not only the job.

    With ``keep_last`` only that many of the most recent tables are kept: an
    iteration reads just the previous round, so older rounds are deleted once a
    newer one is written."""
    written: list[str] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
        written.append(path)
        if keep_last is not None:
            from lamina.sources import fs

            while len(written) > keep_last:
                fs.delete(df.sparkSession, written.pop(0))
        return out

    return stage


def default_stage(spark: SparkSession):
    """Stage function for iterative jobs: each step becomes a Parquet table in a fresh
    folder under the shared checkpoint folder. Unlike an RDD checkpoint, a table
    carries file sizes, so the planner can choose broadcast or sort-merge joins on
    the next step from real sizes."""
    return parquet_stage(workspace(spark, "stage"), keep_last=2)


__all__ = [
    "build_session",
    "checkpoint_stage",
    "default_stage",
    "remove_workspaces",
    "ensure_checkpoint_dir",
    "open_writers",
    "parquet_stage",
    "workspace",
]
