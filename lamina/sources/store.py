"""The fact store: a flat *new-data* dataset and a vertically partitioned *master*.

Layout under one root (a folder in the cluster's shared storage)::

    rejected/ingest_id=7/             facts that cannot be routed, with a reason
    new/                              flat Parquet, appended by producers (S2)
    master/_COMPACTED                 K, the live compactions and the ledger of batches (a few bytes)
    master/unit_id=4/property_id=0/ingest_id=7/part-*.parquet     an ingest batch
    master/unit_id=4/property_id=0/ingest_id=-9/part-*.parquet    a compaction
    _ingest/checkpoint, _ingest/archive   streaming ingest state (lamina.streaming)

Partitions are ``unit_id`` / ``property_id`` (the union arm tags, S9) and
``ingest_id`` (the ingest batch). A batch written twice overwrites itself (dynamic
partition overwrite), so a replayed ingest batch never duplicates facts. Which id a batch
has is the store's to say, not the stream's: see :meth:`FactStore.ingest_id`.
Compaction merges the new batches, with earlier compactions that are not much larger,
and moves the pointer (S12). What it merged stays on disk until the next compaction.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import schema as S
from lamina.functions.facts import arm_count, only_unit, property_id, unit_id
from lamina.session import open_writers
from lamina.sources import fs

FACT_COLUMNS = ["pedigree", "dataunit"]
TARGET_FILE_BYTES = 128 * 1024 * 1024
#: What a task of a compaction sorts at most, whatever its file comes down to: facts, and bytes of their strings.
TASK_FACTS, TASK_TEXT_BYTES = 1 << 20, 256 * 1024 * 1024


# --- S10: legal targets -----------------------------------------------------------


def legal_target(u: Column | str = "unit_id", p: Column | str = "property_id") -> Column:
    """True for the six legal ``(unit_id, property_id)`` pairs. A fixed expression,
    no join."""
    uc = F.col(u) if isinstance(u, str) else u
    pc = F.col(p) if isinstance(p, str) else p
    cond = F.lit(False)
    for unit, prop in S.LEGAL_TARGETS:
        cond = cond | ((uc == unit) & (pc == prop))
    return cond


def well_formed() -> Column:
    """Exactly one union arm set and the required pedigree fields present."""
    return (
        (arm_count() == 1)
        & F.col("pedigree.true_as_of_secs").isNotNull()
        & F.col("pedigree.source").isin(*S.SOURCE_CODES)
        & F.col("pedigree.system").isin(*S.SYSTEM_CODES)
    )


def validate_target(shredded: DataFrame) -> DataFrame:
    """Per distinct ``(unit_id, property_id)``: number of facts and whether the
    target is legal (S10). Partial aggregation, one small shuffle."""
    return (
        shredded.groupBy("unit_id", "property_id")
        .agg(F.count(F.lit(1)).alias("facts"))
        .withColumn("valid", legal_target())
    )


def validate_path(path: str) -> bool:
    """Is a partition path like ``1/2`` or ``4`` legal? First level a known kind;
    property kinds need a known numeric second level; edge kinds accept anything
    after the first level."""
    parts = [x for x in path.split("/") if x != ""]
    if not parts or not parts[0].isdigit():
        return False
    unit = int(parts[0])
    props = {p for u, p in S.LEGAL_TARGETS if u == unit}
    if not props:
        return False
    if props == {0}:
        return True
    return len(parts) >= 2 and parts[1].isdigit() and int(parts[1]) in props


# --- S9: shred ----------------------------------------------------------------------


def shred(facts: DataFrame) -> DataFrame:
    """Facts with their partition values ``unit_id``, ``property_id``."""
    return facts.select(*FACT_COLUMNS, unit_id().alias("unit_id"), property_id().alias("property_id"))


def relative_path(u: Column | str = "unit_id", p: Column | str = "property_id") -> Column:
    """Partition path of a fact: ``u/p`` for property kinds, ``u`` for edges."""
    uc = F.col(u) if isinstance(u, str) else u
    pc = F.col(p) if isinstance(p, str) else p
    return F.when(pc == 0, uc.cast("string")).otherwise(F.concat_ws("/", uc.cast("string"), pc.cast("string")))


# --- S3-S6: scans -------------------------------------------------------------------


def scan_facts(spark: SparkSession, path: str, schema=S.FACT, tolerant: bool = False) -> DataFrame:
    """Read a fact dataset with the declared schema, never inferred (S3)."""
    reader = spark.read.schema(schema)
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true")
    return reader.parquet(path)


def scan_unit(facts: DataFrame, unit: int, prop: int | None = None) -> DataFrame:
    """One fact kind (S4). On a partitioned dataset the predicate on the partition
    column prunes directories (``PartitionFilters``); on other data it is a filter
    on the arm tag."""
    return only_unit(facts, unit, prop)


def scan_with_path(spark: SparkSession, path: str, schema=S.MASTER) -> DataFrame:
    """Facts paired with their partition path and source file."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(
        "*",
        relative_path().alias("rel_path"),
        F.col("_metadata.file_path").alias("file_path"),
    )


@dataclass
class TolerantScan:
    facts: DataFrame
    #: One row per data file: ``file_path``, ``expected`` (rows by its footer; null if
    #: that can't be read) and ``read`` (rows that were decoded whole).
    files: DataFrame

    @property
    def lost(self) -> DataFrame:
        """The files that did not yield all their rows."""
        return self.files.where("expected is null or read < expected")

    @property
    def files_listed(self) -> int:
        return self.files.count()

    @property
    def lost_count(self) -> int:
        return self.lost.count()

    @property
    def files_read(self) -> int:
        return self.files_listed - self.lost_count

    @property
    def lost_rows(self) -> int:
        """Rows missing from files with a readable footer."""
        row = self.lost.agg(F.sum(F.col("expected") - F.col("read"))).first()
        return int(row[0] or 0)


def scan_tolerant(spark: SparkSession, path: str, schema=S.FACT) -> TolerantScan:
    """Read what can be read; report files that lost rows.

    Corrupt files are skipped from the fault on (``ignoreCorruptFiles``) instead of
    failing the job; transient faults are retried by ``spark.task.maxFailures``. The
    report compares, file by file, the rows that the footer states (a scan of no
    column) with the rows of which every leaf was decoded, so damaged pages show as
    well as damaged footers. The listing is itself a DataFrame (the ``binaryFile``
    source with only ``path`` selected reads no file content): no file list passes
    through the driver. The report is a second and third pass over the files, run only
    when it is asked for."""
    df = scan_facts(spark, path, schema, tolerant=True)
    at = _norm(F.col("_metadata.file_path")).alias("file_path")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(_norm(F.col("path")).alias("file_path"))
    )
    expected = df.groupBy(at).agg(F.count(F.lit(1)).alias("expected"))
    whole = df.select(at, F.xxhash64("pedigree", "dataunit").alias("_h"))
    read = whole.groupBy("file_path").agg(F.count("_h").alias("read"), F.bit_xor("_h").alias("_all")).where("_all is not null")
    files = listed.join(expected, "file_path", "left").join(read.select("file_path", "read"), "file_path", "left")
    return TolerantScan(df, files.withColumn("read", F.coalesce("read", F.lit(0))))


def _norm(path: Column) -> Column:
    """File URI without scheme and authority, so listings and row metadata compare."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


# --- S2, S11, S12, S15, S16: writes -------------------------------------------------


def text_bytes(schema=S.FACT, at: str = "") -> Column:
    """Bytes of all strings of a row."""
    total = F.lit(0)
    for f in schema.fields:
        if isinstance(f.dataType, S.T.StructType):
            total = total + text_bytes(f.dataType, f"{at}{f.name}.")
        elif isinstance(f.dataType, S.T.StringType):
            total = total + F.coalesce(F.octet_length(f"{at}{f.name}"), F.lit(0))
    return total


def append_new(facts: DataFrame, new_path: str) -> None:
    """Append facts to the flat new-data dataset (S2). Task commit makes a retried
    task's output replace, not add to, its first attempt."""
    facts.select(*FACT_COLUMNS).write.mode("append").parquet(new_path)


def stage_facts(facts: DataFrame, path: str) -> DataFrame:
    """Write one stage's facts in vertical layout and read them back."""
    shredded = shred(facts.select(*FACT_COLUMNS)) if "unit_id" not in facts.columns else facts
    with open_writers(shredded.sparkSession):
        (
            shredded.select(*FACT_COLUMNS, "unit_id", "property_id")
            .write.mode("overwrite")
            .partitionBy("unit_id", "property_id")
            .parquet(path)
        )
    return facts.sparkSession.read.schema(S.STAGED).parquet(path)


def reset_workspace(spark: SparkSession, *paths: str) -> None:
    """Delete and recreate working folders so a rerun starts clean."""
    for p in paths:
        fs.delete(spark, p)
        fs.mkdirs(spark, p)


class StaleCheckpointError(RuntimeError):
    """A stream's checkpoint is older than what master has of it."""


class FactStore:
    """New-data and master datasets under one root.

    Master holds two kinds of partitions: ingest batches (``ingest_id >= 0``, one
    per micro-batch, many small files) and compactions (``ingest_id < 0``). The
    pointer file ``master/_COMPACTED`` holds K and the ids of the live compactions:
    batches ``<= K`` are in these (and the ledger of batches, see :meth:`ingest_id`). Readers see batches above K and the live
    compactions, a partition filter, so replacing the pointer (one rename) switches
    from the merged parts to their compaction at once. A compaction that was written
    but not committed is not live and never seen, and what a compaction merged stays
    on disk until the next one, for readers that hold the pointer of before."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.new_path = f"{self.root}/new"
        self.master = f"{self.root}/master"
        self.pointer = f"{self.master}/_COMPACTED"
        self.rejected = f"{self.root}/rejected"
        self.ingest_checkpoint = f"{self.root}/_ingest/checkpoint"
        self.ingest_archive = f"{self.root}/_ingest/archive"

    def _held(self) -> dict:
        """What the pointer holds: ``through`` (K), ``live`` compactions, and the ledger:
        ``next`` (the least ingest id not given out), ``streams`` (stream: its newest batch
        and that batch's ingest id) and ``consumed`` (stream: the log number through which
        its files have left new data)."""
        text = fs.read_text(self.spark, self.pointer)
        return {"through": -1, "live": [], "next": 0, "streams": {}, "consumed": {}} | (json.loads(text) if text else {})

    def _point(self, **changes) -> None:
        fs.write_text(self.spark, self.pointer, json.dumps(self._held() | changes))

    def state(self) -> tuple[int, tuple[int, ...]]:
        """(K, live compactions) of the pointer."""
        held = self._held()
        return int(held["through"]), tuple(held["live"])

    def ingest_id(self, stream: str, batch: int) -> int:
        """The ingest id of a stream's batch (S13). The store gives out ids, upwards and never
        one that it has had, and remembers each stream's newest batch. So a batch that is run
        again finds the id that it had and overwrites itself, and a stream that starts anew (its
        checkpoint was lost, its batches begin at 0 again) gets ids above K: its facts are
        visible and overwrite nobody's. The ledger is written before the batch.

        Only a stream's newest batch can be run again. One older than that means that the
        checkpoint was put back to an earlier state; that raises."""
        held = self._held()
        newest, known = held["streams"].get(stream, (-1, -1))
        if batch == newest:
            return known
        if batch < newest:
            raise StaleCheckpointError(f"stream {stream} is at batch {batch}, master has its batch {newest}: the checkpoint is older than master")
        given = max([held["next"] - 1, held["through"], *self._dirs()]) + 1
        self._point(next=given + 1, streams=held["streams"] | {stream: (batch, given)})
        return given

    def consumed(self, stream: str) -> int:
        """The log number through which a stream's files have left new data."""
        return int(self._held()["consumed"].get(stream, -1))

    def set_consumed(self, stream: str, through: int) -> None:
        self._point(consumed=self._held()["consumed"] | {stream: through})

    def compacted_through(self) -> int:
        return self.state()[0]

    def master_path(self) -> str:
        return self.master

    def create(self) -> "FactStore":
        fs.mkdirs(self.spark, self.new_path)
        fs.mkdirs(self.spark, self.master)
        return self

    # reads
    def read_new(self) -> DataFrame:
        return scan_facts(self.spark, self.new_path)

    def visible(self, state: tuple[int, tuple[int, ...]] | None = None) -> Column:
        """Partition predicate selecting the live facts for a pointer's state."""
        k, live = self.state() if state is None else state
        ing = F.col("ingest_id")
        return (ing > k) | ing.isin(*live) if live else ing > k

    def read_master(self) -> DataFrame:
        """The live facts. The pointer is read before the files are listed and again
        after; if a compaction committed in between, both are read again, so the
        listing always has the parts that the pointer names."""
        for _ in range(100):
            state = self.state()
            listed = scan_facts(self.spark, self.master, S.MASTER)
            if self.state() == state:
                return listed.where(self.visible(state))
        raise RuntimeError("compactions kept committing while master was listed")

    def batch_ids(self) -> list[int]:
        """Live ingest ids in master (from the directory listing, no data read)."""
        k, live = self.state()
        return sorted(i for i in self._dirs() if i > k or i in live)

    # writes
    def append_new(self, facts: DataFrame) -> None:
        append_new(facts, self.new_path)

    def absorb(self, shredded: DataFrame, ingest_id: int) -> None:
        """Write shredded facts of one ingest batch into master.

        Narrow: no shuffle, each input task writes its own files; compaction merges
        small files later. Dynamic partition overwrite makes a replay of the same
        ``ingest_id`` replace its earlier output."""
        if ingest_id < 0:
            raise ValueError("ingest ids are >= 0; negative ids are compactions")
        self._write(shredded.withColumn("ingest_id", F.lit(int(ingest_id)).cast("bigint")))

    def reject(self, facts: DataFrame, ingest_id: int) -> None:
        """Keep facts that cannot be routed, with their ``reason``; a replay of the
        batch replaces them."""
        facts.write.mode("overwrite").parquet(f"{self.rejected}/ingest_id={int(ingest_id)}")

    def read_rejected(self) -> DataFrame:
        """Rejected facts with ``reason`` and ``ingest_id``."""
        schema = S.T.StructType([*S.FACT.fields, S.T.StructField("reason", S.T.StringType()), S.T.StructField("ingest_id", S.T.LongType())])
        return self.spark.read.schema(schema).parquet(self.rejected)

    def _write(self, df: DataFrame) -> None:
        with open_writers(df.sparkSession):  # a task meets six kinds and one ingest id at most
            (
                df.select(*FACT_COLUMNS, *S.PARTITION_COLUMNS)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*S.PARTITION_COLUMNS)
                .parquet(self.master)
            )

    def _dirs(self, ids: list[int] | None = None) -> dict[int, list[str]]:
        """Partition folders by ingest id (of ``ids``, or all)."""
        out: dict[int, list[str]] = {}
        for d in fs.glob_dirs(self.spark, f"{self.master}/unit_id=*/property_id=*/ingest_id=*"):
            i = int(d.rstrip("/").rsplit("ingest_id=", 1)[1])
            if ids is None or i in ids:
                out.setdefault(i, []).append(d)
        return out

    def _files(self, ids: list[int]) -> int:
        one_of = "{" + ",".join(map(str, ids)) + "}"
        return fs.count_paths(self.spark, f"{self.master}/unit_id=*/property_id=*/ingest_id={one_of}/part-*")

    def consolidate(self, target_file_bytes: int = TARGET_FILE_BYTES, growth: float = 2.0) -> dict:
        """Merge the ingest batches written since the last compaction, and earlier
        compactions, into few large files (S12); contents unchanged.

        Earlier compactions are taken in from the smallest up, as long as each is at
        most ``growth`` times what is merged already. So those left differ by that
        factor, there are only logarithmically many of them, and a fact is rewritten
        logarithmically often.

        The parts are range-partitioned on ``(unit_id, property_id, time, fact hash,
        row id)``, into as many as ``target_file_bytes`` asks for, and more where a task would sort
        over ``TASK_FACTS`` facts: a big kind is spread over many tasks in proportion to its size, a
        small kind lands in one file, and even a hot group of identical facts (one
        time, one hash) is split by the row id. Files come out sorted by time (tight
        min/max statistics for pushdown). The compaction ``-(K' + 2)`` is checked row
        for row (Parquet footers) before the pointer moves to K'. Folders that no
        pointer names any more (merged before the last compaction, or left by an
        interrupted one) are removed first. One writer at a time is assumed (the
        workflow runs ingest and compaction in sequence)."""
        spark = self.spark
        k_old, live = self.state()
        found = self._dirs()
        for i, dirs in found.items():
            if 0 <= i <= k_old or (i < 0 and i not in live):
                for d in dirs:
                    fs.delete(spark, d)
        new_ids = sorted(i for i in found if i > k_old)
        if not new_ids:
            return {"rows": 0, "batches": 0, "files_before": 0, "files_after": 0}
        size_of = {i: sum(fs.total_bytes(spark, d) for d in found.get(i, ())) for i in [*new_ids, *live]}
        merged, size = list(new_ids), sum(size_of[i] for i in new_ids)
        for i in sorted(live, key=lambda x: size_of[x]):
            if size_of[i] > growth * size:
                break
            merged.append(i)
            size += size_of[i]
        k_new = new_ids[-1]
        target = -(k_new + 2)
        parts = scan_facts(spark, self.master, S.MASTER).where(F.col("ingest_id").isin(*merged))
        files_before = self._files(merged)
        # files say little of memory: facts that repeat strings take a few bytes there, hundreds in a sort
        before, text = parts.agg(F.count(F.lit(1)), F.coalesce(F.sum(text_bytes()), F.lit(0))).first()
        n_parts = max(1, math.ceil(size / target_file_bytes), math.ceil(before / TASK_FACTS), math.ceil(text / TASK_TEXT_BYTES))
        secs = F.col("pedigree.true_as_of_secs")
        self._write(
            parts.repartitionByRange(
                n_parts,
                "unit_id",
                "property_id",
                secs,
                F.xxhash64("dataunit", "pedigree"),
                F.monotonically_increasing_id(),
            )
            .sortWithinPartitions("unit_id", "property_id", secs)
            .withColumn("ingest_id", F.lit(target).cast("bigint"))
        )
        # a fresh scan: the listing of ``parts`` predates the compaction's files
        after = scan_facts(spark, self.master, S.MASTER).where(F.col("ingest_id") == target).count()
        if before != after:
            raise RuntimeError(f"consolidate: {before} rows in its parts, {after} compacted; pointer not moved")
        left = [i for i in live if i not in merged]
        self._point(through=k_new, live=[*left, target])
        return {"rows": after, "batches": len(new_ids), "files_before": files_before, "files_after": self._files([target])}
