"""A corpus pipeline: quality rules, toxicity, near duplicates, secrets, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but
the last return the columns of ``documents``. Every stage works on all rows that the
one before it kept.

* quality: rows that fail the base rules or repeat themselves go. Null and empty texts
  fail.
* toxicity: rows at or over their language's threshold go. The classifier is fitted on
  a bounded sample of the labelled rows among ``documents`` (see its module).
* near duplicates: one row of each component stays.
* secrets: rows stay, secrets are replaced by a mark, ``n_chars`` follows.
* packing: pieces of token sequences; the result of the pipeline.

Null ids, repeated rows and further columns are kept as the operators' modules say; an
empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import flat, near_dedup, packing, repetition, secret_scan, toxicity
from lamina.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    flat.on_workers(spark)
    return repetition.keep_good(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = toxicity.judge(docs, labels)
    verdict = judged.columns[-1]
    return judged.where(~judged[verdict]["toxic"]).drop(verdict)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("toxicity", clean), ("near_dedup", distinct), ("secrets", secrets), ("packing", pack)]

#: Suffix arrays, a trained model, similarity joins and token ids are beyond SQL; the
#: pipeline is tested against a brute-force version of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a Parquet table in the
    folder that the cluster shares."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    flat.on_workers(spark)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
