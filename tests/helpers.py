"""Builders for small fact sets used by the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina import schema as S
from lamina.functions import facts as FF

P1, P2, P3 = "http://foo.com/post1", "http://foo.com/post2", "http://foo.com/post3"

# Reference fixture: page views (user, url, secs) and equivs (user, user).
FIXTURE_VIEWS = [
    (1, P1, 60),
    (3, P1, 62),
    (1, P1, 4000),
    (1, P2, 4000),
    (1, P2, 10000),
    (5, P3, 10600),
    (2, P1, 60),
    (2, P3, 62),
]
FIXTURE_EQUIVS = [(1, 3), (3, 5)]


def pageviews(spark, rows):
    df = spark.createDataFrame(rows, "user long, url string, secs int")
    return df.select(*FF.make_pageview(F.col("user"), F.col("url"), F.col("secs")))


def equivs(spark, rows):
    df = spark.createDataFrame(rows, "a long, b long")
    return df.select(*FF.make_equiv(F.col("a"), F.col("b")))


def fixture_facts(spark):
    return pageviews(spark, FIXTURE_VIEWS).unionByName(equivs(spark, FIXTURE_EQUIVS))


def user_edges(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    return df.select(FF.user_person("a").alias("a"), FF.user_person("b").alias("b"))


def user_pairs(df, a="a", b="b"):
    return sorted((r[0], r[1]) for r in df.select(f"{a}.user_id", f"{b}.user_id").collect())


def canon_map(df):
    return dict(user_pairs(df, "id", "canonical_id"))


__all__ = ["S", "P1", "P2", "P3"]
