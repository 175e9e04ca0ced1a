"""Facts from the driver tables (``events``, ``pages``, ``customer``, ``nation``).

* page views: view/click events; person = user id, page = URL of the page
  ``event_id % (largest page_id + 1)`` (a page without a row has no URL: the view keeps
  a null one, and :func:`views_without_page` counts them), nonce = event id, time =
  epoch seconds of ``ts``. Two kinds of redelivery give the dedup work: every 10th
  event again, and every 7th again under its canonical id.
* equiv edges: every error event links its user to another person (:func:`_linked`),
  by ``props.k``: one cookie that many users share (a hub), the next user, the user
  itself, or a cookie of the event; some events share that cookie.
* page properties: ``page_views`` = number of view/click events on the page.
* person properties: full name, gender and country (location) per customer.

Everything is a DataFrame over the tables; the canonical ids needed for the second
redelivery come from :func:`lamina.operators.identity.canonical_ids` over the equiv
facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import schema as S
from lamina.functions import facts as FF
from lamina.operators.identity import canonical_ids, equiv_pairs

# Fixed values of the adapter.
REDELIVER_EVERY = 10  # every 10th event is delivered twice
REDELIVER_CANONICAL_EVERY = 7  # every 7th again under the canonical id
HUB_K, NEXT_USER_K, SELF_K = 7, 8, 9  # props.k of edges to the hub, the next user, itself
COOKIE_SHARED = 16  # events 16 n and 16 n + 8 share a cookie
COOKIE_DIGITS = 12  # zero-padded, so cookies sort as their numbers do
VIEW_TYPES = ["view", "click"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(df: DataFrame, col: str):
    """Whole epoch seconds of a timestamp column (fraction dropped toward -inf),
    independent of the session time zone. ``TIMESTAMP_NTZ`` values are wall times
    read as UTC: days since the epoch from the wall date, plus the wall clock
    fields, so no time-zone conversion (and no DST shift) can enter."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
        return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return F.unix_seconds(c)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", "event_type", "value", "props", epoch_seconds(ev, "ts").alias("secs"))


def _linked(k, user, event):
    """The other person of an error event's edge."""
    number = F.when(k == HUB_K, F.lit(0)).when(event % (COOKIE_SHARED // 2) == 0, event - event % COOKIE_SHARED).otherwise(event)
    cookie = FF.cookie_person(F.concat(F.lit("c"), F.lpad(number.cast("string"), COOKIE_DIGITS, "0")))
    return F.when(k == NEXT_USER_K, FF.user_person(user + 1)).when(k == SELF_K, FF.user_person(user)).otherwise(cookie)


def equiv_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("event_type") == "error")
    other = _linked(F.get_json_object("props", "$.k").cast("bigint"), F.col("user_id"), F.col("event_id"))
    return ev.select(*FF.make_fact(FF.pedigree(F.col("secs")), FF.equiv_unit(FF.user_person("user_id"), other)))


def _page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", "url")


def _with_page(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number of their page: over all pages, whatever their count."""
    last = _page_urls(spark, sf_dir).agg(F.max("page_id")).first()[0] or 0
    return events.withColumn("page_id", F.col("event_id") % F.lit(last + 1))


def views_without_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n``: how many view/click events have a page without a row in ``pages``."""
    ev = _events(spark, sf_dir).where(F.col("event_type").isin(*VIEW_TYPES))
    missed = _with_page(ev, spark, sf_dir).join(_page_urls(spark, sf_dir), "page_id", "left_anti")
    return missed.agg(F.count(F.lit(1)).alias("n"))


def pageview_facts(spark: SparkSession, sf_dir: str, canon: DataFrame | None = None) -> DataFrame:
    """Page-view facts with both kinds of redelivery."""
    ev = (
        _events(spark, sf_dir)
        .where(F.col("event_type").isin(*VIEW_TYPES))
        .select(FF.user_person("user_id").alias("person"), "event_id", "secs")
    )
    if canon is None:
        canon = canonical_ids(equiv_pairs(equiv_facts(spark, sf_dir)))
    again = ev.where(F.col("event_id") % REDELIVER_EVERY == 0)
    c = canon.select(F.col("id").alias("_cid"), F.col("canonical_id").alias("_canonical"))
    under_canonical = (
        ev.where(F.col("event_id") % REDELIVER_CANONICAL_EVERY == 0)
        .join(c, F.col("person") == F.col("_cid"), "left")
        .select(F.coalesce("_canonical", "person").alias("person"), "event_id", "secs")
    )
    raw = ev.unionByName(again).unionByName(under_canonical)
    joined = _with_page(raw, spark, sf_dir).join(_page_urls(spark, sf_dir), "page_id", "left")
    return joined.select(
        *FF.make_fact(
            FF.pedigree(F.col("secs")),
            FF.page_view_unit(F.col("person"), FF.url_page(F.col("url")), F.col("event_id")),
        )
    )


def page_property_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``page_views`` property per page (0 for pages no event hits)."""
    ev = _events(spark, sf_dir).where(F.col("event_type").isin(*VIEW_TYPES))
    counts = _with_page(ev, spark, sf_dir).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    pages = _page_urls(spark, sf_dir).join(counts, "page_id", "left")
    return pages.select(
        *FF.make_fact(
            FF.pedigree(F.lit(0), "BACKTYPE", "external_data"),
            FF.page_property_unit(FF.url_page(F.col("url")), F.coalesce(F.col("n"), F.lit(0))),
        )
    )


def person_property_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three facts per customer: full name, gender (odd key MALE, even FEMALE) and
    location (country = nation name)."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    people = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    person = FF.user_person("c_custkey")
    gender = F.when(F.col("c_custkey") % 2 == 1, F.lit("MALE")).otherwise(F.lit("FEMALE"))
    units = F.array(
        FF.person_property_unit(person, full_name=F.col("c_name")).cast(S.DATAUNIT),
        FF.person_property_unit(person, gender=gender).cast(S.DATAUNIT),
        FF.person_property_unit(person, location=FF.location(country=F.col("n_name"))).cast(S.DATAUNIT),
    )
    return people.select(F.explode(units).alias("unit")).select(
        *FF.make_fact(FF.pedigree(F.lit(0), "BACKTYPE", "external_data"), F.col("unit"))
    )


def adapter_facts(spark: SparkSession, sf_dir: str, canon: DataFrame | None = None) -> DataFrame:
    """All new facts the driver tables yield."""
    eq = equiv_facts(spark, sf_dir)
    if canon is None:
        canon = canonical_ids(equiv_pairs(eq))
    return (
        pageview_facts(spark, sf_dir, canon)
        .unionByName(eq)
        .unionByName(page_property_facts(spark, sf_dir))
        .unionByName(person_property_facts(spark, sf_dir))
    )
