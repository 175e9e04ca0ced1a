"""URL normalization over whole fact datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina import schema as S
from lamina.functions.facts import set_nested
from lamina.functions.urls import normalize_url


def _normalized(page_path: str):
    page = F.col(page_path)
    return F.when(page.getField("kind") == S.PAGE_URL, normalize_url(page.getField("url"))).otherwise(
        page.getField("url")
    )


def normalize_urls(facts: DataFrame) -> DataFrame:
    """Normalize the URL of page views and page properties; every other fact passes
    unchanged, and so do URLs that do not parse. Narrow: no shuffle, one codegen stage."""
    du = F.col("dataunit")
    du = set_nested(du, "page_view", "page.url", _normalized("dataunit.page_view.page"))
    du = set_nested(du, "page_property", "id.url", _normalized("dataunit.page_property.id"))
    return facts.withColumn("dataunit", du)
