"""Column-level functions: fact builders, URL normalization, time buckets."""

from lamina.functions.buckets import day_bucket, granularity_array, hour_bucket, month_bucket, week_bucket
from lamina.functions.facts import (
    flatten,
    make_equiv,
    make_pageview,
    property_id,
    set_nested,
    unit_id,
    with_target,
)
from lamina.functions.urls import normalize_url

__all__ = [
    "day_bucket",
    "flatten",
    "granularity_array",
    "hour_bucket",
    "make_equiv",
    "make_pageview",
    "month_bucket",
    "normalize_url",
    "property_id",
    "set_nested",
    "unit_id",
    "week_bucket",
    "with_target",
]
