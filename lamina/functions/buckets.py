"""Time buckets.

Epoch-aligned integer buckets. The hour is seconds / 3600 truncated toward zero
(``div``), so -1 s is hour 0 and -3601 s is hour -1. Coarser buckets derive from the
hour: day = hour / 24, week = day / 7, "month" = day / 28 (not calendar months).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket widths.
HOUR_SECS = 60 * 60
HOURS_PER_DAY = 24
DAYS_PER_WEEK = 7
DAYS_PER_MONTH = 28

# Granularity tags of the batch view, in sort order.
GRANULARITIES = ["d", "h", "m", "w"]


def _div(col: Column, n: int) -> Column:
    return F.call_function("div", col, F.lit(n)).cast("int")


def hour_bucket(secs) -> Column:
    c = F.col(secs) if isinstance(secs, str) else secs
    return _div(c, HOUR_SECS)


def day_bucket(hour) -> Column:
    c = F.col(hour) if isinstance(hour, str) else hour
    return _div(c, HOURS_PER_DAY)


def week_bucket(hour) -> Column:
    return _div(day_bucket(hour), DAYS_PER_WEEK)


def month_bucket(hour) -> Column:
    return _div(day_bucket(hour), DAYS_PER_MONTH)


def granularity_array(hour) -> Column:
    """``array<struct<granularity, bucket>>`` of the four buckets of an hour."""
    c = F.col(hour) if isinstance(hour, str) else hour
    return F.array(
        F.struct(F.lit("h").alias("granularity"), c.cast("int").alias("bucket")),
        F.struct(F.lit("d").alias("granularity"), day_bucket(c).alias("bucket")),
        F.struct(F.lit("w").alias("granularity"), week_bucket(c).alias("bucket")),
        F.struct(F.lit("m").alias("granularity"), month_bucket(c).alias("bucket")),
    )
