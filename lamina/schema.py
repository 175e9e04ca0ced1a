"""The fact schema.

A fact is one row with two struct columns (required: checked by validation, since
Parquet reads make every column nullable), ``pedigree`` and ``dataunit``.
``dataunit`` is a tagged union: exactly one of its four arms is non-null. Stored
master data adds the partition columns ``unit_id`` and ``property_id`` (the arm
tags, see :mod:`lamina.functions.facts`) and ``ingest_id``.

Unions become structs whose first field is the arm tag (``kind``), so that the
struct order Spark uses for ``min``/``least``/``orderBy`` is the union order:
every cookie sorts before every user id.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Arm tags of the unions. They must equal the field numbers of the
# fact model because partition paths and orderings are derived from them.
PERSON_COOKIE = 1
PERSON_USER_ID = 2
PAGE_URL = 1

UNIT_PERSON_PROPERTY = 1
UNIT_PAGE_PROPERTY = 2
UNIT_EQUIV = 3
UNIT_PAGE_VIEW = 4

PERSON_FULL_NAME = 1
PERSON_GENDER = 2
PERSON_LOCATION = 3
PAGE_VIEWS = 1

# Enum names and their codes (order is by code, not by name).
SOURCE_CODES = {"SELF": 1, "BACKTYPE": 2}
SYSTEM_CODES = {"page_view": 1, "external_data": 2}
GENDER_CODES = {"MALE": 1, "FEMALE": 2}

# The legal (unit_id, property_id) partitions. Property kinds have a
# second level (the value arm), edge kinds have none (0).
LEGAL_TARGETS = [(1, 1), (1, 2), (1, 3), (2, 1), (3, 0), (4, 0)]

PERSON = T.StructType(
    [
        T.StructField("kind", T.ByteType(), True),
        T.StructField("cookie", T.StringType(), True),
        T.StructField("user_id", T.LongType(), True),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("kind", T.ByteType(), True),
        T.StructField("url", T.StringType(), True),
    ]
)

LOCATION = T.StructType(
    [
        T.StructField("city", T.StringType(), True),
        T.StructField("state", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
    ]
)

PERSON_PROPERTY_VALUE = T.StructType(
    [
        T.StructField("full_name", T.StringType(), True),
        T.StructField("gender", T.StringType(), True),
        T.StructField("location", LOCATION, True),
    ]
)

PAGE_PROPERTY_VALUE = T.StructType([T.StructField("page_views", T.IntegerType(), True)])

PERSON_PROPERTY = T.StructType(
    [
        T.StructField("id", PERSON, True),
        T.StructField("property", PERSON_PROPERTY_VALUE, True),
    ]
)

PAGE_PROPERTY = T.StructType(
    [
        T.StructField("id", PAGE, True),
        T.StructField("property", PAGE_PROPERTY_VALUE, True),
    ]
)

EQUIV_EDGE = T.StructType(
    [
        T.StructField("id1", PERSON, True),
        T.StructField("id2", PERSON, True),
    ]
)

PAGE_VIEW_EDGE = T.StructType(
    [
        T.StructField("person", PERSON, True),
        T.StructField("page", PAGE, True),
        T.StructField("nonce", T.LongType(), True),
    ]
)

DATAUNIT = T.StructType(
    [
        T.StructField("person_property", PERSON_PROPERTY, True),
        T.StructField("page_property", PAGE_PROPERTY, True),
        T.StructField("equiv", EQUIV_EDGE, True),
        T.StructField("page_view", PAGE_VIEW_EDGE, True),
    ]
)

PEDIGREE = T.StructType(
    [
        T.StructField("true_as_of_secs", T.IntegerType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("system", T.StringType(), True),
    ]
)

FACT = T.StructType(
    [
        T.StructField("pedigree", PEDIGREE, True),
        T.StructField("dataunit", DATAUNIT, True),
    ]
)

PARTITION_COLUMNS = ["unit_id", "property_id", "ingest_id"]

# Schema of a stored master dataset: facts plus partition columns.
MASTER = T.StructType(
    list(FACT.fields)
    + [
        T.StructField("unit_id", T.IntegerType(), True),
        T.StructField("property_id", T.IntegerType(), True),
        T.StructField("ingest_id", T.LongType(), True),
    ]
)

# Schema of a staged (vertically partitioned, no ingest batch) dataset.
STAGED = T.StructType(
    list(FACT.fields)
    + [
        T.StructField("unit_id", T.IntegerType(), True),
        T.StructField("property_id", T.IntegerType(), True),
    ]
)

EDGES = T.StructType([T.StructField("a", PERSON, True), T.StructField("b", PERSON, True)])

CANONICAL = T.StructType(
    [T.StructField("id", PERSON, True), T.StructField("canonical_id", PERSON, True)]
)
