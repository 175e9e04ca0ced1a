"""Column builders for facts (S1), the arm tags (P1), nested replacement (P5)
and the flat projection used for reporting and comparisons.

All functions return Column expressions: they run inside whole-stage codegen
and work on any DataFrame that holds the raw values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina import schema as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def user_person(user_id) -> Column:
    """PersonID for a numeric user id."""
    return F.struct(
        F.lit(S.PERSON_USER_ID).cast("tinyint").alias("kind"),
        F.lit(None).cast("string").alias("cookie"),
        _c(user_id).cast("bigint").alias("user_id"),
    )


def cookie_person(cookie) -> Column:
    """PersonID for a cookie."""
    return F.struct(
        F.lit(S.PERSON_COOKIE).cast("tinyint").alias("kind"),
        _c(cookie).cast("string").alias("cookie"),
        F.lit(None).cast("bigint").alias("user_id"),
    )


def url_page(url) -> Column:
    """PageID for a URL."""
    return F.struct(F.lit(S.PAGE_URL).cast("tinyint").alias("kind"), _c(url).cast("string").alias("url"))


def pedigree(secs, source="SELF", system="page_view") -> Column:
    """Pedigree: when (epoch seconds) and where a fact comes from."""
    src = F.lit(source) if isinstance(source, str) and source in S.SOURCE_CODES else _c(source)
    sysc = F.lit(system) if isinstance(system, str) and system in S.SYSTEM_CODES else _c(system)
    return F.struct(
        _c(secs).cast("int").alias("true_as_of_secs"),
        src.alias("source"),
        sysc.alias("system"),
    )


def _unit(person_property=None, page_property=None, equiv=None, page_view=None) -> Column:
    def arm(value, dtype):
        return value if value is not None else F.lit(None).cast(dtype)

    return F.struct(
        arm(person_property, S.PERSON_PROPERTY).alias("person_property"),
        arm(page_property, S.PAGE_PROPERTY).alias("page_property"),
        arm(equiv, S.EQUIV_EDGE).alias("equiv"),
        arm(page_view, S.PAGE_VIEW_EDGE).alias("page_view"),
    )


def page_view_unit(person, page, nonce) -> Column:
    return _unit(
        page_view=F.struct(
            _c(person).alias("person"), _c(page).alias("page"), _c(nonce).cast("bigint").alias("nonce")
        )
    )


def page_view_arm(page_view) -> Column:
    """The union holding an existing page-view arm, cast to the declared schema."""
    return _unit(page_view=_c(page_view)).cast(S.DATAUNIT)


def equiv_unit(id1, id2) -> Column:
    return _unit(equiv=F.struct(_c(id1).alias("id1"), _c(id2).alias("id2")))


def page_property_unit(page, page_views) -> Column:
    return _unit(
        page_property=F.struct(
            _c(page).alias("id"),
            F.struct(_c(page_views).cast("int").alias("page_views")).alias("property"),
        )
    )


def person_property_unit(person, full_name=None, gender=None, location=None) -> Column:
    """One person property fact; exactly one of the three values should be given."""
    none_s = F.lit(None).cast("string")
    loc = location if location is not None else F.lit(None).cast(S.LOCATION)
    return _unit(
        person_property=F.struct(
            _c(person).alias("id"),
            F.struct(
                (_c(full_name) if full_name is not None else none_s).alias("full_name"),
                (_c(gender) if gender is not None else none_s).alias("gender"),
                loc.alias("location"),
            ).alias("property"),
        )
    )


def location(city=None, state=None, country=None) -> Column:
    none_s = F.lit(None).cast("string")
    return F.struct(
        (_c(city) if city is not None else none_s).alias("city"),
        (_c(state) if state is not None else none_s).alias("state"),
        (_c(country) if country is not None else none_s).alias("country"),
    )


def make_fact(pedigree_col: Column, unit_col: Column) -> list[Column]:
    """The two fact columns, cast to the declared schema."""
    return [pedigree_col.cast(S.PEDIGREE).alias("pedigree"), unit_col.cast(S.DATAUNIT).alias("dataunit")]


def make_pageview(user_id, url, secs) -> list[Column]:
    """Page view by a user at a URL: source SELF, system page_view, nonce 1."""
    return make_fact(pedigree(secs), page_view_unit(user_person(user_id), url_page(url), F.lit(1)))


def make_equiv(user_id1, user_id2) -> list[Column]:
    """Equivalence of two user ids, asserted at time 1000 (source SELF, system page_view)."""
    return make_fact(pedigree(F.lit(1000)), equiv_unit(user_person(user_id1), user_person(user_id2)))


# --- P1: arm tags -----------------------------------------------------------------


def arm_count(du: str = "dataunit") -> Column:
    """Number of non-null arms of the union (must be exactly 1)."""
    arms = ["person_property", "page_property", "equiv", "page_view"]
    return sum((F.col(f"{du}.{a}").isNotNull().cast("int") for a in arms), F.lit(0))


def unit_id(du: str = "dataunit") -> Column:
    """Tag of the active ``DataUnit`` arm (0 when none is set)."""
    return (
        F.when(F.col(f"{du}.person_property").isNotNull(), F.lit(S.UNIT_PERSON_PROPERTY))
        .when(F.col(f"{du}.page_property").isNotNull(), F.lit(S.UNIT_PAGE_PROPERTY))
        .when(F.col(f"{du}.equiv").isNotNull(), F.lit(S.UNIT_EQUIV))
        .when(F.col(f"{du}.page_view").isNotNull(), F.lit(S.UNIT_PAGE_VIEW))
        .otherwise(F.lit(0))
    )


def property_id(du: str = "dataunit") -> Column:
    """Second partition level: the value arm of property kinds, 0 for edges."""
    pp = f"{du}.person_property.property"
    return (
        F.when(
            F.col(f"{du}.person_property").isNotNull(),
            F.when(F.col(f"{pp}.full_name").isNotNull(), F.lit(S.PERSON_FULL_NAME))
            .when(F.col(f"{pp}.gender").isNotNull(), F.lit(S.PERSON_GENDER))
            .when(F.col(f"{pp}.location").isNotNull(), F.lit(S.PERSON_LOCATION))
            .otherwise(F.lit(0)),
        )
        .when(
            F.col(f"{du}.page_property").isNotNull(),
            F.when(F.col(f"{du}.page_property.property.page_views").isNotNull(), F.lit(S.PAGE_VIEWS)).otherwise(
                F.lit(0)
            ),
        )
        .otherwise(F.lit(0))
    )


def with_target(facts: DataFrame) -> DataFrame:
    """Add ``unit_id`` and ``property_id`` (P1) unless already present."""
    if "unit_id" in facts.columns:
        return facts
    return facts.withColumn("unit_id", unit_id()).withColumn("property_id", property_id())


def only_unit(facts: DataFrame, unit: int, prop: int | None = None) -> DataFrame:
    """Facts of one kind. Uses the ``unit_id``/``property_id`` columns when present
    (partition pruning on stored data; a cheap test on the raw union otherwise) and
    the arm tag expression when not.

    Operators filter on these columns rather than on arms of a rewritten union, so
    the optimizer never pushes a filter through a rewrite and evaluates it twice."""
    if "unit_id" in facts.columns:
        out = facts.where(F.col("unit_id") == unit)
        return out.where(F.col("property_id") == prop) if prop is not None else out
    out = facts.where(unit_id() == unit)
    return out.where(property_id() == prop) if prop is not None else out


# --- P5: nested replacement -------------------------------------------------------


def set_nested(du: Column, arm: str, path: str, value: Column) -> Column:
    """Replace ``arm.path`` inside the union column ``du``; other arms pass unchanged.

    Only the arm is rebuilt (``withField`` keeps a null arm null), so chained
    replacements stay linear in size. The union itself (required, never null) is
    rebuilt as a plain struct of its arms: the optimizer then resolves a later
    ``dataunit.<arm>...`` reference straight to the arm expression, and a filter
    pushed below the rewrite does not evaluate the other arms."""
    fields = []
    for f in S.DATAUNIT.fields:
        part = du.getField(f.name)
        if f.name == arm:
            part = part.withField(path, value)
        fields.append(part.alias(f.name))
    return F.struct(*fields)


# --- flat projection ----------------------------------------------------------------

# Subject persons: page_view.person, equiv.id1 or person_property.id.
_SUBJECT = {
    "page_view": "dataunit.page_view.person",
    "equiv": "dataunit.equiv.id1",
    "person_property": "dataunit.person_property.id",
}
_PAGE = {"page_view": "dataunit.page_view.page", "page_property": "dataunit.page_property.id"}


def _first(paths: dict, field: str) -> Column:
    cols = [F.col(f"{p}.{field}") for p in paths.values()]
    return F.coalesce(*cols) if len(cols) > 1 else cols[0]


FLAT_COLUMNS = [
    "unit_id",
    "property_id",
    "true_as_of_secs",
    "source",
    "system",
    "person_kind",
    "person_cookie",
    "person_user_id",
    "person2_kind",
    "person2_cookie",
    "person2_user_id",
    "page_kind",
    "page_url",
    "nonce",
    "page_views",
    "full_name",
    "gender",
    "city",
    "state",
    "country",
]


def flat_columns() -> list[Column]:
    """Flat, struct-free projection of a fact (one column per leaf, shared across arms)."""
    pv = "dataunit.person_property.property"
    return [
        unit_id().alias("unit_id"),
        property_id().alias("property_id"),
        F.col("pedigree.true_as_of_secs").cast("int").alias("true_as_of_secs"),
        F.col("pedigree.source").alias("source"),
        F.col("pedigree.system").alias("system"),
        _first(_SUBJECT, "kind").cast("int").alias("person_kind"),
        _first(_SUBJECT, "cookie").alias("person_cookie"),
        _first(_SUBJECT, "user_id").cast("bigint").alias("person_user_id"),
        F.col("dataunit.equiv.id2.kind").cast("int").alias("person2_kind"),
        F.col("dataunit.equiv.id2.cookie").alias("person2_cookie"),
        F.col("dataunit.equiv.id2.user_id").cast("bigint").alias("person2_user_id"),
        _first(_PAGE, "kind").cast("int").alias("page_kind"),
        _first(_PAGE, "url").alias("page_url"),
        F.col("dataunit.page_view.nonce").cast("bigint").alias("nonce"),
        F.col("dataunit.page_property.property.page_views").cast("int").alias("page_views"),
        F.col(f"{pv}.full_name").alias("full_name"),
        F.col(f"{pv}.gender").alias("gender"),
        F.col(f"{pv}.location.city").alias("city"),
        F.col(f"{pv}.location.state").alias("state"),
        F.col(f"{pv}.location.country").alias("country"),
    ]


def flatten(facts: DataFrame) -> DataFrame:
    return facts.select(*flat_columns())


def flat_person(col: str, prefix: str) -> list[Column]:
    """Flatten a PersonID struct column into ``<prefix>_kind/_cookie/_user_id``."""
    return [
        F.col(f"{col}.kind").cast("int").alias(f"{prefix}_kind"),
        F.col(f"{col}.cookie").alias(f"{prefix}_cookie"),
        F.col(f"{col}.user_id").cast("bigint").alias(f"{prefix}_user_id"),
    ]
