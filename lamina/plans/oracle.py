"""Independent SQL (DuckDB dialect) for every registered query.

The SQL restates the adapter and the operators over the driver tables; connected
components come from a recursive CTE (reachability, then the minimum), a method
unrelated to the Spark fixpoints. Columns carry the same names and types as the
Spark results.
"""

from __future__ import annotations

from lamina.functions.facts import FLAT_COLUMNS

FLAT_TYPES = {
    "unit_id": "INTEGER",
    "property_id": "INTEGER",
    "true_as_of_secs": "INTEGER",
    "source": "VARCHAR",
    "system": "VARCHAR",
    "person_kind": "INTEGER",
    "person_cookie": "VARCHAR",
    "person_user_id": "BIGINT",
    "person2_kind": "INTEGER",
    "person2_cookie": "VARCHAR",
    "person2_user_id": "BIGINT",
    "page_kind": "INTEGER",
    "page_url": "VARCHAR",
    "nonce": "BIGINT",
    "page_views": "INTEGER",
    "full_name": "VARCHAR",
    "gender": "VARCHAR",
    "city": "VARCHAR",
    "state": "VARCHAR",
    "country": "VARCHAR",
}
assert list(FLAT_TYPES) == FLAT_COLUMNS


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with a name for a value."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def sql_normalize_url(expr: str) -> str:
    """The URL rule restated step by step with string functions: cut at ``#`` and ``?``, take the
    authority after ``//``, its place after ``@``, the host before ``:``. Without ``jar:`` URLs, signed
    ports, a leading ``url:`` and a close look at addresses, which no table has."""
    port = "q = '' OR q = ':' OR (regexp_full_match(q, ':[0-9]+') AND coalesce(TRY_CAST(substr(q, 2) AS HUGEINT), 10::HUGEINT ** 12) <= 2147483647)"
    form = (
        f"CASE WHEN s IN ('http', 'https', 'ftp', 'file') AND ({port}) AND (NOT starts_with(p, '[') OR starts_with(p, h) AND regexp_full_match(h, '\\[[0-9A-Fa-f:.%]+\\]')) "
        "THEN s || '://' || h || CASE WHEN a IS NULL THEN c ELSE substr(c, 3 + length(a)) END "
        f"WHEN s = 'mailto' AND regexp_matches(r, '[^ \\t\\n]') THEN 'mailto://' || regexp_replace(r, '\\?[^?]*$', '') ELSE {expr} END"
    )
    steps = [
        ("t", f"regexp_replace({expr}, '^[\\x00- ]+|[\\x00- ]+$', '', 'g')"),
        ("s", "lower(regexp_extract(t, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"),
        ("r", "split_part(substr(t, length(s) + 2), '#', 1)"),
        ("c", "split_part(r, '?', 1)"),
        ("a", "CASE WHEN starts_with(c, '//') AND NOT starts_with(c, '////') THEN split_part(substr(c, 3), '/', 1) END"),
        ("p", "CASE coalesce(length(a) - length(replace(a, '@', '')), 2) WHEN 0 THEN a WHEN 1 THEN split_part(a, '@', 2) ELSE '' END"),
        ("h", "CASE WHEN starts_with(p, '[') THEN split_part(p, ']', 1) || ']' ELSE split_part(p, ':', 1) END"),
        ("q", "substr(p, length(h) + 1)"),
    ]
    for name, value in reversed(steps):
        form = _let(name, value, form)
    return f"({form})"


def flat_select(src: str, **vals: str) -> str:
    cols = ", ".join(f"CAST({vals.get(c, 'NULL')} AS {t}) AS {c}" for c, t in FLAT_TYPES.items())
    return f"SELECT {cols} FROM {src}"


# Persons are numbers here: a user id, or for a cookie its number less this, so that
# cookies come before users and among themselves in the order of their text.
COOKIE_BASE = 10**12


def kind(expr: str) -> str:
    return f"CASE WHEN {expr} < 0 THEN 1 WHEN {expr} >= 0 THEN 2 END"


def cookie(expr: str) -> str:
    return f"CASE WHEN {expr} < 0 THEN 'c' || lpad(CAST({expr} + {COOKIE_BASE} AS VARCHAR), 12, '0') END"


def user(expr: str) -> str:
    return f"CASE WHEN {expr} >= 0 THEN {expr} END"


def person(expr: str, prefix: str) -> str:
    """A person flattened to ``<prefix>_kind/_cookie/_user_id``."""
    return (
        f"CAST({kind(expr)} AS INTEGER) AS {prefix}_kind, "
        f"CAST({cookie(expr)} AS VARCHAR) AS {prefix}_cookie, CAST({user(expr)} AS BIGINT) AS {prefix}_user_id"
    )


def who(expr: str, prefix: str = "person") -> dict[str, str]:
    """The same as values of :func:`flat_select`."""
    return {f"{prefix}_kind": kind(expr), f"{prefix}_cookie": cookie(expr), f"{prefix}_user_id": user(expr)}


def _facts(url) -> str:
    pv = flat_select(
        "pvr",
        unit_id="4",
        property_id="0",
        true_as_of_secs="secs",
        source="'SELF'",
        system="'page_view'",
        page_kind="1",
        page_url=url("raw_url"),
        nonce="nonce",
        **who("user_id"),
    )
    eq = flat_select(
        "eqf",
        unit_id="3",
        property_id="0",
        true_as_of_secs="secs",
        source="'SELF'",
        system="'page_view'",
        **who("a"),
        **who("b", "person2"),
    )
    prop = dict(true_as_of_secs="0", source="'BACKTYPE'", system="'external_data'")
    pp = flat_select(
        "pprop", unit_id="2", property_id="1", page_kind="1", page_url=url("raw_url"), page_views="page_views", **prop
    )
    customer = dict(person_kind="2", person_user_id="c_custkey", **prop)
    p1 = flat_select("people", unit_id="1", property_id="1", full_name="c_name", **customer)
    p2 = flat_select(
        "people",
        unit_id="1",
        property_id="2",
        gender="CASE WHEN c_custkey % 2 = 1 THEN 'MALE' ELSE 'FEMALE' END",
        **customer,
    )
    p3 = flat_select("people", unit_id="1", property_id="3", country="n_name", **customer)
    return "\nUNION ALL\n".join([pv, eq, pp, p1, p2, p3])


BASE = f"""
WITH RECURSIVE
ev_all AS (
  SELECT event_id, user_id, event_type, value, props,
         CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS secs
  FROM events),
eqf AS (
  SELECT user_id AS a, CASE k WHEN 8 THEN user_id + 1 WHEN 9 THEN user_id WHEN 7 THEN -{COOKIE_BASE}
           ELSE event_id - (CASE WHEN event_id % 8 = 0 THEN event_id % 16 ELSE 0 END) - {COOKIE_BASE} END AS b, secs
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM ev_all WHERE event_type = 'error') e),
npages AS (SELECT coalesce(max(page_id), 0) + 1 AS np FROM pages),
eq AS (SELECT DISTINCT a, b FROM eqf),
bi AS (SELECT a, b FROM eq WHERE a <> b UNION SELECT b, a FROM eq WHERE a <> b),
reach AS (
  SELECT a AS n, a AS r FROM bi
  UNION SELECT bi.b, reach.r FROM reach JOIN bi ON bi.a = reach.n),
canon AS (SELECT n AS id, min(r) AS canonical_id FROM reach GROUP BY n HAVING min(r) <> n),
st AS (
  SELECT a, least(a, min(b)) AS m, (a > min(b) AND min(b) <> max(b)) AS progress,
         count(*) AS neighbors, min(b) AS min_b, max(b) AS max_b
  FROM bi GROUP BY a),
rel AS (
  SELECT * FROM (
    SELECT bi.a AS node, st.m, bi.b AS x, st.progress FROM bi JOIN st ON bi.a = st.a
    UNION ALL SELECT a, m, a, progress FROM st) t
  WHERE x <> m),
r1 AS (SELECT m AS a, x AS b, bool_or(progress) AS progress FROM rel GROUP BY 1, 2),
ev AS (SELECT user_id, event_id, secs FROM ev_all WHERE event_type IN ('view', 'click')),
raw AS (
  SELECT user_id, event_id, secs FROM ev
  UNION ALL SELECT user_id, event_id, secs FROM ev WHERE event_id % 10 = 0
  UNION ALL SELECT coalesce(c.canonical_id, e.user_id), e.event_id, e.secs
            FROM ev e LEFT JOIN canon c ON c.id = e.user_id WHERE e.event_id % 7 = 0),
pvr AS (
  SELECT r.user_id, p.url AS raw_url, r.secs, r.event_id AS nonce
  FROM raw r CROSS JOIN npages LEFT JOIN pages p ON p.page_id = r.event_id % np),
pvn AS (
  SELECT v.user_id AS raw_user_id, c.canonical_id,
         coalesce(c.canonical_id, v.user_id) AS user_id,
         {sql_normalize_url('v.raw_url')} AS url, v.raw_url, v.secs, v.nonce
  FROM pvr v LEFT JOIN canon c ON c.id = v.user_id),
uniq AS (SELECT DISTINCT user_id, url, secs, nonce FROM pvn),
hourly AS (
  SELECT url, CAST(secs // 3600 AS INTEGER) AS bucket, CAST(count(*) AS BIGINT) AS pageviews
  FROM uniq GROUP BY 1, 2),
gran AS (
  SELECT url, 'h' AS granularity, bucket, pageviews FROM hourly
  UNION ALL SELECT url, 'd', CAST(bucket // 24 AS INTEGER), pageviews FROM hourly
  UNION ALL SELECT url, 'w', CAST(bucket // 24 // 7 AS INTEGER), pageviews FROM hourly
  UNION ALL SELECT url, 'm', CAST(bucket // 24 // 28 AS INTEGER), pageviews FROM hourly),
view AS (
  SELECT url, granularity, bucket, CAST(sum(pageviews) AS BIGINT) AS pageviews
  FROM gran GROUP BY 1, 2, 3),
pcount AS (SELECT event_id % np AS page_id, count(*) AS n FROM ev CROSS JOIN npages GROUP BY 1),
pprop AS (
  SELECT p.url AS raw_url, CAST(coalesce(c.n, 0) AS INTEGER) AS page_views
  FROM pages p LEFT JOIN pcount c ON c.page_id = p.page_id),
people AS (
  SELECT c.c_custkey, c.c_name, n.n_name
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
facts AS (
{_facts(lambda e: e)}),
nfacts AS (
{_facts(sql_normalize_url)}),
ufacts AS (
{flat_select("uniq", unit_id="4", property_id="0", true_as_of_secs="secs", source="'SELF'",
             system="'page_view'", page_kind="1", page_url="url", nonce="nonce", **who("user_id"))}),
nviews AS (
{flat_select("pvn", unit_id="4", property_id="0", true_as_of_secs="secs", source="'SELF'",
             system="'page_view'", page_kind="1", page_url="url", nonce="nonce", **who("user_id"))})
"""

FACTS = f"{BASE} SELECT * FROM facts"
VIEW = f"{BASE} SELECT url, granularity, bucket, pageviews FROM view"
CANON = f"{BASE} SELECT {person('id', 'id')}, {person('canonical_id', 'canonical')} FROM canon"
EDGES_R1 = f"{BASE} SELECT {person('a', 'a')}, {person('b', 'b')} FROM r1"
LEGAL = "(1, 1), (1, 2), (1, 3), (2, 1), (3, 0), (4, 0)"


def _q(select: str) -> str:
    return f"{BASE} {select}"


#: Spellings of every page's URL by number, as (text, what it is normalized to): both are literal. ``u``
#: is the URL, ``cut`` its part before the query and fragment, ``base`` and ``path`` its normal form.
URL_SPELLINGS = [
    ("cut || '/a/./b/../.'", "base || path || '/a/./b/../.'"),
    ("'url:' || u", "base || path"),
    ("chr(1) || ' ' || u || chr(31)", "base || path"),
    ("'jar:' || cut || '!/a/../B.class'", "'jar://' || cut || '!/a/../B.class'"),
    ("'jar:' || cut", "'jar:' || cut"),
    ("'MailTo:' || page_id || '@x.org?subject=a?b'", "'mailto://' || page_id || '@x.org?subject=a'"),
    ("'file:/srv/' || page_id || '/../f'", "'file:///srv/' || page_id || '/../f'"),
    ("'file:f' || page_id || '?x'", "'file://f' || page_id"),
    ("scheme || '://a@b@' || host || path", "scheme || '://' || path"),
    ("scheme || '://' || host || ':4294967296/' || page_id", "scheme || '://' || host || ':4294967296/' || page_id"),
    ("scheme || '://' || host || ':+81/' || page_id", "base || '/' || page_id"),
    ("'FTP://u:p@H.org:21/' || page_id || ';type=i?q'", "'ftp://H.org/' || page_id || ';type=i'"),
    ("'http:////' || page_id", "'http://////' || page_id"),
    ("scheme || '://[fe80::1%25e0]:80/' || page_id", "scheme || '://[fe80::1%25e0]/' || page_id"),
    ("scheme || '://[12345::1]/' || page_id || '?q'", "scheme || '://[12345::1]/' || page_id || '?q'"),
]


def _url_spellings() -> str:
    rows = " UNION ALL ".join(f"SELECT page_id, {k} AS spelling, {text} AS url, {norm} AS normalized_url FROM p" for k, (text, norm) in enumerate(URL_SPELLINGS))
    return f"""
WITH c AS (SELECT page_id, url AS u, split_part(split_part(url, '#', 1), '?', 1) AS cut FROM pages),
s AS (SELECT *, split_part(cut, '://', 1) AS scheme, split_part(split_part(cut, '://', 2), '/', 1) AS host FROM c),
p AS (SELECT *, scheme || '://' || host AS base, substr(cut, length(scheme || '://' || host) + 1) AS path FROM s)
SELECT page_id, CAST(spelling AS INTEGER) AS spelling, url, normalized_url FROM ({rows})"""


def oracle_sql() -> dict[str, str]:
    return {
        # sources and sinks
        "make_facts": FACTS,
        "append_new": FACTS,
        "scan_facts": FACTS,
        "scan_unit": _q("SELECT * FROM facts WHERE unit_id = 4"),
        "scan_with_path": _q(
            "SELECT *, CASE WHEN property_id = 0 THEN CAST(unit_id AS VARCHAR) "
            "ELSE CAST(unit_id AS VARCHAR) || '/' || CAST(property_id AS VARCHAR) END AS rel_path FROM facts"
        ),
        "scan_tolerant": FACTS,
        "scan_tolerant_damaged": _q(
            "SELECT unit_id, property_id, CAST(count(*) AS BIGINT) AS facts, CAST(8 AS BIGINT) AS files, CAST(2 AS BIGINT) AS lost, "
            "CAST((SELECT count(*) FROM facts) AS BIGINT) AS rows_read FROM facts GROUP BY 1, 2"
        ),
        "ingest_snapshot": FACTS,
        "ingest_consume": FACTS,
        "shred": FACTS,
        "validate_target": _q(
            "SELECT unit_id, property_id, CAST(count(*) AS BIGINT) AS facts, "
            f"(unit_id, property_id) IN ({LEGAL}) AS valid FROM facts GROUP BY 1, 2"
        ),
        "validate_target_illegal": _q(
            f"SELECT unit_id, property_id, CAST(count(*) AS BIGINT) AS facts, (unit_id, property_id) IN ({LEGAL}) AS valid "
            "FROM (SELECT unit_id, property_id FROM facts UNION ALL SELECT 0, 0 FROM eqf) GROUP BY 1, 2"
        ),
        "absorb": FACTS,
        "consolidate": FACTS,
        "ingest": FACTS,
        "stage_edges": CANON,
        "stage_facts": _q("SELECT * FROM nfacts"),
        "reset_workspace": FACTS,
        # projections and row functions
        "fact_target": _q("SELECT unit_id, property_id, CAST(count(*) AS BIGINT) AS facts FROM facts GROUP BY 1, 2"),
        "equiv_pairs": _q(f"SELECT {person('a', 'a')}, {person('b', 'b')} FROM eqf"),
        "normalize_url": f"SELECT url, {sql_normalize_url('url')} AS normalized_url FROM pages",
        "normalize_url_spellings": _url_spellings(),
        "normalize_urls": _q("SELECT * FROM nfacts"),
        "set_nested": _q("SELECT * FROM nfacts WHERE unit_id = 4"),
        "is_url_page": _q("SELECT * FROM facts WHERE unit_id = 4 AND page_kind = 1"),
        "drop_self_loops": _q(f"SELECT {person('a', 'a')}, {person('b', 'b')} FROM eqf WHERE a <> b"),
        "progress_edges": _q(f"SELECT {person('a', 'a')}, {person('b', 'b')} FROM r1 WHERE progress"),
        "swap_pair": _q(f"SELECT {person('b', 'id')}, {person('a', 'canonical')} FROM r1"),
        "key_by_person": _q(
            f"SELECT {person('user_id', 'person')}, CAST(secs AS INTEGER) AS true_as_of_secs, "
            "raw_url AS page_url, nonce FROM pvr"
        ),
        "hour_bucket": _q(
            f"SELECT url, CAST({user('user_id')} AS BIGINT) AS user_id, CAST(secs // 3600 AS INTEGER) AS hour FROM uniq"
        ),
        "coarse_buckets": _q(
            "SELECT hour, CAST(hour // 24 AS INTEGER) AS day, CAST(hour // 24 // 7 AS INTEGER) AS week, "
            "CAST(hour // 24 // 28 AS INTEGER) AS month "
            "FROM (SELECT DISTINCT CAST(secs // 3600 AS INTEGER) AS hour FROM uniq) h"
        ),
        "visit_keys": _q("SELECT url, CAST(secs // 3600 AS INTEGER) AS bucket FROM uniq"),
        "view_row": VIEW,
        "resolve_person": _q(
            f"SELECT {person('raw_user_id', 'person')}, {person('user_id', 'resolved')}, "
            "CAST(secs AS INTEGER) AS true_as_of_secs, url AS page_url, nonce FROM pvn"
        ),
        # row generators
        "bidirectional_edges": _q(f"SELECT {person('a', 'a')}, {person('b', 'b')} FROM bi"),
        "relink_to_smallest": _q(
            f"SELECT {person('node', 'node')}, {person('m', 'm')}, {person('x', 'x')}, progress FROM rel"
        ),
        "granularity_rows": _q("SELECT url, granularity, bucket, pageviews FROM gran"),
        # joins
        "person_left_join": _q(
            f"SELECT {person('v.user_id', 'person')}, {person('c.canonical_id', 'canonical')}, "
            "CAST(v.secs AS INTEGER) AS true_as_of_secs, v.raw_url AS page_url, v.nonce "
            "FROM pvr v LEFT JOIN canon c ON c.id = v.user_id"
        ),
        "normalize_user_ids": _q("SELECT * FROM nviews"),
        # aggregation and distinct
        "neighbors_by_node": _q(
            f"SELECT {person('a', 'node')}, CAST(neighbors AS BIGINT) AS neighbors, "
            f"{person('min_b', 'min')}, {person('max_b', 'max')} FROM st"
        ),
        "smallest_in_group": _q(f"SELECT {person('a', 'node')}, {person('m', 'smallest')} FROM st"),
        "group_progress": _q(f"SELECT {person('a', 'node')}, progress FROM st"),
        "distinct_flagged_edges": _q(
            f"SELECT DISTINCT {person('m', 'a')}, {person('x', 'b')}, progress FROM rel"
        ),
        "distinct_edges": EDGES_R1,
        "dedup_pageviews": _q("SELECT * FROM ufacts"),
        "hourly_rollup": _q("SELECT url, bucket, pageviews FROM hourly"),
        "granularity_sum": VIEW,
        "progress_count": _q(
            "SELECT CAST(count(*) AS BIGINT) AS edges, CAST(count(*) FILTER (WHERE progress) AS BIGINT) "
            "AS progress_edges FROM r1"
        ),
        "pageview_batch_view": VIEW,
        # sort and cache
        "sort_facts": _q("SELECT * FROM ufacts"),
        "sort_view": VIEW,
        "cache_view": VIEW,
        # iteration and workflow
        "equiv_round": _q(f"SELECT {person('a', 'a')}, {person('b', 'b')}, progress FROM r1"),
        "equiv_fixpoint": _q(f"SELECT {person('canonical_id', 'a')}, {person('id', 'b')} FROM canon"),
        "canonical_ids": CANON,
        "batch_workflow": VIEW,
        # increments: the same as from all facts at once
        "canonical_ids_live": CANON,
        "dedup_pageviews_live": _q("SELECT * FROM ufacts"),
        "pageview_batch_view_live": VIEW,
    }
