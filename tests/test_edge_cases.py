"""Edge cases of FIXTURES.md §3-§4."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import canon_map, equivs, pageviews, user_edges
from lamina import schema as S
from lamina.functions import buckets as B
from lamina.functions import facts as FF
from lamina.functions.urls import normalize_url
from lamina.operators import identity as I
from lamina.operators import pageviews as PV
from lamina.operators.urls import normalize_urls
from lamina.plans.oracle import sql_normalize_url
from lamina.sources import store as ST

URL_CASES = [
    ("http://foo.com:8080/p?q=1#f", "http://foo.com/p"),
    ("HTTP://Foo.com/P", "http://Foo.com/P"),
    ("http://u:p@foo.com/x", "http://foo.com/x"),
    ("http://foo.com", "http://foo.com"),
    ("http://foo.com?x=1/2", "http://foo.com"),
    ("http://foo.com:80#z", "http://foo.com"),
    ("http://foo.com:/x", "http://foo.com/x"),
    ("http://foo_bar.com/x", "http://foo_bar.com/x"),
    ("http://foo.com/a b?x", "http://foo.com/a b"),
    ("http://[::1]:80/x", "http://[::1]/x"),
    (" http://foo.com/t ", "http://foo.com/t"),
    ("foo", "foo"),
    ("", ""),
    ("http://foo.com:abc/x", "http://foo.com:abc/x"),
    ("custom://h/p?q", "custom://h/p?q"),
]


def test_normalize_url_cases(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(URL_CASES)], "i int, u string")
    got = {r.i: r.n for r in df.select("i", normalize_url("u").alias("n")).collect()}
    assert [got[i] for i in range(len(URL_CASES))] == [e for _, e in URL_CASES]


def test_normalize_url_sql_agrees():
    con = duckdb.connect()
    for u, expected in URL_CASES:
        lit = u.replace("'", "''")
        assert con.execute(f"SELECT {sql_normalize_url(chr(39) + lit + chr(39))}").fetchone()[0] == expected


def test_normalize_urls_page_property_only(spark):
    page = FF.url_page(F.lit("http://Foo.com:81/a?b=1"))
    df = spark.range(1).select(*FF.make_fact(FF.pedigree(F.lit(5), "BACKTYPE", "external_data"),
                                              FF.page_property_unit(page, F.lit(3))))
    facts = df.unionByName(equivs(spark, [(1, 2)]))
    out = normalize_urls(facts)
    urls = [r[0] for r in out.where("dataunit.page_property is not null").select("dataunit.page_property.id.url").collect()]
    assert urls == ["http://Foo.com/a"]
    eq = out.where("dataunit.equiv is not null")
    assert eq.count() == 1 and eq.where("dataunit.page_view is null and dataunit.page_property is null").count() == 1


@pytest.mark.parametrize(
    "pairs,expected",
    [
        ([(7, 7)], {}),
        ([(9, 8), (9, 8)], {9: 8}),
        ([(i, i + 1) for i in range(1, 16)], {i: 1 for i in range(2, 17)}),
        ([(1, i) for i in range(2, 12)], {i: 1 for i in range(2, 12)}),
        ([(20, i) for i in range(11, 20)], {i: 11 for i in range(12, 21)}),
        ([(1, 2), (3, 4)], {2: 1, 4: 3}),
        ([(1, 2), (2, 3), (3, 1)], {2: 1, 3: 1}),
        ([], {}),
    ],
)
def test_canonical_edge_cases(spark, pairs, expected):
    edges = user_edges(spark, pairs) if pairs else spark.createDataFrame([], S.EDGES)
    for method in ("star", "relink"):
        assert canon_map(I.canonical_ids(edges, method=method)) == expected


def test_chain_takes_six_relink_rounds(spark):
    edges = user_edges(spark, [(i, i + 1) for i in range(1, 16)])
    _, rounds = I.equiv_fixpoint(edges)
    assert rounds == 6


def test_cookies_sort_first(spark):
    df = spark.createDataFrame([("z", 1, 1, 2)], "c string, u1 long, ua long, ub long")
    edges = df.select(FF.cookie_person("c").alias("a"), FF.user_person("u1").alias("b")).unionByName(
        df.select(FF.user_person("ua").alias("a"), FF.user_person("ub").alias("b"))
    )
    for method, encode in (("star", False), ("relink", False), ("star", True), ("relink", True)):
        rows = I.canonical_ids(edges, method=method, encode=encode).select(
            "id.user_id", "canonical_id.kind", "canonical_id.cookie"
        ).collect()
        assert sorted(map(tuple, rows)) == [(1, 1, "z"), (2, 1, "z")]


def test_empty_canon_leaves_views(spark):
    views = pageviews(spark, [(1, "http://a.com/x", 5)])
    canon = spark.createDataFrame([], S.CANONICAL)
    out = I.normalize_user_ids(views, canon)
    assert [r[0] for r in out.select("dataunit.page_view.person.user_id").collect()] == [1]


def test_same_person_two_ids_collapse(spark):
    views = pageviews(spark, [(3, "http://a.com/x", 100), (5, "http://a.com/x", 100)])
    canon = I.canonical_ids(user_edges(spark, [(3, 5)]))
    assert PV.dedup_pageviews(I.normalize_user_ids(views, canon)).count() == 1


def test_dedup_keeps_distinct_pedigree_or_nonce(spark):
    base = pageviews(spark, [(1, "http://a.com/x", 100)])
    other_nonce = base.withColumn("dataunit", F.col("dataunit").withField("page_view.nonce", F.lit(2).cast("bigint")))
    other_secs = pageviews(spark, [(1, "http://a.com/x", 101)])
    other_src = base.withColumn("pedigree", F.col("pedigree").withField("source", F.lit("BACKTYPE")))
    other_sys = base.withColumn("pedigree", F.col("pedigree").withField("system", F.lit("external_data")))
    allv = base.unionByName(base).unionByName(other_nonce).unionByName(other_secs).unionByName(other_src).unionByName(other_sys)
    assert PV.dedup_pageviews(allv).count() == 5


def test_hour_bucket_truncates(spark):
    df = spark.createDataFrame([(s,) for s in [0, 3599, 3600, -1, -3600, -3601]], "s int")
    assert [r[0] for r in df.select(B.hour_bucket("s")).collect()] == [0, 0, 1, 0, -1, -1]


def test_coarse_buckets(spark):
    df = spark.createDataFrame([(h,) for h in [23, 24, 167, 168, 671, 672]], "hour int")
    rows = PV.coarse_buckets(df).collect()
    assert [r.day for r in rows] == [0, 1, 6, 7, 27, 28]
    assert [r.week for r in rows] == [0, 0, 0, 1, 3, 4]
    assert [r.month for r in rows] == [0, 0, 0, 0, 0, 1]


def test_fact_target(spark):
    person = FF.user_person(F.lit(1))
    units = [
        FF.person_property_unit(person, full_name=F.lit("A")),
        FF.person_property_unit(person, gender=F.lit("MALE")),
        FF.person_property_unit(person, location=FF.location(city=F.lit("X"))),
        FF.page_property_unit(FF.url_page(F.lit("http://a.com")), F.lit(1)),
        FF.equiv_unit(person, FF.user_person(F.lit(2))),
        FF.page_view_unit(person, FF.url_page(F.lit("http://a.com")), F.lit(1)),
    ]
    df = spark.range(1).select(F.explode(F.array(*[u.cast(S.DATAUNIT) for u in units])).alias("dataunit"))
    got = [(r[0], r[1]) for r in df.select(FF.unit_id(), FF.property_id()).collect()]
    assert got == [(1, 1), (1, 2), (1, 3), (2, 1), (3, 0), (4, 0)]


@pytest.mark.parametrize("path", ["1/1", "2/1", "3", "4", "3/9"])
def test_validate_path_valid(path):
    assert ST.validate_path(path)


@pytest.mark.parametrize("path", ["", "x", "9", "1", "1/x", "1/4", "2/2"])
def test_validate_path_invalid(path):
    assert not ST.validate_path(path)


def test_validate_target_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 4), (4, 0), (2, 2), (3, 0)], "unit_id int, property_id int")
    got = {(r.unit_id, r.property_id): r.valid for r in ST.validate_target(df).collect()}
    assert got == {(1, 1): True, (1, 4): False, (4, 0): True, (2, 2): False, (3, 0): True}


def test_scan_tolerant_reports_truncated_file(spark, tmp_root):
    path = os.path.join(tmp_root, "facts")
    pageviews(spark, [(i, "http://a.com/x", i) for i in range(30)]).repartition(3).write.parquet(path)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert len(files) == 3
    victim = os.path.join(path, files[0])
    data = open(victim, "rb").read()
    with open(victim, "wb") as fh:
        fh.write(data[: len(data) // 2])
    scan = ST.scan_tolerant(spark, path)
    assert scan.files_listed == 3 and scan.files_read == 2
    lost = scan.lost.collect()
    assert len(lost) == 1 and lost[0].file_path.endswith(files[0]) and (lost[0].expected, lost[0].read) == (None, 0)
    assert 0 < scan.facts.count() < 30


def test_scan_tolerant_counts_rows_lost_in_damaged_pages(spark, tmp_root):
    """The footer is whole, so counting rows alone would miss the loss."""
    import pyarrow.parquet as pq

    path = os.path.join(tmp_root, "facts")
    # no equal values and no dictionaries, so that every page holds data
    rows = [(i, f"http://a.com/{i}", i) for i in range(30000)]
    pageviews(spark, rows).repartition(3).write.option("parquet.block.size", 65536).option("parquet.enable.dictionary", "false").parquet(path)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    meta = {f: pq.ParquetFile(os.path.join(path, f)).metadata for f in files}
    # the first file: all pages zeroed; the second: zeroed from its second row group on
    second = min(meta[files[1]].row_group(1).column(c).data_page_offset for c in range(meta[files[1]].num_columns)) if meta[files[1]].num_row_groups > 1 else None
    for name, start in ((files[0], 4), (files[1], second)):
        if start is None:
            continue
        victim = os.path.join(path, name)
        data = bytearray(open(victim, "rb").read())
        end = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
        data[start:end] = bytes(end - start)
        with open(victim, "wb") as fh:
            fh.write(data)
    for crc in os.listdir(path):
        if crc.endswith(".crc"):
            os.remove(os.path.join(path, crc))
    scan = ST.scan_tolerant(spark, path)
    lost = {r.file_path.rsplit("/", 1)[1]: (r.expected, r.read) for r in scan.lost.collect()}
    assert lost[files[0]] == (meta[files[0]].num_rows, 0)
    if second is not None:
        expected, read = lost[files[1]]
        assert expected == meta[files[1]].num_rows and 0 < read <= meta[files[1]].row_group(0).num_rows
    assert scan.lost_rows == sum(e - r for e, r in lost.values()) and files[2] not in lost


def test_normalize_url_random_agrees_with_sql(spark):
    import random

    rng = random.Random(17)
    parts = {
        "lead": ["", " ", "\t", "  "],
        "scheme": ["http", "HTTPS", "ftp", "Ftp", "custom", "h2", "", "1http", "mailto"],
        "sep": ["://", ":/", "//", ":"],
        "user": ["", "u@", "u:p@", "a@b@"],
        "host": ["foo.com", "Foo.COM", "foo_bar.com", "[::1]", "[", "", "a b", "xn--d.de", "ü.de"],
        "port": ["", ":80", ":", ":abc", ":99999999999"],
        "path": ["", "/", "/a/b", "/a b", "/x;p=1", "/./../", "/\x01x", "/ü"],
        "tail": ["", "?q=1", "#f", "?a#b", "?x=/y", "#\n", "?"],
        "trail": ["", " ", "\n", " \t"],
    }
    urls = []
    for _ in range(3000):
        urls.append("".join(rng.choice(parts[k]) for k in parts))
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    got = {r.i: r.n for r in df.select("i", normalize_url("u").alias("n")).collect()}
    con = duckdb.connect()
    con.register("t", df.toPandas())
    exp = {r[0]: r[1] for r in con.execute(f"SELECT i, {sql_normalize_url('u')} FROM t").fetchall()}
    bad = [(urls[i], got[i], exp[i]) for i in range(len(urls)) if got[i] != exp[i]]
    assert not bad, bad[:5]


def test_sort_facts_orders_enums_by_code_and_union_by_arm(spark):
    person = FF.user_person(F.lit(1))
    rows = [
        (FF.pedigree(F.lit(5), "BACKTYPE", "external_data"), FF.person_property_unit(person, gender=F.lit("FEMALE"))),
        (FF.pedigree(F.lit(5), "BACKTYPE", "external_data"), FF.person_property_unit(person, gender=F.lit("MALE"))),
        (FF.pedigree(F.lit(5), "BACKTYPE", "external_data"), FF.person_property_unit(person, full_name=F.lit("Z"))),
        (FF.pedigree(F.lit(5), "SELF", "external_data"), FF.equiv_unit(person, FF.user_person(F.lit(2)))),
        (FF.pedigree(F.lit(5), "SELF", "page_view"), FF.page_view_unit(person, FF.url_page(F.lit("u")), F.lit(1))),
        (FF.pedigree(F.lit(4), "BACKTYPE", "page_view"), FF.page_property_unit(FF.url_page(F.lit("u")), F.lit(1))),
    ]
    df = None
    for i, (ped, unit) in enumerate(rows):
        one = spark.range(1).select(*FF.make_fact(ped, unit), F.lit(i).alias("i"))
        df = one if df is None else df.unionByName(one)
    got = [r.i for r in PV.sort_facts(df).select("i").collect()]
    # time 4 first; then SELF before BACKTYPE; page_view system before external_data;
    # within BACKTYPE person properties: full_name (arm 1) before gender (arm 2), MALE before FEMALE
    assert got == [5, 4, 3, 2, 1, 0]
