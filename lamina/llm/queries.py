"""The registered queries of the subpackage, one an operator.

Each takes (spark, sf_dir), runs its operator over its whole table and derives the
digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import collocations, dominance, fingerprints, flat, lm_scoring, near_dedup, packing, piece_codec, repetition, resampling, secret_scan, token_counts, toxicity, url_cascade

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    flat.on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality. The mass has the least background
    loss with ``leave_out`` of 0.5, 2, 8 and 64 on sf0.01 (2: 4.211, 8: 4.185, 64: 4.227)."""
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_scoring.score(_table(spark, sf_dir, "documents"), good, mass=8.0, leave_out=True)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = repetition.quality(_table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fingerprints.edited_pairs(_table(spark, sf_dir, "documents"))
    own, edited = F.col("sketch"), F.col("edited_sketch")
    # the digest's SQL has 0.0 where the fingerprints can't tell
    told = lambda estimate: F.coalesce(estimate, F.lit(0.0))
    return p.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join(own, "").alias("fingerprint"),
        F.array_join(edited, "").alias("edited_fingerprint"),
        told(fingerprints.likeness(own, edited)).alias("near_edited"),
        told(fingerprints.likeness(own, F.col("next_sketch"))).alias("near_next"),
        told(fingerprints.containment(own, edited)).alias("kept_in_edited"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = toxicity.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ["doc_id", "lang"])
    held_out = F.coalesce(toxicity.bucket(F.col("doc_id")) == 0, F.lit(False))
    predicted = (F.col("verdict.score") >= 0.5).cast("int").alias("predicted")
    return s.select("doc_id", held_out.alias("held_out"), "verdict.score", predicted, "lang", "verdict.threshold", "verdict.toxic")


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = piece_codec.encode_documents(_table(spark, sf_dir, "documents"), digests=True)
    return e.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_cascade.judge(pages, url_cascade.listed_hosts(pages)).select("page_id", "host", "path", "rule", "verdict", "listed")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(secret_scan.BASE))
    counts = [of(i).alias(f"n_{r.name}") for i, r in enumerate(secret_scan.BASE)]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = token_counts.token_counts(_table(spark, sf_dir, "documents"), budgets=(4096,))
    return t.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), "chars_4096")


def op11_dominance_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = dominance.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the texts of ``benchmark``."""
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (op1_lm_scoring, op2_packing, op3_quality_rules, op4_fingerprints, op5_near_dedup, op6_toxicity, op7_piece_codec, op8_url_cascade, op9_secret_scan, op10_token_counts, op11_dominance_packing, op12_resampling, op13_collocations)}


#: The words of a text, and a list's windows of n words, as DuckDB expressions.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')"

_OP3 = f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
win AS (SELECT r, n, i, list_slice(ws, i, i + n - 1) AS g
        FROM w, (VALUES (5), (8), (101)) AS s(n), range(1, len(ws) - n + 2) AS t(i) WHERE len(ws) >= n),
rep AS (SELECT r, n, i FROM win QUALIFY count(*) OVER (PARTITION BY r, n, g) > 1),
cov AS (SELECT r, n, count(DISTINCT i + k) AS c FROM rep, range(0, rep.n) AS t(k) GROUP BY r, n),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS d FROM lines
        WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY r),
base AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(d, 0) AS n_dup_lines,
         coalesce(c8.c, 0) AS n_repeat_words, coalesce(c5.c, 0) AS covered_words, c101.c IS NOT NULL AS long_repeat
  FROM w LEFT JOIN dup USING (r) LEFT JOIN cov c8 ON c8.r = w.r AND c8.n = 8
  LEFT JOIN cov c5 ON c5.r = w.r AND c5.n = 5 LEFT JOIN cov c101 ON c101.r = w.r AND c101.n = 101)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * covered_words > 30 * n_words OR long_repeat) AS kept,
       covered_words::BIGINT AS covered_words
FROM base
"""

_OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, md5(coalesce(text, '')) AS h FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS nxt
      FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, h ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT row_number() OVER () AS r, doc_id, n, text, nxt,
             substring(text, 1, n - n // 3) || substring(nxt, 1, n // 3) AS edited FROM o),
t AS (SELECT r, 1 AS k, {_WORDS} AS ws FROM e UNION ALL
      SELECT r, 2, {_WORDS.replace("text", "edited")} FROM e UNION ALL SELECT r, 3, {_WORDS.replace("text", "nxt")} FROM e),
s AS (SELECT r, k, list_transform(range(1, greatest(len(ws) - 4, 1) + 1),
                                  lambda i: substring(md5(array_to_string(list_slice(ws, i, i + 4), ' ')), 1, 16)) AS g
      FROM t WHERE len(ws) > 0),
f AS (SELECT r, k, CASE WHEN len(list_filter(g, lambda x: x < '2')) > 0
                        THEN list_sort(list_distinct(list_filter(g, lambda x: x < '2'))) ELSE [list_min(g)] END AS f FROM s),
p AS (SELECT e.*, coalesce(a.f, []::VARCHAR[]) AS a, coalesce(b.f, []::VARCHAR[]) AS b, coalesce(c.f, []::VARCHAR[]) AS c
      FROM e LEFT JOIN f a ON a.r = e.r AND a.k = 1 LEFT JOIN f b ON b.r = e.r AND b.k = 2 LEFT JOIN f c ON c.r = e.r AND c.k = 3)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
       array_to_string(b, '') AS edited_fingerprint,
       CASE WHEN len(a) + len(b) = 0 THEN 1.0::DOUBLE
            ELSE len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END AS near_edited,
       CASE WHEN len(a) + len(c) = 0 THEN 1.0::DOUBLE
            ELSE len(list_intersect(a, c))::DOUBLE / (len(a) + len(c) - len(list_intersect(a, c))) END AS near_next,
       CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a, b))::DOUBLE / len(a) END AS kept_in_edited
FROM p
"""

_OP8 = r"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE
        WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND prefix(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/') THEN 'com/' END AS rule,
      regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)') AS listed FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM r
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP12 = rf"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
w AS (SELECT 1 AS own, row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
      UNION ALL SELECT 0, 0, 0, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
v AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM (SELECT unnest(ws) AS word FROM w)),
b AS (SELECT word, xor(list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda k: ('0x' || h[2 * k + 1 : 2 * k + 2])::BIGINT),
                                   lambda c, x: xor(t[xor(c, x) % 256 + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM v, crc),
u AS (SELECT own, r, bucket FROM (SELECT own, r, unnest(ws) AS word FROM w) JOIN b USING (word)),
c AS (SELECT bucket, sum(own)::BIGINT AS s, sum(1 - own)::BIGINT AS t FROM u GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                     / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM c),
x AS (SELECT r, sum(gain)::BIGINT AS weight FROM u JOIN g USING (bucket) WHERE own = 1 GROUP BY r),
d AS (SELECT r, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             ('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h FROM w LEFT JOIN x USING (r) WHERE own = 1),
e AS (SELECT r, doc_id, n_features, weight,
             weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, count(*) OVER () AS n FROM e WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank::BIGINT END AS rank FROM e LEFT JOIN k USING (r)
"""

_OP13 = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase, count(*) AS a
      FROM w, range(1, 6) AS s(m), range(1, len(ws) - m + 2) AS t(i) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, m, a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS x,
             array_to_string(string_split(phrase, ' ')[k + 1 : m], ' ') AS y FROM f, range(1, m) AS t(k)),
s AS (SELECT c.*, l.a AS l, r.a AS r, n.n, (1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS score
      FROM c JOIN f l ON l.lang = c.lang AND l.phrase = x JOIN f r ON r.lang = c.lang AND r.phrase = y JOIN n ON n.lang = c.lang
      QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
i AS (SELECT DISTINCT o.lang, array_to_string(string_split(o.phrase, ' ')[b : b + q - 1], ' ') AS phrase, o.a AS longer
      FROM f o, range(2, o.m) AS t(q), range(1, o.m - q + 2) AS u(b))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM s WHERE NOT EXISTS (FROM i WHERE i.lang = s.lang AND i.phrase = s.phrase AND 100 * i.longer >= 100 * s.a)
QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {"op3_quality_rules": _OP3, "op4_fingerprints": _OP4, "op8_url_cascade": _OP8, "op12_resampling": _OP12, "op13_collocations": _OP13}
