"""Threshold-scaled fingerprints of documents, in DataFrame functions only.

A document's shingles are its runs of five words (all words as one if it has fewer). A
shingle's hash is the first 16 hex digits of its MD5. The fingerprint retains every
distinct hash below a fixed fraction of the hash space, in order. The same fraction
holds for all documents, so

* the fingerprint of a union of documents is the union of their fingerprints
  (``merged``), and
* the part of one fingerprint found in the other estimates how much of the one document
  the other contains, also where one is far longer (``containment``); the same holds
  for the resemblance, intersection by union (``likeness``).

A document with shingles but none below the threshold retains its least hash alone, so
only documents without words have an empty fingerprint; merging keeps this rule too.
Such a stand-in (one text of 8 shingles in three has it) says nothing about hashes below
the threshold, and a true fingerprint nothing about those above: whether a short text is
part of a longer one can't be told then. ``containment`` and ``likeness`` are null where
the fingerprints can't tell; they are never 0.0 for want of hashes.

Results for special cases: a null text is empty; texts without words have the empty
fingerprint, alike (1.0) among themselves and unlike (0.0) any other. Equal texts have
equal fingerprints. In the order of documents, null ids come last and rows with equal
ids follow by the MD5 of their texts; rows equal in id and text are one place in that
order and get equal results. A lone document is its own next. Whole texts are used, also
very long ones. An empty table gives no rows. Columns beside the two named have no influence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import ensure_checkpoint_dir

SHINGLE = 5
DIGITS = 16
#: Hashes below this hex string are retained: an eighth of all.
BELOW = "2"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column) -> Column:
    """The hashes of all shingles, in the order of the text, with repeats."""
    digest = lambda words: F.substring(F.md5(F.array_join(words, " ").cast("binary")), 1, DIGITS)

    def of(words: Column) -> Column:
        n = F.size(words)
        windows = F.transform(F.sequence(F.lit(1), F.greatest(n - SHINGLE + 1, F.lit(1))), lambda i: digest(F.slice(words, i, SHINGLE)))
        return F.when(n > 0, windows).otherwise(F.array().cast("array<string>"))

    return _let(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), of)


def retained(hashes: Column) -> Column:
    """The rule: all hashes below the threshold, or else the least one; in order."""

    def of(all_hashes: Column) -> Column:
        return _let(F.filter(all_hashes, lambda h: h < BELOW), lambda low: F.when((F.size(low) > 0) | (F.size(all_hashes) == 0), F.sort_array(F.array_distinct(low))).otherwise(F.array(F.array_min(all_hashes))))

    return _let(hashes, of)


def fingerprint(text: Column) -> Column:
    """The retained hashes of a text: array of hex strings."""
    return retained(shingle_hashes(F.coalesce(text, F.lit(""))))


def merged(a: Column, b: Column) -> Column:
    """The fingerprint of two documents taken together."""
    return retained(F.array_union(a, b))


def stands_in(a: Column) -> Column:
    """Whether a fingerprint is a least hash that stands in for none below the threshold."""
    return (F.size(a) == 1) & (F.get(a, 0) >= BELOW)


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance: shingles in both by shingles in either. Null (unknown) if
    one of the two is a stand-in and the other a true fingerprint. Two stand-ins: whether
    the least hashes are the same."""
    both = F.size(F.array_intersect(a, b))
    known = _let(both, lambda n: F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(n / (F.size(a) + F.size(b) - n)))
    return F.when((F.size(a) == 0) | (F.size(b) == 0) | (stands_in(a) == stands_in(b)), known)


def containment(a: Column, b: Column) -> Column:
    """Estimated part of the first document's shingles that the second has. Null
    (unknown) if one of the two is a stand-in and the other a true fingerprint, and for
    two stand-ins if the second's hash is the lesser: the first's may stand behind it."""
    known = F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))
    comparable = (stands_in(a) == stands_in(b)) & ~(stands_in(a) & (F.get(b, 0) < F.get(a, 0)))
    return F.when((F.size(a) == 0) | (F.size(b) == 0) | comparable, known)


def next_documents(keys: DataFrame) -> DataFrame:
    """``keys`` (doc_id, h, n; distinct) with next_id and next_h: the next by
    descending doc_id, the first after the last.

    The keys are dealt out in ranges, so no task sorts them all; what follows a range's
    last key is the first key of the next range."""
    ensure_checkpoint_dir(keys.sparkSession)
    order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    # written once: the ranges must not change between their two uses
    dealt = keys.repartitionByRange(*order).withColumn("range", F.spark_partition_id()).checkpoint()
    inside = Window.partitionBy("range").orderBy(*order)
    key = F.struct("doc_id", "h")
    placed = dealt.withColumn("follows", F.lead(key).over(inside)).withColumn("place", F.row_number().over(inside))
    by_range = Window.orderBy("range")  # one row a range
    firsts = placed.where("place = 1").select("range", key.alias("first"))
    after = firsts.select("range", F.coalesce(F.lead("first").over(by_range), F.first("first").over(by_range)).alias("after"))
    found = placed.join(after, "range").withColumn("next", F.coalesce("follows", "after"))
    return found.select("doc_id", "h", "n", F.col("next.doc_id").alias("next_id"), F.col("next.h").alias("next_h"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, n_chars, text, edited (the last third of the
    code points replaced by as many first ones of the next document), sketch,
    edited_sketch, next_sketch (the three fingerprints)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # one key that is never null, so that the joins find the texts where the grouping put them
    key = lambda i, h: F.concat(F.coalesce(F.col(i).cast("string"), F.lit("-")), F.lit(":"), F.col(h))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("h"))
    order = next_documents(rows.groupBy("doc_id", "h").agg(F.max(F.length("text")).alias("n")))
    before = order.select(key("doc_id", "h").alias("p_key"), F.col("n").alias("p_n"), key("next_id", "next_h").alias("next_key"))
    # repeated rows are one until the end
    keyed = rows.select(key("doc_id", "h").alias("key"), "doc_id", "text")
    once = keyed.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("copies"))
    # the columns of this copy are used too, so that its shuffle is the other's
    after = once.where("copies > 0 and (doc_id is null or doc_id = doc_id)")
    told = after.join(before, after["key"] == before["next_key"])
    told = told.select("p_key", F.substring(F.col("text"), F.lit(1), F.floor(F.col("p_n") / 3).cast("int")).alias("head"), fingerprint(F.col("text")).alias("next_sketch"))
    both = once.join(told, once["key"] == told["p_key"])
    both = both.select("doc_id", "text", "copies", F.length("text").cast("long").alias("n_chars"), "head", "next_sketch")
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 3)
    both = both.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), kept.cast("int")), F.col("head")))
    both = both.withColumn("sketch", fingerprint(F.col("text"))).withColumn("edited_sketch", fingerprint(F.col("edited")))
    out = ["doc_id", "n_chars", "text", "edited", "sketch", "edited_sketch", "next_sketch"]
    return both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*out)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, fingerprint. Map-only."""
    return docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col)).alias("fingerprint"))
