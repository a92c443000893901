"""I-Match document fingerprints.

The lexicon holds the terms whose inverse document frequency ln(N / df) over all documents lies in a band. A text's
lexicon terms, distinct and sorted, are hashed once whole and once for each of several randomised sub-lexicons that keep each term
with a given chance; sub-lexicons of a quarter down to a 256th of the lexicon make likeness gradual. The fingerprint is the
list of these hashes (0: no term); a text without lexicon terms is hashed by all its distinct terms instead.
The likeness of two fingerprints is the share of equal hashes among the sub-lexicons in which either has a term; two
fingerprints without any terms are alike if equal.

Terms are runs of letters and digits, lower-cased, known by 64-bit hashes. NULL and empty texts have no terms. Rows may
repeat; a NULL id counts as the smallest, and rows of one id follow each other by the hash of their text. The band bounds the
lexicon: a term in more than N * exp(-max_idf) documents is one of at most (mean distinct terms of a document) * exp(max_idf),
whatever N is. It is counted, and broadcast up to MOST_TERMS terms. Everything runs as DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import stored

#: Chance that a sub-lexicon keeps a term, as a power of 4, and how many there are of each.
SUBSETS = ((0, 1), (1, 2), (2, 4), (3, 8), (4, 9))
_LEVELS = [level for level, n in SUBSETS for _ in range(n)]
#: Documents of neighbouring ids that are handled together, and the most such buckets (which bounds what is broadcast).
BUCKET, MOST_BUCKETS = 1000, 200_000
#: Terms of the lexicon that are broadcast at most (16 bytes each); a larger lexicon is joined by a shuffle.
MOST_TERMS = 2_000_000
_NO_TERM = 0  # hash of the row that every text has
#: A bucket's number has places for the hot ids of a range of ids, and for the pieces of a hot id.
_PLACES = 1 << 22
_SMALLEST = -(1 << 63)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 0)
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, n_documents: int, min_idf: float, max_idf: float) -> DataFrame:
    """``(term, subsets)``: the terms of the band; bit s of ``subsets`` says whether sub-lexicon s keeps the term."""
    counts = docs.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"))
    band = counts.filter((F.col("df") >= n_documents * math.exp(-max_idf)) & (F.col("df") <= n_documents * math.exp(-min_idf)))
    kept = F.lit(0).cast("long")
    for s, level in enumerate(_LEVELS):
        inside = F.pmod(F.xxhash64(F.lit(f"subset {s}"), F.col("term")), F.lit(4**level)) == 0
        kept = kept + F.when(inside, F.lit(1 << s).cast("long")).otherwise(F.lit(0).cast("long"))
    return band.select("term", kept.alias("subsets"))


def _hashes(found: Column, whole: Column) -> Column:
    """The fingerprint of sorted ``(term, subsets)`` structures; ``whole`` where there are none."""
    nothing = F.xxhash64(F.array().cast("array<struct<term:bigint,subsets:bigint>>"))
    keeps = lambda s: lambda t: t["subsets"].bitwiseAND(F.lit(1 << s)) != 0
    each = [F.xxhash64(F.filter(found, keeps(s))) for s in range(len(_LEVELS))]
    return F.when(F.size(found) > 0, F.array(*[F.when(h == nothing, F.lit(0).cast("long")).otherwise(h) for h in each])).otherwise(
        F.array(whole, *[F.lit(0).cast("long")] * (len(_LEVELS) - 1)))


def likeness(a: Column, b: Column) -> Column:
    either = F.aggregate(F.zip_with(a, b, lambda x, y: ((x != 0) | (y != 0)).cast("int")), F.lit(0), lambda s, x: s + x)
    same = F.aggregate(F.zip_with(a, b, lambda x, y: ((x == y) & (x != 0)).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(either == 0, F.lit(1.0)).otherwise(same / either)


def fingerprint_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), "-")


def _id_ranges(docs: DataFrame, per_bucket: int, n_documents: int) -> Column:
    """The number of a range of ids, growing with doc_id, about ``per_bucket`` documents each: quantiles, evenly divided between."""
    wanted = max(n_documents // per_bucket, 1)
    segments = min(wanted, 64)
    shares = [i / segments for i in range(segments + 1)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or [0]
    cuts = sorted(set(cuts))
    parts = max(-(-wanted // segments), 1)
    bucket = F.lit(0).cast("long")
    for i, low in enumerate(cuts):
        width = max((cuts[i + 1] - low) if i + 1 < len(cuts) else 1, 1)
        part = F.least(F.floor((F.col("doc_id") - low) / F.lit(width) * parts), F.lit(parts - 1))
        bucket = F.when(F.col("doc_id") >= low, F.lit(i * parts).cast("long") + part).otherwise(bucket)
    return F.coalesce(bucket, F.lit(0).cast("long"))


def _bucketed(docs: DataFrame, n_documents: int) -> DataFrame:
    """``(doc_id, text, id, hash, bucket)``: bucket numbers grow along the order (id, hash), and none holds much more than others.

    A hot id, one of more rows than a bucket should have, gets buckets of its own, by even ranges of the hash of the text. Hot ids
    are at most as many as buckets, so they are broadcast: for each range of ids, the sorted list of (hot id, pieces).
    """
    per_bucket = max(BUCKET, n_documents // MOST_BUCKETS)
    keyed = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(_SMALLEST)).cast("long").alias("id"),
        _id_ranges(docs, per_bucket, n_documents).alias("range"))
    hot = stored(keyed.groupBy("range", "id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > per_bucket).groupBy("range").agg(
        F.sort_array(F.collect_list(F.struct("id", F.ceil(F.col("n") / per_bucket).alias("pieces")))).alias("hot")), "hot-ids")
    listed = keyed.withColumn("hash", F.xxhash64("text")).join(F.broadcast(hot), "range", "left")
    before = F.filter("hot", lambda h: h["id"] <= F.col("id"))
    nearest = F.element_at("before", F.size("before"))
    share = (F.shiftright(F.col("hash"), 32) + F.lit(1 << 31)) / F.lit(float(1 << 32))  # 0 to 1, in the order of the hashes
    piece = F.when(nearest["id"] == F.col("id"), F.floor(share * nearest["pieces"])).otherwise(F.lit(_PLACES - 1))
    inside = F.when(F.coalesce(F.size("before"), F.lit(0)) > 0, F.size("before") * F.lit(_PLACES) + piece).otherwise(F.lit(0))
    return listed.withColumn("before", before).select(
        "doc_id", "text", "id", "hash", (F.col("range") * F.lit(_PLACES * _PLACES) + inside).cast("long").alias("bucket"))


def with_next(docs: DataFrame, n_documents: int) -> DataFrame:
    """``(bucket, place, last, doc_id, text, next_text)`` of ``docs``; ties of doc_id go by the hash of the text, NULL comes first.

    Buckets hold neighbouring ids. The first document of each is also put at the end of the bucket before (of the last one for
    the very first), so that every document finds its next one in its own bucket; ``last`` marks those copies.
    """
    keyed = _bucketed(docs, n_documents)
    firsts = keyed.groupBy("bucket").agg(F.min(F.struct("id", "hash")).alias("low"))
    # One row per bucket, at most MOST_BUCKETS, three for each hot id, and a few.
    order = Window.orderBy("bucket")
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = stored(firsts.select(F.coalesce(F.lag("bucket").over(order), F.last("bucket").over(whole)).alias("before"),
                                  F.col("bucket").alias("own"), F.col("low.id").alias("first_id"), F.col("low.hash").alias("first_hash")),
                    "firsts")
    marked = keyed.join(F.broadcast(firsts), (F.col("own") == F.col("bucket")) & (F.col("first_id") == F.col("id")) & (
        F.col("first_hash") == F.col("hash")), "left")
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("last"))
    there = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("last"))
    placed = marked.select("doc_id", "text", "id", "hash", F.explode(
        F.when(F.col("before").isNotNull(), F.array(here, there)).otherwise(F.array(here))).alias("at")).select(
        "at.bucket", "at.last", "doc_id", "text", "id", "hash")
    row = Window.partitionBy("bucket").orderBy("last", "id", "hash", "text")
    return placed.select("bucket", F.row_number().over(row).alias("place"), "last", "doc_id", "text",
                         F.lead("text").over(row).alias("next_text"))


def fingerprints(docs: DataFrame, min_idf: float = 2.3, max_idf: float = 6.5) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, hashes, edited_hashes, next_hashes)`` for each row of ``docs``.

    The edited text has its last half replaced by as much of the start of the next document.
    """
    n_documents = docs.count()
    band = stored(lexicon(docs, max(n_documents, 1), min_idf, max_idf), "lexicon")
    known = band.unionByName(docs.sparkSession.range(1).select(F.lit(_NO_TERM).cast("long").alias("term"),
                                                               F.lit(-1).cast("long").alias("subsets")))
    if band.count() <= MOST_TERMS:
        known = F.broadcast(known)
    half = F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs, n_documents).withColumn("edited", F.when(~F.col("last"), F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half),
        F.substring(F.col("next_text"), F.lit(1), half))))
    # What is computed once per document stays below the two explodes, which repeat only small columns.
    listed = rows.select(
        "bucket", "place", "last", "doc_id", F.length("text").alias("n_chars"), F.sha2("edited", 256).alias("sha"),
        terms(F.col("text")).alias("own"), terms(F.coalesce("edited", F.lit(""))).alias("changed"))
    side = lambda which, found: F.struct(
        F.lit(which).alias("which"), F.col(found).alias("terms"),
        F.when(F.size(found) > 0, F.xxhash64(F.sort_array(found))).otherwise(F.lit(0).cast("long")).alias("whole"))
    head = ["bucket", "place", "last", "doc_id", "n_chars", "sha"]
    both = listed.select(*head, F.explode(F.array(side(0, "own"), side(1, "changed"))).alias("of")).select(
        *head, F.col("of.which").alias("which"), F.col("of.whole").alias("whole"),
        F.array_append("of.terms", F.lit(_NO_TERM).cast("long")).alias("terms"))
    each = both.select(*head, "which", "whole", F.explode("terms").alias("term"))
    # The rows of a bucket are in one task already: after a broadcast, grouping by document in a bucket moves nothing.
    found = each.join(known, "term")
    of = lambda which: F.sort_array(F.collect_list(F.when(
        (F.col("which") == which) & (F.col("subsets") != -1), F.struct("term", "subsets"))))
    whole = lambda which: F.max(F.when(F.col("which") == which, F.col("whole")))
    grouped = found.groupBy("bucket", "place").agg(
        F.first("last").alias("last"), F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"),
        F.first("sha").alias("sha"), of(0).alias("terms"), of(1).alias("edited_terms"),
        whole(0).alias("whole"), whole(1).alias("edited_whole"))
    hashed = grouped.select(
        "bucket", "place", "last", "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        _hashes(F.col("terms"), F.col("whole")).alias("hashes"),
        _hashes(F.col("edited_terms"), F.col("edited_whole")).alias("edited_hashes"))
    following = F.lead("hashes").over(Window.partitionBy("bucket").orderBy("place"))
    return hashed.withColumn("next_hashes", following).filter(~F.col("last")).drop("bucket", "place", "last")
