"""One large JSON array, read by many tasks.

A file with a single top-level array of objects is read in pieces that end at closing braces, so Spark splits it like any text. A brace
ends a record only outside strings and at depth one, which depends on everything before it. Each split therefore adds up its quotes
and braces twice, for a start outside and inside a string; one small row per split is put in file order, and gives every split the
state it starts in. Records that cross splits are joined from their pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchday.sources.landing import NO_ARRAY, NOT_JSON, PATH, POS, RAW, REASON

END = "}"
SPLIT = ("source_path", "__split")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``(source_path, __split, __size, __at, __piece)``: the text up to each closing brace, in file order within a split."""
    text = spark.read.option("lineSep", END).text(path)
    return text.select(F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_block_start").alias("__split"),
                       F.col("_metadata.file_size").alias("__size"), F.monotonically_increasing_id().alias("__at"),
                       F.col("value").alias("__piece"))


def _depth_change(outside: Column, closes: Column) -> Column:
    """Opening less closing braces of a piece whose strings are left out; its own end counts if it is outside a string."""
    return F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit(""))) - closes.cast("int")


def _read(pieces: DataFrame) -> DataFrame:
    """Quotes and brace changes of each piece, for a start outside (0) and inside (1) a string."""
    plain = F.regexp_replace("__piece", r"\\.", "")  # without escapes, every quote starts or ends a string
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))
    strings = r'"[^"]*("|$)'
    from_outside = F.regexp_replace(plain, strings, "")
    from_inside = F.regexp_replace(F.regexp_replace(plain, r'^[^"]*("|$)', ""), strings, "")
    odd = (quotes % 2).cast("int")
    return pieces.withColumn("__odd", odd).withColumn("__d0", _depth_change(from_outside, odd == 0)).withColumn(
        "__d1", _depth_change(from_inside, odd == 1))


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """``(source_path, pos, raw_payload, reason)``: every object of the arrays in the files under ``path``, as JSON text.

    ``pos`` counts the records of a file from 0; the layout is that of :func:`matchday.sources.landing.raw_records`. The elements must
    be objects; strings may hold braces, quotes and commas, objects may be nested. Empty arrays have no rows. What is no array of
    objects comes with a reason: text before, between or after the records, a record that does not end, an array that does not."""
    pieces = _read(_pieces(spark, path))
    # Per split: the parity of its quotes, its depth change for both starts, its last piece and its bytes.
    in_order = Window.partitionBy(*SPLIT).orderBy("__at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, -1)
    before = (F.coalesce(F.sum("__odd").over(so_far), F.lit(0)) % 2).alias("__before")
    seen = pieces.select("*", before)
    by_start = [F.when(F.col("__before") == start, F.col("__d0")).otherwise(F.col("__d1")) for start in (0, 1)]
    seen = seen.withColumn("__c0", by_start[0]).withColumn("__c1", by_start[1])
    splits = seen.groupBy(*SPLIT).agg(
        (F.sum("__odd") % 2).alias("__odd"), F.sum("__c0").alias("__c0"), F.sum("__c1").alias("__c1"),
        F.max("__at").alias("__last"), F.sum(F.octet_length("__piece") + 1).alias("__bytes"), F.max("__size").alias("__size"))
    file = Window.partitionBy(PATH)
    earlier = file.orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("__start", F.coalesce(F.sum("__odd").over(earlier), F.lit(0)) % 2)
    change = F.when(F.col("__start") == 0, F.col("__c0")).otherwise(F.col("__c1"))
    splits = splits.withColumn("__change", change).select(
        *SPLIT, "__start", F.coalesce(F.sum("__change").over(earlier), F.lit(0)).alias("__depth"),
        F.when(F.col("__split") == F.max("__split").over(file), F.col("__last")).alias("__last"),
        # The last piece of a file ends at a brace only if its bytes, with one brace each, are those of the file.
        (F.sum("__bytes").over(file) == F.col("__size")).alias("__closed"))

    # Every piece with its depth after it; a record ends where that is back at 0.
    placed = seen.drop("__size").join(splits, list(SPLIT))
    own = F.when(F.col("__start") == 0, F.col("__c0")).otherwise(F.col("__c1"))
    after = F.col("__depth") + F.sum(own).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    outside = (F.col("__start") + F.col("__before") + F.col("__odd")) % 2 == 0
    final = F.coalesce(F.col("__at") == F.col("__last"), F.lit(False))
    placed = placed.withColumn("__ends", outside & (after == 0) & (~final | F.col("__closed"))).withColumn("__final", final)

    # The number of a record is that of the ends before it: those of earlier splits, and those earlier in its own.
    ends = placed.groupBy(*SPLIT).agg(F.count_if("__ends").alias("__ends_here"))
    base = ends.select(*SPLIT, F.coalesce(F.sum("__ends_here").over(earlier), F.lit(0)).alias("__base"))
    ended = F.coalesce(F.count_if("__ends").over(so_far), F.lit(0))
    numbered = placed.withColumn("__ended", ended).join(base, list(SPLIT)).select(
        PATH, (F.col("__base") + F.col("__ended")).alias(POS), "__split", "__at", "__piece", "__ends", "__final")
    parts = F.sort_array(F.collect_list(F.struct("__split", "__at", "__piece")))
    joined = numbered.groupBy(PATH, POS).agg(
        F.concat_ws(END, parts["__piece"]).alias("__text"), F.max("__ends").alias("__whole"), F.max("__final").alias("__final"))
    first, whole, text = F.col(POS) == 0, F.col("__whole"), F.col("__text")
    opened = F.when(first, text.rlike(r"^\s*\[\s*\{")).otherwise(text.rlike(r"^\s*,\s*\{"))
    closing = F.when(first, text.rlike(r"^\s*\[\s*\]\s*$")).otherwise(text.rlike(r"^\s*\]\s*$"))
    record = F.concat(F.regexp_replace(text, r"^\s*[\[,]\s*", ""), F.lit(END))
    rows = F.array_compact(F.array(
        F.when(whole, F.struct(F.col(POS).alias(POS), F.when(opened, record).otherwise(F.concat(text, F.lit(END))).alias(RAW),
                               F.when(~opened, F.lit(NO_ARRAY)).alias(REASON))),
        F.when(~whole & ~closing, F.struct(F.col(POS).alias(POS), text.alias(RAW), F.lit(NOT_JSON).alias(REASON))),
        F.when(whole & F.col("__final"), F.struct((F.col(POS) + 1).alias(POS), F.lit("").alias(RAW), F.lit(NOT_JSON).alias(REASON)))))
    return joined.select(PATH, F.inline(rows))
