"""Mixing sources to target weights by systematic sampling.

Sources, in code-point order with NULL last, weigh ``weights`` in turn and share ``share`` times all words. A target
stops at ``cap`` times its source's words, the excess is reshared by weight until none is above: targets are
``least(cap * words, level * weight)`` for the one level at which they sum up.

Within a source every document expects ``target / source words`` copies. Documents in the order (words, id modulo SPREAD, id)
get consecutive intervals of that length after one random offset; a document is emitted once for each integer its
interval reaches. The order by words makes the copies cover all lengths evenly, so the words taken come near the target.

The position of a document is a sum of three counts (shorter documents, earlier remainders, rank in the remainder), so no
task ever orders a whole source: the largest window group holds 1 / SPREAD of the documents of one length in one source,
or the distinct lengths of one source. A NULL text has no words; a NULL id is spread by a checksum of its text, or of its row
where the words were counted before. Repeated rows
are documents of their own; among rows of one id and length those with the smaller checksum of all columns (but maps) come
first, so reruns take the same rows however the table is laid out. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import others, word_count

SPREAD = 4096
#: The columns of a plan.
PLAN = ("size", "source_size", "target", "copies")


def _before(value: Column, window) -> Column:
    """Running sum over the earlier rows of the window."""
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``(src, source_size, target)`` for ``(src, source_size)``. The windows hold one row per source."""
    ordered = sizes.withColumn("place", F.row_number().over(Window.orderBy("src")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") - 1) % len(weights) + 1)
    ordered = ordered.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "place")
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * F.lit(float(share)) - _before(F.col("most"), by_ratio)) / (
        F.sum("weight").over(whole) - _before(F.col("weight"), by_ratio))
    levels = ordered.withColumn("level", level).withColumn("turn", F.row_number().over(by_ratio))
    open_turn = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("turn"))
    found = levels.withColumn("level", F.min_by("level", open_turn).over(whole))
    target = F.coalesce(F.least(F.col("most"), F.col("level") * F.col("weight")), F.col("most"))
    return found.select("src", "source_size", target.alias("target"))


def planned_copies(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0,
                   seed: str = "mix", size: str | None = None) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``cap``, rounded up), in place of columns of
    these names in ``docs``; ``mix_sources`` returns those of ``docs``. ``size`` names a column of word counts, for documents
    whose words were counted before; the texts are then not needed."""
    planned = _planned(docs, weights, share, cap, seed, size)
    return planned.select(*others(docs, *PLAN), *[F.col(f"__{name}").alias(name) for name in PLAN])


def _planned(docs: DataFrame, weights, share: float, cap: float, seed: str, size: str | None = None) -> DataFrame:
    """``docs`` with ``__size``, ``__source_size``, ``__target`` and ``__copies``."""
    src = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    spread = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")) if size is None else F.pmod(
        F.xxhash64(*hashed), F.lit(1 << 32))
    keyed = docs.select(
        "*", F.xxhash64(*hashed).alias("__row"), src.alias("__src"),
        (word_count(F.col("text")) if size is None else F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0))).alias("__size"),
        F.coalesce(F.pmod(F.col("doc_id"), F.lit(SPREAD)), spread % SPREAD).alias("__part"))
    per_part = keyed.groupBy(F.col("__src").alias("src"), F.col("__size").alias("size"), F.col("__part").alias("part")).agg(
        F.count(F.lit(1)).alias("n"))
    per_size = per_part.groupBy("src", "size").agg(F.sum("n").alias("n"))
    targets = source_targets(per_size.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")),
                             weights, share, cap)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("src"))), 1, 8), 16, 10).cast("double") / 2.0**32
    per_size = per_size.withColumn("shorter", _before(F.col("n"), Window.partitionBy("src").orderBy("size"))).join(
        targets, "src").select(
        "src", "size", "shorter", "source_size", "target", offset.alias("offset"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))
    starts = per_part.withColumn(
        "earlier", _before(F.col("n"), Window.partitionBy("src", "size").orderBy("part"))).join(
        per_size, ["src", "size"]).select(
        F.col("src").alias("__src"), F.col("size").alias("__size"), F.col("part").alias("__part"),
        F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
        (F.col("shorter") + F.col("earlier")).alias("__start"), F.col("rate").alias("__rate"),
        F.col("offset").alias("__offset"))
    ranked = keyed.withColumn("__rank", F.row_number().over(
        Window.partitionBy("__src", "__size", "__part").orderBy("doc_id", "__row")))
    place = F.col("__start") + F.col("__rank")
    reach = lambda p: F.floor(F.col("__offset") + p * F.col("__rate"))
    copies = F.least(reach(place) - reach(place - 1), F.lit(math.ceil(cap)))
    return ranked.join(starts, ["__src", "__size", "__part"]).select(
        *docs.columns, "__size", "__source_size", "__target", copies.cast("int").alias("__copies"))


def mix_sources(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``planned_copies`` says, with the columns of ``docs``."""
    planned = _planned(docs, weights, share, cap, seed).filter(F.col("__copies") > 0)
    return planned.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")).select(
        *docs.columns)
