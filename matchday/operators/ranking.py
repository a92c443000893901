"""First-n-per-key operators.

Every operator here filters ``row_number() <= literal``, which Spark plans as a
partial and a final ``WindowGroupLimit``: each map task forwards at most n rows
per key, so a key that holds a large share of the input still sends only
``n x map tasks`` rows to its reducer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.operators.slices import SLICE, range_slices

RANK = "__rank"


def ordering(columns: Sequence[str | Column], descending: bool = False, nulls: str = "default") -> list[Column]:
    """Sort keys; ``nulls`` is ``default`` (Spark's), ``first`` or ``last``."""
    suffix = {"default": "", "first": "_nulls_first", "last": "_nulls_last"}[nulls]
    method = ("desc" if descending else "asc") + suffix
    return [getattr(F.col(c) if isinstance(c, str) else c, method)() for c in columns]


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of every key; ``rank`` keeps the row number under that name."""
    out = df.withColumn(RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.filter(F.col(RANK) <= n)
    return out.withColumnRenamed(RANK, rank) if rank else out.drop(RANK)


def top_n_per_key(df: DataFrame, keys: Sequence[str], score: str, n: int, tie_break: Sequence[str],
                  rank: str | None = None) -> DataFrame:
    """The ``n`` highest scores of every key."""
    order = [F.col(score).desc(), *ordering(tie_break)]
    return first_n_per_key(df, keys, order, n, rank)


def top_n(df: DataFrame, score: str, n: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` highest scores overall (planned as ``TakeOrderedAndProject``)."""
    return df.orderBy(F.col(score).desc(), *ordering(tie_break)).limit(n)


def summarise_first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                      measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate the first ``n`` rows of every key. One shuffle: the aggregation
    reuses the partitioning of the rank."""
    kept = first_n_per_key(df, keys, order, n)
    return kept.groupBy(*keys).agg(*[measure.alias(name) for name, measure in measures.items()])


def latest_n_agg(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int,
                 measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate the newest ``n`` rows of every key.

    Equals taking the last value of an n-row rolling aggregate, because the
    newest frame is exactly the newest n rows."""
    return summarise_first_n(df, keys, ordering(order_by, descending=True), n, measures)


def next_n_agg(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int,
               measures: Mapping[str, Column], nulls: str = "first") -> DataFrame:
    """Aggregate the earliest ``n`` rows of every key. ``nulls`` places rows whose
    order value is unknown."""
    return summarise_first_n(df, keys, ordering(order_by, nulls=nulls), n, measures)


def last_by(value: Column, *order: str | Column) -> Column:
    """Aggregate: the value at the highest order key (a partial aggregate, no sort)."""
    return F.max_by(value, F.struct(*order))


def latest_where(df: DataFrame, keys: Sequence[str], flag: Column, order_by: Sequence[str],
                 columns: Sequence[str]) -> DataFrame:
    """Per key, the newest row that satisfies ``flag``; keys without one are absent.
    Without keys, the newest row of the whole input."""
    picked = F.max_by(F.struct(*columns), F.struct(*order_by)).alias("picked")
    out = df.filter(flag).groupBy(*keys).agg(picked)
    return out.filter(F.col("picked").isNotNull()).select(*keys, "picked.*")


def current_or_next(df: DataFrame, current: Column, following: Column, order_by: Sequence[str],
                    columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The first current row, else the first following one (per key if keys are given)."""
    is_current = F.coalesce(current, F.lit(False))
    is_following = F.coalesce(following, F.lit(False))
    place = F.struct((~is_current).alias("late"), *order_by)
    picked = F.min_by(F.struct(*columns), place).alias("picked")
    out = df.filter(is_current | is_following).groupBy(*keys).agg(picked)
    return out.filter(F.col("picked").isNotNull()).select(*keys, "picked.*")


def ranked(df: DataFrame, score: str, tie_break: Sequence[str]) -> DataFrame:
    """Global order by score. A range-partitioned sort: use it on final results only."""
    return df.orderBy(F.col(score).desc(), *ordering(tie_break))


def global_rank(df: DataFrame, score: str, tie_break: Sequence[str], rank: str = "place", slices: int | None = None) -> DataFrame:
    """Every row with its place by score, highest first, NULL last, then by ``tie_break``.

    Rows are numbered within range slices, and a slice adds the sizes of those before it: one small row per slice, no window over all
    rows. Rows that ``tie_break`` does not tell apart are numbered in any order."""
    order = [F.col(score).desc_nulls_last(), *ordering(tie_break)]
    sliced = range_slices(df, order, slices)
    sizes = sliced.groupBy(SLICE).agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(SLICE, F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"))
    within = F.row_number().over(Window.partitionBy(SLICE).orderBy(*order))
    # One offset per slice: a lookup that does not grow with the rows.
    placed = sliced.withColumn(RANK, within).join(F.broadcast(offsets), SLICE)
    return placed.select(*df.columns, (F.col(RANK) + F.col("__offset")).alias(rank))
