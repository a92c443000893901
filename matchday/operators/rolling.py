"""Rolling aggregates over the last n rows, safe for very long keys.

A plain window puts each key on one task. Here the rows are cut into slices of (keys, order); a slice receives the n-1 rows that
precede it (its carry), so every row still sees its whole frame, and no task holds more than a slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.operators.slices import SLICE, range_slices

CARRIED = "__carried"


def _carries(sliced: DataFrame, order: Sequence[str], n: int, columns: Sequence[str]) -> DataFrame:
    """For every slice, the n-1 rows just before it, whichever key they have.

    At most n-1 rows of a slice are looked at; the window over the slices sees one row for each of them."""
    backward = Window.partitionBy(SLICE).orderBy(*[F.col(c).desc() for c in order])
    tails = sliced.select(*columns, SLICE).withColumn("__back", F.row_number().over(backward)).filter(F.col("__back") <= n - 1)
    last = tails.groupBy(SLICE).agg(F.sort_array(F.collect_list(F.struct("__back", F.struct(*columns).alias("row")))).alias("__tail"))
    # A slice has a row at least, so the n-1 slices before one hold its carry: newest slice first, newest row first.
    earlier = Window.orderBy(SLICE).rowsBetween(-(n - 1), -1)
    before = last.select(SLICE, F.flatten(F.reverse(F.collect_list("__tail").over(earlier))).alias("__before"))
    return before.select(SLICE, F.explode(F.slice("__before", 1, n - 1)).alias("__before")).select("__before.row.*", SLICE)


def rolling_last_n(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int,
                   measures: Mapping[str, Column], inputs: Sequence[str], slices: int | None = None) -> DataFrame:
    """Add rolling aggregates over each row and the n-1 rows before it in its key.

    ``measures`` are aggregate columns over ``inputs``; ``order_by`` must be a total order within a key. ``slices`` is the number of
    slices; by default that of the shuffle partitions, fewer for small inputs."""
    order = list(dict.fromkeys([*keys, *order_by]))
    sliced = range_slices(df, [F.col(c).asc() for c in order], slices)
    frame = Window.partitionBy(SLICE, *keys).orderBy(*[F.col(c).asc() for c in order_by]).rowsBetween(-(n - 1), 0)
    added = [m.over(frame).alias(name) for name, m in measures.items()]
    if n < 2:
        return sliced.select(*df.columns, *added)
    needed = list(dict.fromkeys([*order, *inputs]))
    carried = _carries(sliced, order, n, needed).withColumn(CARRIED, F.lit(True))
    rows = sliced.withColumn(CARRIED, F.lit(False)).unionByName(carried, allowMissingColumns=True)
    return rows.select("*", *added).filter(~F.col(CARRIED)).drop(SLICE, CARRIED)
