"""Rows cut into slices of one total order, of nearly equal size whatever the keys.

Sorted operators (rank of every row, rolling frames, running bests) need the rows in order, but not on one task: the input is
range-partitioned by the order, each range is one slice, and what a slice must know of the rows before it is a summary that does not
grow with the data. Bounds are drawn from the rows themselves, so a key with a third of all rows, a text order, a constant leading
column or values of very uneven spacing give equal slices; only rows equal in every order column stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.sources.staging import staged

SLICE = "__slice"


def range_slices(df: DataFrame, order: Sequence[Column], slices: int | None = None) -> DataFrame:
    """``df`` with the number of its slice, rising with ``order``, in a staged table.

    The input is scanned and shuffled once and written: range bounds come from a sample, so a second evaluation could cut elsewhere.
    Without ``slices`` there are as many as shuffle partitions, fewer if they would be small (AQE)."""
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    return staged(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")
