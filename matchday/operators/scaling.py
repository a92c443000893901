"""Min-max normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAT_VALUE = 0.5


def _scaled(column: Column, low: Column, high: Column) -> Column:
    flat = low.isNull() | (low == high)
    return F.when(flat, F.lit(FLAT_VALUE)).otherwise((column - low) / (high - low))


def min_max_normalize(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                      suffix: str = "_norm") -> DataFrame:
    """Add ``<column>_norm`` in [0, 1] for several columns in one pass.

    A column that is constant or all NULL becomes 0.5 on every row; otherwise
    NULL stays NULL. The extremes are one row of one aggregate, read as a scalar
    subquery, so the plan stays lazy and a later filter does not change them.
    With ``by`` the extremes are per group: an aggregate joined back."""
    extremes = F.struct(*[
        piece for i, c in enumerate(columns)
        for piece in (F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"))
    ]).alias("__extremes")
    if by:
        stats = df.groupBy(*by).agg(extremes).select(
            *[F.col(k).alias(f"__by_{k}") for k in by], "__extremes"
        )
        same_group = [F.col(k).eqNullSafe(F.col(f"__by_{k}")) for k in by]
        with_stats = df.join(stats, same_group, "left").drop(*[f"__by_{k}" for k in by])
    else:
        with_stats = df.withColumn("__extremes", df.agg(extremes).scalar())
    scaled = [
        _scaled(F.col(c), F.col(f"__extremes.lo{i}"), F.col(f"__extremes.hi{i}")).alias(c + suffix)
        for i, c in enumerate(columns)
    ]
    return with_stats.select(*df.columns, *scaled)
