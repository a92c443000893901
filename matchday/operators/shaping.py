"""Row-shaping operators: role rows, bag unions and dimension look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_sides(df: DataFrame, sides: Sequence[Mapping[str, Column]], keep: Sequence[str] = ()) -> DataFrame:
    """One output row per side of every input row, from a single scan.

    Each side maps output names to expressions; all sides share the names."""
    names = list(sides[0])
    if any(list(side) != names for side in sides):
        raise ValueError("all sides must define the same columns in the same order")
    rows = F.array(*[F.struct(*[side[name].alias(name) for name in names]) for side in sides])
    return df.select(*keep, F.inline(rows))


def union_sides(first: DataFrame, second: DataFrame) -> DataFrame:
    """Bag union matched by column name; duplicates are kept."""
    return first.unionByName(second)


def left_join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
                  columns: Sequence[str] | Mapping[str, str] | None = None) -> DataFrame:
    """Left-join a dimension on its unique key; facts without a match are kept.

    ``columns`` narrows the dimension first (a mapping renames, old to new). No
    broadcast hint is given: Spark broadcasts the narrowed side when its size,
    estimated at planning or measured at run time, is under the session's
    threshold, and otherwise shuffles both sides, splitting skewed keys."""
    keys = [on] if isinstance(on, str) else list(on)
    if columns is None:
        narrow = dim
    elif isinstance(columns, Mapping):
        narrow = dim.select(*[F.col(old).alias(new) for old, new in columns.items()])
    else:
        narrow = dim.select(*keys, *[c for c in columns if c not in keys])
    return fact.join(narrow, on=keys, how="left")
