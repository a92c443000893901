"""Connected components by alternating large and small stars; every round is a written table.

Up to a counted number of edges, one task joins them in memory instead: a few tens of MB, and no rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import stored


#: Edges (of 16 bytes) that one task may join.
IN_ONE_TASK = 1_000_000
#: Rows of the edges and labels in one file.
ROWS_A_FILE = 100_000


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Labels of all nodes of the edges given, which one task holds."""
    parts = [batch[["u", "v"]].to_numpy(np.int64) for batch in batches]
    ends = np.concatenate([*parts, np.empty((0, 2), np.int64)])
    nodes, at = np.unique(ends, return_inverse=True)
    root = list(range(len(nodes)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for one, two in at.reshape(-1, 2).tolist():
        one, two = top(one), top(two)
        if one != two:  # nodes are numbered in order, so the smallest stays on top
            root[max(one, two)] = min(one, two)
    label = nodes[np.array([top(i) for i in range(len(nodes))], dtype=np.int64)]
    for start in range(0, len(nodes), 100_000):
        yield pd.DataFrame({"node": nodes[start:start + 100_000], "label": label[start:start + 100_000]})


def connected(edges: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """``(node, label)`` of every node in ``edges`` (``u``, ``v``): the label is the smallest node of its component.

    The number of rounds grows with the logarithm of the longest path. The joins on a node with very many neighbours
    are between two written tables, so Spark can split them.
    """
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                   "edges")
    before = _state(edges)
    if before[0] <= in_one_task:
        return edges.coalesce(1).mapInPandas(_joined, "node long, label long")
    while before[0]:
        # As many files as rows ask for: a round reads and writes several small tables.
        files = before[0] // ROWS_A_FILE + 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("x"), F.least("u", "m").alias("m")).coalesce(files), "least")
        # Large star: every larger neighbour is tied to the smallest one.
        edges = stored(both.filter("v > u").join(least, F.col("u") == F.col("x")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct().coalesce(files), "edges")
        # Small star: the smaller neighbours and the node itself are tied to the smallest.
        least = stored(edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x").coalesce(files), "least")
        tied = edges.join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("x").alias("u"), F.col("m").alias("v")))
        edges = stored(tied.filter("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().coalesce(files), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
