"""Exact top-k search by a Voronoi join.

Components become floor(64 * x) as whole numbers; the score is the inner product. A bounded sample gives the pivots; every
vector belongs to the cell of its nearest pivot, and a cell's summary is its size and its radius. The score of q with
any vector of a cell lies within q.pivot +- |q| * radius (Cauchy-Schwarz), so

1. each query is first solved in the cells with the highest centres that hold k other vectors: its k-th score there is a
   threshold from below;
2. then only in the cells whose upper bound reaches the threshold. Cells that no query of a group needs are not sent to it.

Neighbouring cells share blocks of bounded size, and a cell larger than a block is cut (it may hold a third of all vectors); queries
are in groups of cells near each other, cut as well. One block meets one group in one task, which merges its cells to no more than k
rows a query.

Vectors that are NULL, have NULL or non-finite components or a NULL id take no part. Shorter vectors count as padded
with zeros. Rows with the query's own id are no candidates of it. Ties go to the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import stored

#: The least and the most pivots, and the rows of the sample they are chosen from.
PIVOTS, SAMPLE = (64, 1024), 4096
#: Blocks of the data, as long as a block has no more than MOST_ROWS rows then; queries in one group; scores held at a time.
BLOCKS, MOST_ROWS, GROUP, SCORES = 24, 50_000, 2000, 4_000_000


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, v)``: valid vectors as whole numbers."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    return embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * 64)).alias("v"))


def _matrix(column) -> np.ndarray:
    """Rows of packed 64-bit integers as a matrix, shorter ones padded with zeros."""
    width = max((len(b) for b in column), default=0)
    return np.frombuffer(b"".join(b.ljust(width, b"\0") for b in column), dtype="<i8").reshape(len(column), width // 8)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows; by floating point where it is exact."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS[0], sample: int = SAMPLE) -> np.ndarray:
    """Pivots from the ``sample`` vectors with the smallest hashes of their ids: centres after a few rounds of k-means."""
    rows = vectors.orderBy(F.xxhash64(F.lit("pivot"), F.col("vec_id")), "vec_id").limit(sample).select("packed").collect()
    x = np.unique(_matrix([bytes(r[0]) for r in rows]).astype(np.float64), axis=0) if rows else np.zeros((0, 0))
    centres = x[np.random.default_rng(7).permutation(len(x))[:pivots]]
    for _ in range(5):
        if not len(centres):
            break
        near = (((centres**2).sum(1))[None, :] - 2 * x @ centres.T).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return centres


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x


def assign_cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with the cell of each and its distance from the pivot."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch["packed"]).astype(np.float64)
            width = max(x.shape[1], pivots.shape[1])
            x, p = _wide(x, width), _wide(pivots, width)
            cell = ((p**2).sum(1)[None, :] - 2 * x @ p.T).argmin(1)
            yield batch.assign(cell=cell.astype(np.int32), radius=np.sqrt(((x - p[cell])**2).sum(1)))

    return vectors.mapInPandas(run, "vec_id long, packed binary, cell int, radius double")


def _bounds(packed, pivots: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre score and half-width of each cell's scores, for each query; widened against rounding."""
    q = _matrix(packed).astype(np.float64)
    width = max(q.shape[1], pivots.shape[1])
    q, p = _wide(q, width), _wide(pivots, width)
    half = np.sqrt((q**2).sum(1))[:, None] * radii[None, :]
    return q @ p.T, half * (1 + 1e-9) + 1e-6


def _best(scores: np.ndarray, ids: np.ndarray, good: np.ndarray, k: int) -> np.ndarray:
    """The k of ``good`` with the highest scores, ties to the smaller id."""
    if len(good) > k:
        good = good[scores[good] >= np.partition(scores[good], len(good) - k)[len(good) - k]]
        good = good[np.lexsort((ids[good], -scores[good]))[:k]]
    return good


def _solve(k: int):
    """The k best of each query in one block, from the cells of the block that the query needs."""
    def run(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(queries):
            data = data.sort_values("cell", kind="stable")
            ids, vectors, cells = data["vec_id"].to_numpy(), _matrix(data["packed"]), data["cell"].to_numpy()
            present = np.unique(cells)
            spans = list(zip(np.searchsorted(cells, present), np.searchsorted(cells, present, side="right")))
            step = max(SCORES // len(ids), 1)
            for start in range(0, len(queries), step):
                asked = queries.iloc[start:start + step]
                needs = np.array([np.isin(present, own) for own in asked["cells"]])
                scores = np.zeros((len(asked), len(ids)), dtype=np.int64)
                open_ = np.zeros(scores.shape, dtype=bool)
                own = _matrix(asked["packed"])
                for needed, (low, high) in zip(needs.T, spans):
                    rows = np.flatnonzero(needed)
                    scores[rows, low:high] = _products(own[rows], vectors[low:high])
                    open_[rows, low:high] = True
                least = asked["least"].to_numpy(dtype=np.float64, na_value=-np.inf)
                open_ &= (scores >= least[:, None]) & (ids[None, :] != asked["query_id"].to_numpy()[:, None])
                for row, query in enumerate(asked["query_id"]):
                    best = _best(scores[row], ids, np.flatnonzero(open_[row]), k)
                    found.append(pd.DataFrame({"query_id": query, "vec_id": ids[best], "score": scores[row][best]}))
        return pd.concat(found).astype("int64") if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    return run


def _blocks_of(cells: list[int], sizes: dict[int, int], line: np.ndarray, block: int) -> tuple[dict[int, int], dict[int, int]]:
    """Block of each cell and pieces of each block: neighbouring cells share a block, a cell larger than one is cut."""
    of, pieces, held = {}, {}, 0
    for at in line:
        cell = cells[at]
        if not pieces or held + sizes[cell] > block:
            pieces[len(pieces)], held = 1, 0
        of[cell] = len(pieces) - 1
        held += sizes[cell]
        pieces[of[cell]] = -(-held // block)
    return of, pieces


def top_k(embeddings: DataFrame, is_query=None, k: int = 20, pivots: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the k best of each query among all other rows.

    ``pivots``: their number; by default the square root of the number of vectors, between PIVOTS[0] and PIVOTS[1].
    """
    is_query = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    pack = F.udf(lambda v: np.asarray(v, dtype="<i8").tobytes(), "binary", useArrow=True)
    vectors = whole_numbers(embeddings).select("vec_id", pack("v").alias("packed"))
    vectors = stored(vectors, "vectors")
    total = vectors.count()
    centres = choose_pivots(vectors, pivots or min(max(math.isqrt(total), PIVOTS[0]), PIVOTS[1]))
    empty = "query_id long, rank int, vec_id long, score long"
    if not len(centres):
        return embeddings.sparkSession.createDataFrame([], empty)
    data = stored(assign_cells(vectors, centres), "cells")
    # One row per pivot comes back.
    summary = {r["cell"]: r for r in data.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("radius").alias("radius"),
        F.count_if(is_query).alias("queries")).collect()}
    cells = sorted(summary)
    centres, radii = centres[cells], np.array([summary[c]["radius"] for c in cells])
    sizes = np.array([summary[c]["n"] for c in cells])
    # Cells along the line of most spread: neighbours share blocks of data and groups of queries.
    spread = centres - centres.mean(0)
    direction = np.linalg.svd(spread, full_matrices=False)[2][0] if len(cells) > 1 else np.zeros(centres.shape[1])
    line = np.argsort(spread @ direction, kind="stable")
    block_of, pieces = _blocks_of(cells, {c: summary[c]["n"] for c in cells}, line, min(max(total // BLOCKS, 1), MOST_ROWS))
    groups, passed = {}, 0
    for at in line:
        n = summary[cells[at]]["queries"]
        groups[cells[at]] = (passed // GROUP, max(passed + n - 1, passed) // GROUP)
        passed += n
    lookup = lambda values: F.create_map(*[F.lit(int(x)) for pair in values.items() for x in pair])

    first = lookup({c: groups[c][0] for c in cells})[F.col("cell")]
    last = lookup({c: groups[c][1] for c in cells})[F.col("cell")]
    queries = data.filter(is_query).select(
        F.col("vec_id").alias("query_id"), "packed",
        (first + F.pmod(F.xxhash64("vec_id"), last - first + 1)).cast("int").alias("group"))
    enough = max(k + 1, total // PIVOTS[0])

    def home(batches):
        for batch in batches:
            if not len(batch):
                continue
            centre, half = _bounds(batch["packed"], centres, radii)
            order = np.argsort(-centre, axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            upto = 1 + np.minimum((held < enough).sum(1), len(cells) - 1)
            yield batch.assign(least=None, need=[[cells[c] for c in row[:n]] for row, n in zip(order, upto)])

    def others(batches):
        for batch in batches:
            if not len(batch):
                continue
            centre, half = _bounds(batch["packed"], centres, radii)
            least = batch["least"].to_numpy(dtype=np.float64, na_value=-np.inf)
            wanted = centre + half >= least[:, None]
            yield batch.drop(columns=["done"]).assign(need=[
                [cells[c] for c in np.flatnonzero(row) if cells[c] not in own]
                for row, own in zip(wanted, map(set, batch["done"]))])

    def by_block(batches):
        """One row for each query and block, with the cells needed there."""
        for batch in batches:
            rows = []
            for at, need in enumerate(batch["need"]):
                own: dict[int, list[int]] = {}
                for cell in need:
                    own.setdefault(block_of[cell], []).append(cell)
                rows += [(at, block, asked) for block, asked in own.items()]
            if rows:
                at, block, asked = zip(*rows)
                yield batch.drop(columns=["need"]).iloc[list(at)].assign(block=block, cells=asked)

    block = lookup(block_of)[F.col("cell")]
    blocks = data.select("vec_id", "packed", "cell", block.alias("at"), F.pmod(
        F.xxhash64("vec_id"), lookup(pieces)[block]).cast("int").alias("piece"))

    def solved(needed: DataFrame) -> DataFrame:
        asked = needed.mapInPandas(by_block, "query_id long, packed binary, group int, least double, block int, cells array<int>")
        wanted = asked.select("block", F.col("group").alias("team")).distinct()  # at most a row per block and group
        sent = blocks.join(wanted, F.col("at") == F.col("block")).select("at", "piece", "team", "vec_id", "packed", "cell")
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), lookup(pieces)[F.col("block")] - 1)))
        return sent.groupBy("at", "piece", "team").cogroup(
            asked.select("block", "part", "group", "query_id", "packed", "least", "cells").groupBy("block", "part", "group")).applyInPandas(
            _solve(k), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    head = "query_id long, packed binary, group int, least double, need array<int>"
    asked = stored(queries.mapInPandas(home, head), "home")
    found = stored(solved(asked).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "home-best")
    least = found.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("least"))
    again = asked.select("query_id", "packed", "group", F.col("need").alias("done")).join(least, "query_id", "left")
    more = solved(stored(again.select("query_id", "packed", "group", "least", "done").mapInPandas(others, head), "others"))
    return found.select("query_id", "vec_id", "score").unionByName(more).withColumn(
        "rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
