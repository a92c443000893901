"""The best documents for each item by term impacts, as products of dense tiles.

The items are a stated set of queries, taken in blocks of a bounded number of (item, term) pairs. For a block, one pass over the texts
keeps each document's counts of the block's terms; document frequencies are counted from them by Spark. The block's items are then cut
into tiles of rows, each with its compact vocabulary cut into tiles of columns; a task turns a tile of documents into a dense matrix
of their impacts on those columns and multiplies the two in float64.

Weights and impacts are whole numbers. A tile of columns ends where the sum of a row's weights times the largest impact would pass
2^53, so every partial sum of a product is exact; the tiles are added up in 64-bit integers. A task keeps each item's k best
documents, those equal to the k-th one told apart by their id, and one window merges the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import map_texts, stored

#: A-Z in lower case, ASCII characters but letters and digits as a space: what is left between spaces are the terms.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))

#: Impacts are div results of 10^9 * tf by 1000 * tf and more, so never above this.
TOP_IMPACT = 1_000_000
EXACT = 2 ** 53


def term_counts(texts: list[bytes], vocabulary: dict[bytes, int]) -> list[tuple]:
    """For each text: its number of terms, the numbers of its terms in ``vocabulary``, ascending, and their counts."""
    out = []
    for text in texts:
        terms = text.translate(_TERMS).split()
        known = np.fromiter(map(vocabulary.get, terms, repeat(-1)), dtype=np.int32, count=len(terms))
        found, counts = np.unique(known[known >= 0], return_counts=True)
        out.append((len(terms), found, counts.astype(np.int64)))
    return out


def item_terms(items: DataFrame) -> DataFrame:
    """``(item, term, times)`` of ``items`` with item (a number of the row) and text."""
    def function(texts: list[bytes], rows: pa.RecordBatch) -> list[tuple]:
        return [([t.decode("utf-8") for t in text.translate(_TERMS).split()],) for text in texts]

    found = map_texts(items, "text", ["item"], {"terms": pa.list_(pa.string())}, lambda: function)
    return found.select("item", F.explode("terms").alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


class Tile:
    """Some items' weights on some terms: ``items`` and ``terms`` ascending, ``weights`` by (row, column)."""

    def __init__(self, items: np.ndarray, entries: list[tuple[int, int, int]]):
        self.items = items
        self.terms = np.array(sorted({t for _, t, _ in entries}), dtype=np.int32)
        self.rows = np.array([r for r, _, _ in entries], dtype=np.int32)
        self.columns = np.searchsorted(self.terms, np.array([t for _, t, _ in entries], dtype=np.int32))
        self.values = np.array([v for _, _, v in entries], dtype=np.float64)

    def weights(self) -> np.ndarray:
        dense = np.zeros((len(self.items), len(self.terms)))
        dense[self.rows, self.columns] = self.values
        return dense


def tiles(weighted: dict[int, dict[int, int]], rows: int, columns: int, exact: int = EXACT) -> list[list[Tile]]:
    """``item -> term -> weight`` as groups of tiles: the tiles of a group hold the same ``rows`` items, at most ``columns`` terms each.

    In a tile, the weights of an item sum to less than ``exact / TOP_IMPACT``; a greater weight is dealt to several tiles.
    """
    most, out = (exact - 1) // TOP_IMPACT, []
    items = sorted(weighted)
    for at in range(0, len(items), rows):
        group = np.array(items[at:at + rows], dtype=np.int64)
        by_term: dict[int, list[tuple[int, int]]] = {}
        for row, item in enumerate(group.tolist()):
            for term, weight in weighted[item].items():
                by_term.setdefault(term, []).append((row, weight))
        made, entries, sums, held = [], [], [0] * len(group), 0

        def close() -> None:
            nonlocal entries, sums, held
            if entries:
                made.append(Tile(group, entries))
            entries, sums, held = [], [0] * len(group), 0

        for term in sorted(by_term):
            rest = by_term[term]
            while rest:
                if held == columns or any(sums[row] + min(weight, most) > most for row, weight in rest):
                    close()
                entries += [(row, term, min(weight, most)) for row, weight in rest]
                held += 1
                for row, weight in rest:
                    sums[row] += min(weight, most)
                rest = [(row, weight - most) for row, weight in rest if weight > most]
        close()
        if made:
            out.append(made)
    return out


class Best:
    """The k best documents of each item seen so far; equal scores by ascending id, a NULL id last."""

    def __init__(self, k: int):
        self.k = k
        self.kept: dict[int, tuple[np.ndarray, ...]] = {}
        self.least: dict[int, np.ndarray] = {}

    def add(self, group: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """``scores`` of a group's items (rows) and some documents (columns)."""
        if group not in self.kept:
            empty = np.zeros(0, dtype=np.int64)
            self.kept[group] = (empty, empty, empty, np.zeros(0, dtype=bool))
            self.least[group] = np.ones(len(scores), dtype=np.int64)
        least = self.least[group]
        if scores.shape[1] > self.k:
            # Whatever ties with the k-th score of this tile stays in.
            least = np.maximum(least, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k])
        row, column = np.nonzero(scores >= least[:, None])
        if not len(row):
            return
        merged = [np.concatenate(pair) for pair in zip(self.kept[group], (row, scores[row, column], ids[column], missing[column]))]
        order = np.lexsort((merged[2], merged[3], -merged[1], merged[0]))
        row, score, *rest = (m[order] for m in merged)
        place = np.arange(len(row)) - np.searchsorted(row, row)
        stay, full = place < self.k, place == self.k - 1
        self.kept[group] = tuple(m[stay] for m in (row, score, *rest))
        self.least[group][row[full]] = score[full]

    def rows(self, groups: list[list[Tile]]) -> Iterator[pa.RecordBatch]:
        for group, (row, score, ids, missing) in self.kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups[group][0].items[row]), pa.array(ids, mask=missing), pa.array(score)], names=["item", "id", "score"])


def impacts(counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The impact of a term that a text of ``lengths`` terms holds ``counts`` times."""
    m = 100 - 25 + (25 * lengths * documents) // total
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


def _scorer(sent, documents: int, total: int, k: int, width: int):
    """A task's function over packed documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = sent.value
        best = Best(k)
        for batch in batches:
            for start in range(0, len(batch), width):
                part = batch.slice(start, width)
                ids, lengths, terms, counts = part.columns
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                plain_ids = ids.fill_null(0).to_numpy()
                document = np.repeat(np.arange(len(part)), np.diff(terms.offsets.to_numpy()))
                term = terms.flatten().to_numpy()
                impact = impacts(counts.flatten().to_numpy(), lengths.to_numpy()[document], documents, total)
                for group, made in enumerate(groups):
                    scores = np.zeros((len(made[0].items), len(part)), dtype=np.int64)
                    for tile in made:
                        column = np.searchsorted(tile.terms, term)
                        hit = column < len(tile.terms)
                        hit[hit] = tile.terms[column[hit]] == term[hit]
                        dense = np.zeros((len(tile.terms), len(part)))
                        dense[column[hit], document[hit]] = impact[hit]
                        scores += (tile.weights() @ dense).astype(np.int64)
                    best.add(group, scores, plain_ids, missing)
        yield from best.rows(groups)

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_column: str = "doc_id", item_column: str = "item_id",
           text: str = "text", pairs: int = 200_000, rows: int = 256, columns: int = 4096, width: int = 1024) -> DataFrame:
    """``(item_column, rank, id_column, score)``: each item's ``k`` best documents with a score above 0, all if fewer.

    Terms are stretches of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case. The weight of a term
    in df of N documents is ``floor(1000 * ln((2 N + 2) / (2 df + 1)))``; its impact on a document is :func:`impacts`; a score sums
    their products over an item's terms, with repeats. N counts the documents with a term.

    Ids are whole numbers. Every row of ``docs`` is a document and every row of ``items`` an item, also where ids repeat or are NULL;
    equal scores go by ascending id, NULL last. NULL and empty texts have no terms: such documents count for nothing and such items
    have no rows. Other columns are not looked at. A block of at most about ``pairs`` (item, term) pairs, or one longer item, is held
    by the driver and sent to the tasks; every block is one more pass over the texts.
    """
    numbered = stored(items.select(F.col(f"`{item_column}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
                      .withColumn("item", F.monotonically_increasing_id()), "search-items")
    terms = stored(item_terms(numbered), "search-terms")
    blocks = max(1, math.ceil(terms.count() / pairs))
    block_of = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = None
    for block in range(blocks):
        best = _search_block(docs, id_column, text, terms.filter(block_of == block), k, rows, columns, width)
        found = best if found is None else found.unionByName(best)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_column), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_column), "score")


def _search_block(docs: DataFrame, id_column: str, text: str, terms: DataFrame, k: int, rows: int, columns: int,
                  width: int) -> DataFrame:
    """``(item, id, score)``: the k best documents of each item and task, for the items of one bounded block."""
    spark = docs.sparkSession
    wanted = terms.collect()  # bounded by the caller
    names = sorted({r["term"] for r in wanted})
    vocabulary = spark.sparkContext.broadcast({name.encode("utf-8"): i for i, name in enumerate(names)})
    held = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))

    def make():
        return lambda texts, _: term_counts(texts, vocabulary.value)

    packed = stored(map_texts(held, "text", ["id"], {
        "n": pa.int64(), "terms": pa.list_(pa.int32()), "counts": pa.list_(pa.int64())}, make), "search-documents")
    size = packed.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    documents, total = size["documents"], size["total"]
    holding = packed.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = {r["term"]: r["df"] for r in holding.collect()}  # at most one row for each term of the block
    number = {name: i for i, name in enumerate(names)}
    weighted: dict[int, dict[int, int]] = {}
    for r in wanted:
        term = number[r["term"]]
        if term in df:
            weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[term] + 1)))
            if weight:
                weighted.setdefault(r["item"], {})[term] = weight * r["times"]
    sent = spark.sparkContext.broadcast(tiles(weighted, rows, columns))
    some = packed.filter(F.size("terms") > 0)
    return some.mapInArrow(_scorer(sent, documents, total, k, width), "item bigint, id bigint, score bigint")
