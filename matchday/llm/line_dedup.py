"""Line dedup by levelled sorted runs of line hashes.

A run is a Parquet table of (line hash, documents holding it, whether first seen there), sorted by hash. Each batch of documents
is compared with the runs by merge anti joins on the hash, and adds one run at the lowest level: its new hashes, marked
``first``, and the counts of the known ones. A level with ``fanout`` runs is compacted into one run of the next, where the
counts of a hash are added up. So each hash is ``first`` in exactly one run, whatever the number of batches.

Lines are split at \\n. A line's key is the line without white space at its ends (U+0020, U+0009 to U+000D), A-Z
lower-cased; its hash has 64 bits. A NULL or empty text has one empty line. Keys shorter than ``min_chars`` code points are
never dropped. Repeated rows count as documents of their own. An empty table gives an empty result. All input
columns are kept, but the counts of ``drop_frequent_lines`` stand in place of columns named like them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.common import new_path, others, stored

_STRIP = b" \t\n\x0b\x0c\r"
#: A key in more than 1 / HOT of all documents is looked up by broadcast. A document with k lines has at most k keys, so
#: there are at most HOT * (mean lines per document) such keys, whatever the number of documents; they are counted, and beyond
#: MOST_HOT shuffled like the others.
HOT, MOST_HOT = 500, 1_000_000


def line_hash(line: str, min_chars: int) -> int | None:
    """Signed 64-bit hash of a line's key; None for a key that is too short."""
    key = line.encode("utf-8", "surrogatepass").strip(_STRIP).lower()
    if len(key) < min_chars or len(key.decode("utf-8", "surrogatepass")) < min_chars:
        return None
    value = xxhash.xxh64_intdigest(key)
    return value - (1 << 64) if value >= 1 << 63 else value


def _documents_lines(min_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, hashes = [], []
            for key, text in zip(batch["__key"], batch["__text"]):
                own = {line_hash(line, min_chars) for line in (text or "").split("\n")} - {None}
                keys += [key] * len(own)
                hashes += own
            yield pd.DataFrame({"key": pd.Series(keys, dtype="int64"), "hash": pd.Series(hashes, dtype="int64")})

    return run


class LineRuns:
    """The levels of runs, each a list of tables in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout, self.levels = spark, fanout, [[]]

    def _write(self, counts: DataFrame) -> DataFrame:
        path = new_path(self.spark, "line-run")
        counts.sortWithinPartitions("hash").write.parquet(path)
        return self.spark.read.schema(counts.schema).parquet(path)

    def add(self, lines: DataFrame) -> None:
        """Add the run of one batch: one row of ``lines`` for each document and hash."""
        counts = lines.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
        batch = self.unseen(counts).select("hash", "n", F.lit(True).alias("first"))
        for first in self._firsts():  # they share no hash
            batch = batch.unionByName(counts.join(first, "hash", "left_semi").withColumn("first", F.lit(False)))
        self.levels[0].append(self._write(batch))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self._write(self._summed(self.levels[level]))
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(merged)

    def unseen(self, lines: DataFrame) -> DataFrame:
        """Rows of ``lines`` whose hash is in no run."""
        for first in self._firsts():
            lines = lines.join(first, "hash", "left_anti")
        return lines

    def _firsts(self) -> list[DataFrame]:
        """Hashes that are first in each run, for merge joins."""
        return [run.filter("first").select("hash").hint("merge") for run in self.runs()]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _summed(self, runs: list[DataFrame]) -> DataFrame:
        all_rows = runs[0]
        for run in runs[1:]:
            all_rows = all_rows.unionByName(run)
        return all_rows.groupBy("hash").agg(F.sum("n").alias("n"), F.bool_or("first").alias("first"))

    def counts(self) -> DataFrame:
        return self._summed(self.runs()).select("hash", "n")


def _row_key():
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def line_table(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """``(key, hash)``: one row for each document row and distinct line key."""
    return docs.select(_row_key().alias("__key"), F.col("text").alias("__text")).mapInPandas(
        _documents_lines(min_chars), "key long, hash long")


def add_batches(runs: LineRuns, lines: DataFrame, batches: int) -> LineRuns:
    """Add ``lines`` to the runs in ``batches`` parts, by document."""
    for part in range(batches):
        runs.add(lines.filter(F.pmod(F.col("key"), F.lit(batches)) == part))
    return runs


def _dropped(lines: DataFrame, frequent: DataFrame, n_documents: int) -> DataFrame:
    """``(key, hashes)`` of the documents that lose lines. The few very frequent keys are broadcast (see HOT)."""
    limit = max(n_documents // HOT, 1)
    hot = frequent.filter(F.col("n") > limit).select("hash", F.lit(True).alias("hot"))
    if hot.count() > MOST_HOT:
        return lines.join(frequent.select("hash"), "hash").groupBy("key").agg(F.collect_set("hash").alias("hashes"))
    rest = frequent.filter(F.col("n") <= limit).select("hash")
    marked = lines.join(F.broadcast(hot), "hash", "left")
    found = marked.filter("hot").select("key", "hash").unionByName(
        marked.filter("hot is null").select("key", "hash").join(rest, "hash"))
    return found.groupBy("key").agg(F.collect_set("hash").alias("hashes"))


def _drop(min_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(batch["text"], batch["__gone"]):
                lines = (text or "").split("\n")
                n_lines.append(len(lines))
                if gone is not None and len(gone):
                    lost = set(gone)
                    lines = [line for line in lines if line_hash(line, min_chars) not in lost]
                    text = "\n".join(lines)
                texts.append(text)
                n_dropped.append(n_lines[-1] - len(lines))
            yield batch.drop(columns=["__gone"]).assign(text=texts, __n_lines=n_lines, __n_dropped=n_dropped)

    return run


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4) -> DataFrame:
    """``docs`` without the lines whose key is in at least ``min_docs`` documents; the other lines stay, joined by \\n.

    Adds ``n_lines`` (before dropping) and ``n_dropped``, in place of columns of these names in ``docs``. A text that loses
    nothing is unchanged (NULL stays NULL).
    """
    left = _left(docs, min_docs, min_chars, batches)
    return left.select(*others(docs, "n_lines", "n_dropped"), F.col("__n_lines").alias("n_lines"),
                       F.col("__n_dropped").alias("n_dropped"))


def without_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4) -> DataFrame:
    """As ``drop_frequent_lines``, with the columns of ``docs`` and no counts."""
    return _left(docs, min_docs, min_chars, batches).select(*docs.columns)


def _left(docs: DataFrame, min_docs: int, min_chars: int, batches: int) -> DataFrame:
    """``docs`` after dropping, with ``__n_lines`` and ``__n_dropped``."""
    spark = docs.sparkSession
    lines = stored(line_table(docs, min_chars), "lines")
    runs = add_batches(LineRuns(spark), lines, batches)
    frequent = stored(runs.counts().filter(F.col("n") >= min_docs), "frequent-lines")
    gone = _dropped(lines, frequent, docs.count())
    marked = docs.withColumn("__key", _row_key()).join(
        gone.select(F.col("key").alias("__key"), F.col("hashes").alias("__gone")), "__key", "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return marked.select(*docs.columns, "__gone").mapInPandas(_drop(min_chars), f"{schema}, __n_lines long, __n_dropped long")
