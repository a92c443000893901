"""From raw documents to token ids: five stages, each written and read back before the next.

Toxic documents go, lines found in many documents go, one document of each group of near copies stays, the sources are mixed to
their target weights, and the mix is encoded. Every stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchday.llm import line_dedup, mixing, near_dedup, toxicity
from matchday.llm.common import stored, table
from matchday.llm.queries import token_digests


#: Rows that go to a Python worker at a time: texts are whole and long, and several stages run in one worker.
BATCH_ROWS = 1000


def _batched(stage):
    """``stage`` with batches of BATCH_ROWS, in this session from then on."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that 10 or more of them hold."""
    return line_dedup.without_frequent_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8."""
    return near_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mix_sources(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row for each document of the mix."""
    return token_digests(docs)


STAGES = [(name, _batched(stage)) for name, stage in (
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("bpe", encode),
)]

#: The first stage's classifier is not expressible in SQL; tests/llm checks the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
