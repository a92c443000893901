"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from matchday.session import small_partitions

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


def canonical(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, cursor.fetchall())


def test_entry_is_lazy_and_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["c_custkey", "recommendation_score"] and df.count() > 0


def test_flagship_plan_reads_the_history_once_per_shuffle(spark, sf_dir):
    df = QUERIES["recommendation"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_small_partitions_grow_in_number_with_the_rows(spark):
    def partitions(session):
        return session.range(4_000_000).select(F.xxhash64("id").alias("k")).groupBy("k").count().rdd.getNumPartitions()

    size, given = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.getAll
    own = small_partitions(spark)
    assert partitions(spark) <= int(spark.conf.get("spark.sql.shuffle.partitions")) < partitions(own)
    assert spark.conf.getAll == given and own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set(size, "1m")
    try:
        assert int(small_partitions(spark).conf.get(size)) == 1 << 20
    finally:
        spark.conf.unset(size)


def test_silver_quality_runs_in_small_partitions(spark, sf_dir):
    df = QUERIES["silver_quality"](spark, sf_dir)
    assert int(df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 8 << 20
    assert df.count() == 10
