from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchday.operators.rolling import rolling_last_n
from matchday.operators.slices import SLICE, range_slices

MEASURES = {"mean": F.avg, "n": F.count}


def series(spark, seed, keys=4, length=120):
    rng = random.Random(seed)
    data = []
    for k in range(keys):
        size = length if k == 0 else rng.randrange(1, 9)
        for i in range(size):
            day = None if rng.random() < 0.03 else int(rng.random() ** 3 * 1000)
            data.append((None if k == 1 else k, day, len(data), None if rng.random() < 0.1 else rng.randrange(50)))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k INT, day INT, id BIGINT, v INT").repartition(4)


def rolled(df, n, slices):
    """Rolled over slices, or by a plain window for None."""
    measures = {name: make("v") for name, make in MEASURES.items()}
    if slices is None:
        frame = Window.partitionBy("k").orderBy("day", "id").rowsBetween(-(n - 1), 0)
        return df.select("*", *[m.over(frame).alias(name) for name, m in measures.items()])
    return rolling_last_n(df, ["k"], ["day", "id"], n, measures, ["v"], slices=slices)


@pytest.mark.parametrize("seed,n,slices", [(1, 3, 12), (2, 3, 100), (3, 5, 17), (4, 2, 5), (5, 1, 12), (6, 8, 40), (7, 30, 64)])
def test_slices_give_the_plain_window(spark, rows, seed, n, slices):
    df = series(spark, seed)
    assert rows(rolled(df, n, slices), "id") == rows(rolled(df, n, None), "id")


@pytest.mark.parametrize("kind", ["TIMESTAMP_NTZ", "TIMESTAMP", "DATE", "DOUBLE"])
def test_order_columns_of_any_type(spark, rows, kind):
    base = series(spark, 9)
    expr = "CAST(day AS DOUBLE)" if kind == "DOUBLE" else f"CAST(date_add(DATE'2024-01-01', day) AS {kind})"
    df = base.withColumn("day", F.expr(expr))
    assert rows(rolled(df, 3, 12).drop("day"), "id") == rows(rolled(df, 3, None).drop("day"), "id")


def test_local_times_keep_their_order_across_a_clock_change(spark, rows):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.range(90).selectExpr(
            "1 AS k", "TIMESTAMP_NTZ'2024-03-10 00:30:00' + make_dt_interval(0, 0, CAST(id * 2 AS INT), id % 7) AS day", "id",
            "CAST(id % 13 AS INT) AS v")
        assert rows(rolled(df, 3, 18).drop("day"), "id") == rows(rolled(df, 3, None).drop("day"), "id")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def slice_sizes(df, slices):
    cut = range_slices(df, [F.col(c) for c in ("k", "day", "id")], slices)
    return [r["count"] for r in cut.groupBy(SLICE).count().collect()]


@pytest.mark.parametrize("day", ["CONCAT('day ', id % 7)", "7", "IF(id = 0, 1000000, id)", "POW(2.0, id / 10)", "IF(id % 3 = 0, NULL, 1)"])
def test_no_slice_is_much_larger_than_the_others(spark, rows, day):
    """Text, one value only, an outlier, exponential values, and NULLs, in one key."""
    df = spark.range(4000).selectExpr("1 AS k", f"{day} AS day", "(id * 37) % 4000 AS id", "CAST(id % 11 AS INT) AS v").repartition(3)
    sizes = slice_sizes(df, 20)
    assert sum(sizes) == 4000 and max(sizes) <= 2 * 4000 / 20 and len(sizes) >= 18
    assert rows(rolled(df, 4, 20), "id") == rows(rolled(df, 4, None), "id")


def test_the_fact_is_scanned_once(spark, tmp_path):
    spark.range(500).selectExpr("id % 3 AS k", "id AS day", "id", "CAST(id % 7 AS INT) AS v").write.parquet(str(tmp_path / "fact"))
    plan = rolled(spark.read.parquet(str(tmp_path / "fact")), 3, 8)._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "fact") not in plan and "Broadcast" not in plan


@pytest.mark.parametrize("day", [
    "IF(id % 4 = 0, NULL, 7)", "CAST(IF(id % 5 = 0, 'NaN', IF(id % 7 = 0, 'Infinity', CAST(id % 9 AS STRING))) AS DOUBLE)",
    "IF(id % 6 = 0, NULL, CAST(IF(id % 5 = 0, '-Infinity', CAST(id % 9 AS STRING)) AS DOUBLE))", "CAST(id % 3 AS STRING)",
    "1152921504606846976 + id % 4", "id % 2 = 0",
])
def test_awkward_order_values(spark, rows, day):
    df = spark.range(120).selectExpr("id % 2 AS k", f"{day} AS day", "(id * 71) % 120 AS id", "CAST(id AS INT) AS v")
    split, plain = rolled(df, 3, 17), rolled(df, 3, None)
    assert [str(r) for r in split.orderBy("id").collect()] == [str(r) for r in plain.orderBy("id").collect()]


def test_slices_rise_with_the_order(spark):
    cut = range_slices(series(spark, 21, length=400), [F.col(c) for c in ("k", "day", "id")], 30)
    before = F.lag(SLICE).over(Window.orderBy("k", "day", "id"))
    assert cut.withColumn("before", before).filter(F.col("before") > F.col(SLICE)).count() == 0
    assert cut.select(SLICE).distinct().count() > 20


def test_columns_and_their_order(spark):
    assert rolled(series(spark, 1), 3, 10).columns == ["k", "day", "id", "v", "mean", "n"]
