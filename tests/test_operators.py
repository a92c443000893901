from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.functions import scalars
from matchday.functions.projection import Field, cast_failures, project
from matchday.operators import quality
from matchday.operators.ranking import (
    current_or_next, latest_n_agg, latest_where, ordering, ranked, top_n, top_n_per_key,
)
from matchday.operators.rolling import rolling_last_n
from matchday.operators.shaping import left_join_dim, union_sides, unpivot_sides
from matchday.sources.frames import drop_null_type_columns, single_row, with_payload


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("num,den,expected", [(100, 12.5, 8.0), (10, 0.0, 0.0), (10, None, 0.0), (None, 2.0, None), (1, -1.0, 0.0)])
def test_safe_ratio(spark, num, den, expected):
    assert value(spark, scalars.safe_ratio(F.lit(num).cast("double"), F.lit(den).cast("double"))) == expected


@pytest.mark.parametrize("difficulty,expected", [(1.0, 1.0), (5.0, 0.0), (None, 0.5), (2.0, 0.75)])
def test_favourability(spark, difficulty, expected):
    assert value(spark, scalars.favourability(F.lit(difficulty).cast("double"))) == expected


def test_display_columns(spark):
    null = F.lit(None).cast("string")
    assert value(spark, scalars.full_name(F.lit("A"), F.lit("B"))) == "A B"
    assert value(spark, scalars.full_name(F.lit("A"), null)) is None
    assert value(spark, scalars.portrait_url(F.lit("42.jpg"))).endswith("/p42.png")
    assert value(spark, scalars.portrait_url(null)) is None
    assert value(spark, scalars.badge_url(F.lit(8))).endswith("/t8.png")
    assert value(spark, scalars.fixed(F.lit(7), 1, "M")) == "7.0M"
    assert value(spark, scalars.fixed(null, 1)) is None


def test_projection_and_lost_values(spark, rows):
    df = spark.createDataFrame([("1", "2.5"), ("x", None), (None, "y")], "a STRING, b STRING")
    fields = [Field("n", "a", "int"), Field("half", "b", "double", 2)]
    assert rows(project(df, fields, strict=False)) == [
        {"n": 1, "half": 1.25}, {"n": None, "half": None}, {"n": None, "half": None}]
    assert rows(cast_failures(df, fields)) == [{"column": "n", "violations": 1}, {"column": "half", "violations": 1}]


def test_null_type_columns_are_dropped_at_any_depth(spark):
    schema = T.StructType([
        T.StructField("keep", T.LongType()), T.StructField("gone", T.NullType()),
        T.StructField("array", T.ArrayType(T.NullType())), T.StructField("map", T.MapType(T.StringType(), T.NullType())),
        T.StructField("deep", T.StructType([T.StructField("x", T.ArrayType(T.NullType()))])),
        T.StructField("fine", T.ArrayType(T.StructType([T.StructField("y", T.LongType())]))),
    ])
    assert drop_null_type_columns(spark.createDataFrame([], schema)).columns == ["keep", "fine"]


def test_payload_keeps_nulls_and_the_row(spark, rows):
    df = spark.createDataFrame([(1, None)], "a INT, b STRING")
    assert rows(with_payload(df)) == [{"a": 1, "b": None, "raw_payload": '{"a":1,"b":null}'}]


def test_single_row(spark, rows):
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType())])
    assert rows(single_row(spark, {"a": "x"}, schema)) == [{"b": None, "a": "x"}]


def test_unpivot_equals_union_of_selects(spark, rows):
    df = spark.createDataFrame([(1, 2, 3, 4), (5, 1, 2, 9)], "h INT, a INT, dh INT, da INT")
    sides = [{"team": F.col(s), "d": F.col(f"d{s}")} for s in "ha"]
    plain = union_sides(df.selectExpr("h AS team", "dh AS d"), df.selectExpr("da AS d", "a AS team"))
    assert rows(unpivot_sides(df, sides), "team", "d") == rows(plain, "team", "d")
    with pytest.raises(ValueError):
        unpivot_sides(df, [{"x": F.col("h")}, {"y": F.col("a")}])


def test_latest_n_equals_last_of_rolling(spark, rows):
    df = spark.range(300).selectExpr("id % 7 AS k", "(id * 37) % 101 AS t", "id", "(id * 13) % 29 AS v")
    latest = latest_n_agg(df, ["k"], ["t", "id"], 3, {"m": F.avg("v"), "n": F.count("v")})
    series = rolling_last_n(df, ["k"], ["t", "id"], 3, {"m": F.avg("v"), "n": F.count("v")}, ["v"])
    last = series.groupBy("k").agg(*[F.max_by(c, F.struct("t", "id")).alias(c) for c in ("m", "n")])
    assert rows(latest, "k") == rows(last, "k")


def test_latest_where_and_current_or_next(spark, rows):
    df = spark.createDataFrame(
        [(0, 1, True, False, False), (1, 2, True, False, False), (2, 3, False, False, True), (3, 4, False, None, True)],
        "pos INT, id INT, finished BOOLEAN, cur BOOLEAN, nxt BOOLEAN")
    assert rows(latest_where(df, [], F.col("finished"), ["pos"], ["id"])) == [{"id": 2}]
    assert rows(latest_where(df, [], F.col("id") > 9, ["pos"], ["id"])) == []
    assert rows(current_or_next(df, F.col("cur"), F.col("nxt"), ["pos"], ["id"])) == [{"id": 3}]
    assert rows(current_or_next(df, F.col("id") == 4, F.col("nxt"), ["pos"], ["id"])) == [{"id": 4}]
    assert rows(current_or_next(df, F.col("cur"), F.lit(False), ["pos"], ["id"])) == []


def test_top_n(spark, rows):
    df = spark.range(40).selectExpr("id", "id % 3 AS k", "id % 5 AS s")
    best = rows(top_n_per_key(df, ["k"], "s", 2, ["id"], rank="place"), "k", "place")
    assert [(r["k"], r["place"], r["id"]) for r in best] == [(0, 1, 9), (0, 2, 24), (1, 1, 4), (1, 2, 19), (2, 1, 14), (2, 2, 29)]
    assert [r["id"] for r in top_n(df, "s", 3, ["id"]).collect()] == [4, 9, 14]
    assert [r["id"] for r in ranked(df, "s", ["id"]).limit(2).collect()] == [4, 9]
    nulls = spark.createDataFrame([(1, None), (2, 5)], "id INT, t INT").orderBy(*ordering(["t"], nulls="last"))
    assert [r["id"] for r in nulls.collect()] == [2, 1]


def test_skewed_join_is_split_when_the_dimension_is_too_large_to_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    keep = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        fact = spark.range(0, 60000, 1, 8).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS v")
        dim = spark.range(-1, 60000).selectExpr("id AS k", "id * 2 AS w")
        joined = left_join_dim(fact, dim, "k", ["w"])
        assert joined.agg(F.count("*"), F.count("w"), F.sum(F.col("w") - 2 * F.col("k"))).first()[:] == (60000, 60000, 0)
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_blocking_checks(spark):
    df = spark.createDataFrame([(1,), (1,)], "id INT")
    checks = quality.report([quality.check_unique(df, "t", ["id"]), quality.check_rules(df, "t", {"r": F.col("id") > 5})])
    with pytest.raises(quality.QualityError, match=r"t: unique\(id\) = 1"):
        quality.require_clean(checks)
    quality.require_clean(checks, blocking=["r"])


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "boolean"])
def test_lenient_casts_equal_try_cast(spark, rows, kind):
    texts = ["1", " 7 ", "\t-3\n", "+4", "1.5", "1e3", "1E-2", "5-LOW", "", " ", "nan", "NaN", "Infinity", "-inf", "0x1p3",
             "1d", "2F", "true", "T", " yes", "No", "f", "0", "99999999999", "1.", ".5", "--1", "1 2", "12a", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    lenient = project(df, [Field("t"), Field("x", "t", kind)], strict=False)
    plain = df.select("t", F.col("t").try_cast(kind).alias("x"))
    assert [str(r) for r in lenient.collect()] == [str(r) for r in plain.collect()]


def test_fixed_rounds_the_exact_double_half_to_even(spark):
    rnd = random.Random(4)
    values = [2.25, 0.15, 5.625, 0.5, 1.5, 2.5, -0.04, -2.25, 0.0, 1e15, 123456789.125, None]
    values += [rnd.uniform(-500, 500) for _ in range(300)] + [rnd.randint(-4000, 4000) / 16 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 3):
        found = [r[0] for r in df.select(scalars.fixed(F.col("v"), digits, "M")).collect()]
        assert found == [None if v is None else f"{v:.{digits}f}M" for v in values]
