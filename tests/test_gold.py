from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from matchday.operators.scaling import min_max_normalize
from matchday.plans import gold

STATS = (
    "player_id BIGINT, gameweek_id BIGINT, total_points BIGINT, minutes BIGINT, expected_goals DOUBLE, "
    "expected_assists DOUBLE"
)
FIXTURES = (
    "team_h_id BIGINT, team_a_id BIGINT, team_h_difficulty BIGINT, team_a_difficulty BIGINT, finished BOOLEAN, "
    "kickoff_time STRING"
)
PLAYERS = (
    "player_id BIGINT, web_name STRING, position STRING, team_id BIGINT, status STRING, first_name STRING, "
    "second_name STRING, photo STRING, team_code STRING"
)


def stats(spark, player, points, weeks=None):
    weeks = weeks or range(1, len(points) + 1)
    return spark.createDataFrame([(player, w, p, 90, p / 10, 0.0) for w, p in zip(weeks, points)], STATS)


@pytest.mark.parametrize("points,weeks,mean,matches", [
    ([1, 1, 12, 9, 3], None, 8.0, 3),
    ([3, 7], None, 5.0, 2),
    ([2, 9, 3], [1, 2, 2], 14 / 3, 3),
    ([50, 2, 9, 4], [1, 5, 5, 5], 5.0, 3),
])
def test_form_covers_the_last_matches(spark, rows, points, weeks, mean, matches):
    [row] = rows(gold.player_form(stats(spark, 1, points, weeks)))
    assert row["avg_points_recent"] == pytest.approx(mean)
    assert row["matches_in_window"] == matches
    assert row["avg_minutes_recent"] == 90.0


def test_form_is_per_player_and_ignores_nulls(spark, rows):
    one = stats(spark, 1, [10, 10, 10])
    two = stats(spark, 2, [1, 2]).union(spark.createDataFrame([(2, 9, None, 0, None, None)], STATS))
    out = rows(gold.player_form(one.union(two)), "player_id")
    assert [(r["avg_points_recent"], r["matches_in_window"]) for r in out] == [(10.0, 3), (1.5, 2)]
    assert out[1]["avg_minutes_recent"] == 60.0


def test_form_breaks_ties_by_fixture(spark, rows):
    tied = stats(spark, 1, [1, 2, 30, 4], [1, 1, 1, 1]).withColumn("fixture_id", F.col("total_points") * 10)
    assert rows(gold.player_form(tied))[0]["avg_points_recent"] == 12.0


def test_form_plan_limits_rows_before_its_only_shuffle(spark, capsys):
    gold.player_form(stats(spark, 1, [1, 2, 3, 4])).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("WindowGroupLimit") == 2


def test_value(spark, rows):
    schema = (
        "player_id BIGINT, web_name STRING, position STRING, team_name STRING, cost_millions DOUBLE, "
        "total_points BIGINT, selected_by_percent DOUBLE"
    )
    df = spark.createDataFrame(
        [(1, "a", "MID", "T", 8.0, 60, 1.0), (2, "b", "MID", "T", 0.0, 10, 1.0), (3, "c", "MID", "T", None, 10, 1.0),
         (4, "d", "MID", "T", 5.0, None, 1.0)], schema)
    assert [r["points_per_million"] for r in rows(gold.player_value(df), "player_id")] == [7.5, 0.0, 0.0, None]


def fixture(home, away, dh, da, finished, day):
    return (home, away, dh, da, finished, day and f"2025-01-{day:02d}T15:00:00Z")


def test_difficulty_uses_the_next_unplayed_matches_of_each_side(spark, rows):
    df = spark.createDataFrame([
        fixture(1, 2, 5, 5, True, 1), fixture(1, 3, 2, 4, False, 5), fixture(4, 1, 3, 3, False, 6),
        fixture(1, 2, 4, 1, False, 7), fixture(1, 5, 5, 5, False, 8), fixture(9, 8, 1, 1, None, 2),
    ], FIXTURES)
    out = {r["team_id"]: (r["avg_upcoming_difficulty"], r["upcoming_fixtures_count"]) for r in rows(gold.upcoming_difficulty(df))}
    assert out == {1: (3.0, 3), 2: (1.0, 1), 3: (4.0, 1), 4: (3.0, 1), 5: (5.0, 1)}


def test_undated_matches_come_first_unless_told_otherwise(spark, rows):
    df = spark.createDataFrame([fixture(1, 2, d, 1, False, day) for d, day in ((5, None), (1, 1), (1, 2), (1, 3))], FIXTURES)
    first = {r["team_id"]: r["avg_upcoming_difficulty"] for r in rows(gold.upcoming_difficulty(df))}
    last = {r["team_id"]: r["avg_upcoming_difficulty"] for r in rows(gold.upcoming_difficulty(df, nulls="last"))}
    assert first[1] == pytest.approx(7 / 3) and last[1] == 1.0


@pytest.mark.parametrize("values,expected", [
    ([0, 4, 8], [0.0, 0.5, 1.0]),
    ([6, 6], [0.5, 0.5]),
    ([6, None, 6], [0.5, 0.5, 0.5]),
    ([None, None], [0.5, 0.5]),
    ([2, None, 4], [0.0, None, 1.0]),
])
def test_min_max(spark, rows, values, expected):
    df = spark.createDataFrame(list(enumerate(values)), "id BIGINT, v BIGINT")
    assert [r["v_norm"] for r in rows(min_max_normalize(df, ["v"]), "id")] == expected


def test_min_max_of_several_columns_and_by_group(spark, rows):
    df = spark.createDataFrame([(1, "x", 0, 5), (2, "x", 10, 5), (3, None, 4, 6), (4, None, 8, 8)], "id INT, g STRING, a INT, b INT")
    out = rows(min_max_normalize(df, ["a", "b"]), "id")
    assert [(r["a_norm"], round(r["b_norm"], 3)) for r in out] == [(0.0, 0.0), (1.0, 0.0), (0.4, 0.333), (0.8, 1.0)]
    grouped = rows(min_max_normalize(df, ["a", "b"], by=["g"]), "id")
    assert [(r["a_norm"], r["b_norm"]) for r in grouped] == [(0.0, 0.5), (1.0, 0.5), (0.0, 0.0), (1.0, 1.0)]
    assert min_max_normalize(df, ["a"]).columns == ["id", "g", "a", "b", "a_norm"]


def score_inputs(spark, statuses=("a", "a", "a"), difficulties=((1, 1.0), (2, 5.0))):
    form = spark.createDataFrame([(1, 9.0), (2, 3.0), (3, 6.0)], "player_id BIGINT, avg_points_recent DOUBLE")
    value = spark.createDataFrame([(1, 20.0, 8.0), (2, 10.0, 5.0), (3, 15.0, 6.0)],
                                  "player_id BIGINT, points_per_million DOUBLE, cost_millions DOUBLE")
    difficulty = spark.createDataFrame(list(difficulties), "team_id BIGINT, avg_upcoming_difficulty DOUBLE")
    players = spark.createDataFrame(
        [(i, f"p{i}", "MID", i, status, "f", "s", "1.jpg", "3") for i, status in enumerate(statuses, start=1)], PLAYERS)
    return form, value, difficulty, players


def test_scores_exactly(spark):
    out = gold.recommendation_scores(*score_inputs(spark)).collect()
    assert [r["player_id"] for r in out] == [1, 3, 2]
    assert [round(r["recommendation_score"], 6) for r in out] == [1.0, 0.5, 0.0]
    assert out[1]["avg_upcoming_difficulty"] is None


def test_unavailable_players_leave_after_the_scale_is_set(spark, rows):
    out = rows(gold.recommendation_scores(*score_inputs(spark, ("i", "a", "a"))), "player_id")
    assert [(r["player_id"], round(r["recommendation_score"], 6)) for r in out] == [(2, 0.0), (3, 0.5)]


def test_missing_parts_count_as_zero_and_missing_calendar_as_neutral(spark, rows):
    form, value, _, players = score_inputs(spark)
    empty = spark.createDataFrame([], "team_id BIGINT, avg_upcoming_difficulty DOUBLE")
    out = rows(gold.recommendation_scores(form.filter("player_id <> 3"), value, empty, players), "player_id")
    assert [round(r["recommendation_score"], 6) for r in out] == [0.85, 0.15, 0.3]


def test_quality_of_scores(spark, rows):
    df = spark.createDataFrame([(0.5,), (1.2,), (None,)], "recommendation_score DOUBLE")
    assert rows(gold.gold_quality(df))[0]["violations"] == 2
