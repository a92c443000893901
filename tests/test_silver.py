from __future__ import annotations

import pytest

from matchday import schemas
from matchday.plans import silver


def bronze(spark, schema, *records, extra=""):
    """Records over a declared schema; fields not given are NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in records], schema)


def team_dim(spark, *pairs):
    return spark.createDataFrame([(i, n, 100 + i) for i, n in pairs], "team_id BIGINT, team_name STRING, team_code BIGINT")


def test_teams_are_renamed_cast_and_narrowed(spark, rows):
    strengths = {n: 1000 + i for i, n in enumerate(silver.STRENGTHS)}
    raw = bronze(spark, schemas.TEAM_RECORD, {"id": 7, "code": 70, "name": "Rovers", "short_name": "ROV", "strength": 4, **strengths})
    out = silver.silver_teams(raw.selectExpr("*", "3 AS played"))
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.SILVER_TEAMS.fields]
    assert rows(out) == [{"team_id": 7, "team_code": 70, "team_name": "Rovers", "short_name": "ROV", **strengths}]


@pytest.mark.parametrize("code,label", [(1, "GKP"), (2, "DEF"), (3, "MID"), (4, "FWD"), (5, None), (None, None)])
def test_position_codes(spark, rows, code, label):
    raw = bronze(spark, schemas.PLAYER_RECORD, {"id": 1, "team": 1, "element_type": code})
    assert rows(silver.silver_players(raw, team_dim(spark, (1, "A"))))[0]["position"] == label


def test_player_prices_and_text_numbers(spark, rows):
    raw = bronze(spark, schemas.PLAYER_RECORD, {
        "id": 9, "web_name": "Nine", "team": 1, "element_type": 4, "now_cost": 125, "total_points": 88, "form": "5.5",
        "selected_by_percent": "31.2", "status": "a",
    })
    out = silver.silver_players(raw, team_dim(spark, (1, "A")))
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.SILVER_PLAYERS.fields]
    row = rows(out)[0]
    assert (row["cost_millions"], row["form"], row["selected_by_percent"]) == (12.5, 5.5, 31.2)
    assert (row["team_name"], row["team_code"], row["chance_of_playing_next_round"]) == ("A", 101, None)


def test_player_of_unknown_team_is_kept(spark, rows):
    raw = bronze(spark, schemas.PLAYER_RECORD, {"id": 1, "team": 99}, {"id": 2, "team": 1}, {"id": 3})
    out = rows(silver.silver_players(raw, team_dim(spark, (1, "A"))), "player_id")
    assert [r["team_name"] for r in out] == [None, "A", None]


def test_fixture_roles_and_kickoff(spark, rows):
    raw = bronze(spark, schemas.FIXTURE_RECORD, {
        "id": 5, "event": 3, "team_h": 1, "team_a": 2, "team_h_difficulty": 2, "team_a_difficulty": 4,
        "finished": False, "kickoff_time": "2025-03-01T12:30:00Z",
    })
    out = silver.silver_fixtures(raw, team_dim(spark, (1, "Home"), (2, "Away")))
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.SILVER_FIXTURES.fields]
    row = rows(out.selectExpr("*", "unix_seconds(kickoff_time) AS at"))[0]
    assert (row["team_h_name"], row["team_a_name"], row["team_h_score"]) == ("Home", "Away", None)
    assert row["at"] == 1740832200


def stats_inputs(spark):
    players = spark.createDataFrame([(1, "One", "MID", 4)], "player_id BIGINT, web_name STRING, position STRING, team_id BIGINT")
    fixtures = spark.createDataFrame(
        [(10, 2, 5), (11, 3, 4)], "fixture_id BIGINT, team_h_difficulty INT, team_a_difficulty INT"
    )
    return players, fixtures


def test_two_matches_in_one_gameweek_stay_two_rows(spark, rows):
    players, fixtures = stats_inputs(spark)
    raw = bronze(
        spark, schemas.HISTORY_RECORD,
        {"fixture": 10, "round": 6, "was_home": True, "expected_goals": "0.75", "value": 81},
        {"fixture": 11, "round": 6, "was_home": False, "expected_goals": "0.10", "value": 81},
    ).selectExpr("CAST(1 AS BIGINT) AS player_id", "*")
    out = silver.silver_stats(raw, players, fixtures)
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.SILVER_STATS.fields]
    got = rows(out, "fixture_id")
    assert [r["gameweek_id"] for r in got] == [6, 6]
    assert [r["difficulty"] for r in got] == [2, 4]
    assert [(r["expected_goals"], r["cost_at_match_millions"], r["position"]) for r in got] == [
        (0.75, 8.1, "MID"), (0.10, 8.1, "MID")
    ]


def test_unknown_side_takes_the_away_difficulty(spark, rows):
    players, fixtures = stats_inputs(spark)
    raw = bronze(spark, schemas.HISTORY_RECORD, {"fixture": 10, "round": 1}).selectExpr("CAST(8 AS BIGINT) AS player_id", "*")
    row = rows(silver.silver_stats(raw, players, fixtures))[0]
    assert (row["difficulty"], row["web_name"]) == (5, None)


def test_strict_casts_fail_and_lenient_casts_give_null(spark, rows):
    raw = bronze(spark, schemas.PLAYER_RECORD, {"id": 1, "team": 1, "form": "n/a"})
    teams = team_dim(spark, (1, "A"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.silver_players(raw, teams).collect()
    assert rows(silver.silver_players(raw, teams, strict=False))[0]["form"] is None


def test_quality_report_counts_every_violation(spark, rows):
    teams = team_dim(spark, (1, "A"), (2, "B"))
    bronze_players = bronze(spark, schemas.PLAYER_RECORD, {"id": 1, "team": 1, "element_type": 7},
                            {"id": 2, "team": 3, "element_type": 2})
    players = silver.silver_players(bronze_players, teams)
    bronze_fixtures = bronze(
        spark, schemas.FIXTURE_RECORD,
        {"id": 1, "team_h": 1, "team_a": 2, "team_h_difficulty": 6, "team_a_difficulty": 3},
        {"id": 2, "team_h": 2, "team_a": 9, "team_h_difficulty": 1, "team_a_difficulty": None},
    )
    fixtures = silver.silver_fixtures(bronze_fixtures, teams)
    history = bronze(spark, schemas.HISTORY_RECORD, {"fixture": 1}, {"fixture": 1}).selectExpr("CAST(1 AS BIGINT) AS player_id", "*")
    stats = silver.silver_stats(history, players, fixtures)
    report = silver.silver_quality(bronze_players, teams, players, fixtures, stats)
    found = {(r["table"], r["check"]): r["violations"] for r in rows(report)}
    assert found == {
        ("player_gameweek_stats", "unique(player_id,fixture_id)"): 1,
        ("teams", "unique(team_id)"): 0, ("players", "unique(player_id)"): 0, ("fixtures", "unique(fixture_id)"): 0,
        ("players", "orphan(team_id)"): 1, ("fixtures", "orphan(team_h_id)"): 0, ("fixtures", "orphan(team_a_id)"): 1,
        ("players_snapshot", "range(element_type)"): 1,
        ("fixtures", "range(team_h_difficulty)"): 1, ("fixtures", "range(team_a_difficulty)"): 1,
    }
