"""Cleaned, typed and joined tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.projection import Field, project
from matchday.functions.scalars import decode_codes, pick_side
from matchday.operators.quality import TableChecks, check_tables, outside
from matchday.operators.shaping import left_join_dim

# Position code book.
POSITIONS = {1: "GKP", 2: "DEF", 3: "MID", 4: "FWD"}

# Landed prices are in tenths.
PRICE_UNITS = 10

STRENGTHS = [f"strength_{part}_{side}" for part in ("overall", "attack", "defence") for side in ("home", "away")]
MATCH_COUNTS = [
    "total_points", "minutes", "goals_scored", "assists", "clean_sheets", "goals_conceded",
    "yellow_cards", "red_cards", "bonus", "bps",
]

TEAM_FIELDS = [
    Field("team_id", "id"),
    Field("team_code", "code"),
    Field("team_name", "name"),
    Field("short_name"),
    *[Field(name, data_type="int") for name in STRENGTHS],
]

# ``position`` holds the code until it is decoded.
PLAYER_FIELDS = [
    Field("player_id", "id"),
    Field("web_name"),
    Field("first_name"),
    Field("second_name"),
    Field("photo"),
    Field("team_id", "team"),
    Field("position", "element_type"),
    Field("cost_millions", "now_cost", "double", PRICE_UNITS),
    Field("total_points", data_type="int"),
    Field("form", data_type="double"),
    Field("selected_by_percent", data_type="double"),
    Field("status"),
    Field("chance_of_playing_next_round", data_type="int"),
]

FIXTURE_FIELDS = [
    Field("fixture_id", "id"),
    Field("gameweek_id", "event", "bigint"),
    Field("team_h_id", "team_h"),
    Field("team_a_id", "team_a"),
    *[Field(f"team_{side}_{what}", data_type="int") for what in ("difficulty", "score") for side in "ha"],
    Field("finished", data_type="boolean"),
    Field("kickoff_time", data_type="timestamp"),
]

HISTORY_FIELDS = [
    Field("player_id"),
    Field("fixture_id", "fixture"),
    Field("gameweek_id", "round", "bigint"),
    Field("opponent_team_id", "opponent_team"),
    Field("was_home", data_type="boolean"),
    *[Field(name, data_type="int") for name in MATCH_COUNTS],
    Field("expected_goals", data_type="double"),
    Field("expected_assists", data_type="double"),
    Field("cost_at_match_millions", "value", "double", PRICE_UNITS),
]


def silver_teams(bronze_teams: DataFrame, strict: bool = True) -> DataFrame:
    return project(bronze_teams, TEAM_FIELDS, strict)


def silver_players(bronze_players: DataFrame, teams: DataFrame, strict: bool = True) -> DataFrame:
    """Decoded position, price in millions, team name; players of unknown teams stay."""
    players = project(bronze_players, PLAYER_FIELDS, strict)
    players = players.withColumn("position", decode_codes(F.col("position"), POSITIONS))
    return left_join_dim(players, teams, "team_id", ["team_name", "team_code"])


def silver_fixtures(bronze_fixtures: DataFrame, teams: DataFrame, strict: bool = True) -> DataFrame:
    """The team dimension in two roles, home and away."""
    fixtures = project(bronze_fixtures, FIXTURE_FIELDS, strict)
    for side in "ha":
        role = {"team_id": f"team_{side}_id", "team_name": f"team_{side}_name"}
        fixtures = left_join_dim(fixtures, teams, f"team_{side}_id", role)
    return fixtures


def silver_stats(bronze_history: DataFrame, players: DataFrame, fixtures: DataFrame, strict: bool = True) -> DataFrame:
    """One row per player and fixture, with the difficulty of the player's side."""
    sides = ["team_h_difficulty", "team_a_difficulty"]
    stats = project(bronze_history, HISTORY_FIELDS, strict)
    stats = left_join_dim(stats, players, "player_id", ["web_name", "position", "team_id"])
    stats = left_join_dim(stats, fixtures, "fixture_id", sides)
    difficulty = pick_side(F.col("was_home"), *[F.col(s) for s in sides])
    return stats.withColumn("difficulty", difficulty).drop(*sides)


def silver_quality(bronze_players: DataFrame, teams: DataFrame, players: DataFrame, fixtures: DataFrame,
                   stats: DataFrame) -> DataFrame:
    """The checks that guard the silver and gold writes, with one scan of each table."""
    return check_tables([
        TableChecks("player_gameweek_stats", stats, unique=[["player_id", "fixture_id"]]),
        TableChecks("teams", teams, unique=[["team_id"]]),
        TableChecks("players", players, unique=[["player_id"]], references={"team_id": ("teams", "team_id")}),
        TableChecks("fixtures", fixtures, unique=[["fixture_id"]],
                    references={c: ("teams", "team_id") for c in ("team_h_id", "team_a_id")},
                    rules={f"range({c})": outside(c, 1, 5) for c in ("team_h_difficulty", "team_a_difficulty")}),
        TableChecks("players_snapshot", bronze_players, rules={
            "range(element_type)": outside("element_type", min(POSITIONS), max(POSITIONS))}),
    ])
