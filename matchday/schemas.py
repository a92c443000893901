"""Declared schemas of the landed records and of every published table."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
TEXT, FLAG, TIME = T.StringType(), T.BooleanType(), T.TimestampType()


def _struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    """Fields in order, given as runs of names that share a type."""
    return T.StructType([
        T.StructField(name, data_type) for data_type, names in groups for name in names.split()
    ])


_STRENGTHS = (
    "strength_overall_home strength_overall_away strength_attack_home strength_attack_away "
    "strength_defence_home strength_defence_away"
)
_MATCH_COUNTS = (
    "total_points minutes goals_scored assists clean_sheets goals_conceded yellow_cards red_cards bonus bps"
)

# Fields of the landed JSON records that later layers read. Any other field
# stays available in ``raw_payload``.
TEAM_RECORD = _struct((LONG, "id code"), (TEXT, "name short_name"), (LONG, "strength " + _STRENGTHS))
PLAYER_RECORD = _struct(
    (LONG, "id"), (TEXT, "web_name first_name second_name photo"),
    (LONG, "team element_type now_cost total_points"), (TEXT, "form selected_by_percent status"),
    (LONG, "chance_of_playing_next_round"),
)
FIXTURE_RECORD = _struct(
    (LONG, "id event team_h team_a team_h_difficulty team_a_difficulty team_h_score team_a_score"),
    (FLAG, "finished"), (TEXT, "kickoff_time"),
)
HISTORY_RECORD = _struct(
    (LONG, "fixture round opponent_team"), (FLAG, "was_home"), (LONG, _MATCH_COUNTS),
    (TEXT, "expected_goals expected_assists"), (LONG, "value"),
)
GAMEWEEK_RECORD = _struct(
    (LONG, "id"), (TEXT, "name deadline_time"), (FLAG, "finished data_checked is_current is_next")
)
LIVE_RECORD = _struct((LONG, "id"), (TEXT, "stats"))

# Published tables, in column order.
CURRENT_GAMEWEEK = _struct((TEXT, "deadline_time"), (FLAG, "finished"), (LONG, "gameweek_id"), (TEXT, "name"))
SILVER_TEAMS = _struct((LONG, "team_id team_code"), (TEXT, "team_name short_name"), (INT, _STRENGTHS))
SILVER_PLAYERS = _struct(
    (LONG, "team_id player_id"), (TEXT, "web_name first_name second_name photo position"),
    (DOUBLE, "cost_millions"), (INT, "total_points"), (DOUBLE, "form selected_by_percent"), (TEXT, "status"),
    (INT, "chance_of_playing_next_round"), (TEXT, "team_name"), (LONG, "team_code"),
)
SILVER_FIXTURES = _struct(
    (LONG, "team_a_id team_h_id fixture_id gameweek_id"),
    (INT, "team_h_difficulty team_a_difficulty team_h_score team_a_score"), (FLAG, "finished"),
    (TIME, "kickoff_time"), (TEXT, "team_h_name team_a_name"),
)
SILVER_STATS = _struct(
    (LONG, "fixture_id player_id gameweek_id opponent_team_id"), (FLAG, "was_home"), (INT, _MATCH_COUNTS),
    (DOUBLE, "expected_goals expected_assists cost_at_match_millions"), (TEXT, "web_name position"),
    (LONG, "team_id"), (INT, "difficulty"),
)
GOLD_FORM = _struct(
    (LONG, "player_id"),
    (DOUBLE, "avg_points_recent avg_minutes_recent avg_expected_goals_recent avg_expected_assists_recent"),
    (LONG, "matches_in_window"),
)
GOLD_VALUE = _struct(
    (LONG, "player_id"), (TEXT, "web_name position team_name"), (DOUBLE, "cost_millions"), (INT, "total_points"),
    (DOUBLE, "selected_by_percent points_per_million"),
)
GOLD_DIFFICULTY = _struct(
    (LONG, "team_id"), (DOUBLE, "avg_upcoming_difficulty"), (LONG, "upcoming_fixtures_count")
)
GOLD_SCORES = _struct(
    (LONG, "player_id"), (TEXT, "web_name first_name second_name photo position"), (LONG, "team_id team_code"),
    (DOUBLE, "cost_millions avg_points_recent points_per_million avg_upcoming_difficulty recommendation_score"),
)
GOLD_LINEUPS = _struct(
    (TEXT, "squad"), (LONG, "player_id"), (TEXT, "web_name position"), (LONG, "team_id team_code"), (DOUBLE, "cost_millions"),
    (TEXT, "photo"), (DOUBLE, "recommendation_score"), (FLAG, "is_starter"),
)
RUN_LOG = _struct(
    (TEXT, "run_id step table status"), (TIME, "logged_at"), (DOUBLE, "duration_s"), (LONG, "row_count"),
    (TEXT, "error_type error input_version"),
)
QUARANTINE = _struct((TEXT, "source source_path"), (LONG, "pos"), (TEXT, "reason raw_payload"), (TIME, "ingestion_ts"))
