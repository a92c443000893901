"""Analytics tables: form, value, calendar difficulty and the composite score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.scalars import favourability, safe_ratio, weighted_score
from matchday.operators.quality import check_rules, outside
from matchday.operators.ranking import latest_n_agg, next_n_agg, ranked
from matchday.operators.scaling import min_max_normalize
from matchday.operators.shaping import left_join_dim, unpivot_sides

# Window lengths and score weights.
RECENT_MATCHES = 3
UPCOMING_MATCHES = 3
WEIGHTS = {
    "avg_points_recent_norm": 0.4,
    "points_per_million_norm": 0.3,
    "fixture_favorability_norm": 0.3,
}

AVAILABLE = "a"

_FORM_INPUTS = {
    "avg_points_recent": "total_points",
    "avg_minutes_recent": "minutes",
    "avg_expected_goals_recent": "expected_goals",
    "avg_expected_assists_recent": "expected_assists",
}


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def player_form(stats: DataFrame, n: int = RECENT_MATCHES, tie_break: Sequence[str] | None = None) -> DataFrame:
    """Means over each player's last ``n`` matches (matches, not gameweeks). Matches of
    one gameweek are ordered by ``tie_break``, by default the fixture id if present."""
    if tie_break is None:
        tie_break = _present(stats, ["fixture_id"])
    measures = {name: F.avg(source) for name, source in _FORM_INPUTS.items()}
    measures["matches_in_window"] = F.count("total_points")
    return latest_n_agg(stats, ["player_id"], ["gameweek_id", *tie_break], n, measures)


def player_value(players: DataFrame) -> DataFrame:
    """Points per million at the current price."""
    return players.select(
        "player_id", "web_name", "position", "team_name", "cost_millions", "total_points", "selected_by_percent",
        safe_ratio(F.col("total_points"), F.col("cost_millions")).alias("points_per_million"),
    )


def upcoming_difficulty(fixtures: DataFrame, n: int = UPCOMING_MATCHES, nulls: str = "first") -> DataFrame:
    """Mean difficulty of each team's next ``n`` unplayed matches. A match without a
    date counts as the next one unless ``nulls="last"``."""
    tie_break = _present(fixtures, ["fixture_id"])
    sides = [
        {"team_id": F.col(f"team_{s}_id"), "difficulty": F.col(f"team_{s}_difficulty"), "side": F.lit(i)}
        for i, s in enumerate("ha")
    ]
    unplayed = fixtures.filter(~F.col("finished"))
    matches = unpivot_sides(unplayed, sides, keep=["kickoff_time", *tie_break])
    return next_n_agg(
        matches, ["team_id"], ["kickoff_time", *tie_break, "side"], n,
        {"avg_upcoming_difficulty": F.avg("difficulty"), "upcoming_fixtures_count": F.count("difficulty")},
        nulls,
    )


def recommendation_scores(form: DataFrame, value: DataFrame, difficulty: DataFrame, players: DataFrame,
                          in_order: bool = True) -> DataFrame:
    """Composite score of the available players. The form and value scales are set by
    all players, the unavailable ones included."""
    identity = ["player_id", "web_name", "first_name", "second_name", "photo", "position", "team_id", "team_code"]
    base = players.select(*identity, "status")
    base = left_join_dim(base, form, "player_id", ["avg_points_recent"])
    base = left_join_dim(base, value, "player_id", ["points_per_million", "cost_millions"])
    base = left_join_dim(base, difficulty, "team_id", ["avg_upcoming_difficulty"])
    scaled = min_max_normalize(base, ["avg_points_recent", "points_per_million"])
    scored = scaled.filter(F.col("status") == AVAILABLE).withColumn(
        "fixture_favorability_norm", favourability(F.col("avg_upcoming_difficulty"))
    )
    out = scored.select(
        *identity, "cost_millions", "avg_points_recent", "points_per_million", "avg_upcoming_difficulty",
        weighted_score(WEIGHTS).alias("recommendation_score"),
    )
    return ranked(out, "recommendation_score", ["player_id"]) if in_order else out


def gold_quality(scores: DataFrame) -> DataFrame:
    return check_rules(scores, "player_recommendation_scores", {
        "range(recommendation_score)": outside("recommendation_score", 0.0, 1.0),
    })
