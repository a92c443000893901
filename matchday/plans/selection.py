"""Line-ups of given squads, in the published layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from matchday.operators.lineup import mark_starters
from matchday.operators.squad_rules import SquadRules

CANDIDATE = [
    "player_id", "web_name", "position", "team_id", "team_code", "cost_millions", "photo", "recommendation_score",
]


def lineups(scores: DataFrame, squads: DataFrame, squad: Sequence[str] = ("squad",), rules: SquadRules = SquadRules(),
            strict: bool = False) -> DataFrame:
    """``(squad, candidate columns, is_starter)`` of ``squads``, rows of (squad, player_id). Players without a score are left out of
    the squad: they cannot be chosen."""
    members = squads.select(*squad, "player_id").join(scores.select(*CANDIDATE), "player_id")
    return mark_starters(members.select(*squad, *CANDIDATE), list(squad), rules, strict=strict)
