"""Candidates for a squad under budget, position and club limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.operators.pruning import dominance_prune
from matchday.operators.squad_rules import BUDGET, CandidateColumns, SquadRules


def prune_candidates(candidates: DataFrame, scenario: Sequence[str] = (), max_budget: float = BUDGET,
                     rules: SquadRules = SquadRules(), cols: CandidateColumns = CandidateColumns()) -> DataFrame:
    """Drop candidates that some best squad can always do without."""
    units = cols.units(rules.units_per_cost)
    eligible = candidates.filter(
        F.col(cols.position).isin(list(rules.position_limits)) & (F.col(cols.cost) <= max_budget)
    )
    return dominance_prune(
        eligible, scenario, cols.position, cols.club, units, cols.score, cols.id,
        rules.same_club_bound(), rules.club_bound(),
    )
