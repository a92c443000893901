"""The fixed selection rules and the columns selection works on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# Squad composition and budget.
BUDGET = 100.0
POSITION_LIMITS = {"GKP": 2, "DEF": 5, "MID": 5, "FWD": 3}
CLUB_LIMIT = 3

# How many starters a valid line-up has, in all and per position.
LINEUP_SIZE = 11
LINEUP_BOUNDS = {"GKP": (1, 1), "DEF": (3, 5), "MID": (2, 5), "FWD": (1, 3)}

# Costs are multiples of one tenth.
UNITS_PER_COST = 10


@dataclass(frozen=True)
class SquadRules:
    """How many players per position, how many per club, and the line-up bounds."""

    position_limits: Mapping[str, int] = field(default_factory=lambda: dict(POSITION_LIMITS))
    club_limit: int = CLUB_LIMIT
    lineup_size: int = LINEUP_SIZE
    lineup_bounds: Mapping[str, tuple[int, int]] = field(default_factory=lambda: dict(LINEUP_BOUNDS))
    units_per_cost: int = UNITS_PER_COST

    @property
    def size(self) -> int:
        return sum(self.position_limits.values())

    def same_club_bound(self) -> dict[str, int]:
        """Better players of the same club that make a candidate unnecessary."""
        return {p: min(limit, self.club_limit) for p, limit in self.position_limits.items()}

    def club_bound(self) -> dict[str, int]:
        """Clubs with a better player that make a candidate unnecessary: the other
        members fill at most ``(size - 1) // club_limit`` clubs and hold at most
        ``limit - 1`` players of the position, so one of these clubs is free."""
        full = (self.size - 1) // self.club_limit
        return {p: limit + full for p, limit in self.position_limits.items()}

    def formations(self) -> list[dict[str, int]]:
        """Every valid split of the starters over the positions."""
        names = list(self.lineup_bounds)
        ranges = [range(low, high + 1) for low, high in self.lineup_bounds.values()]
        splits = (dict(zip(names, counts)) for counts in product(*ranges))
        return [s for s in splits if sum(s.values()) == self.lineup_size]


@dataclass(frozen=True)
class CandidateColumns:
    """Names of the candidate columns."""

    id: str = "player_id"
    position: str = "position"
    club: str = "team_id"
    cost: str = "cost_millions"
    score: str = "recommendation_score"

    def units(self, per_cost: int) -> Column:
        """Cost as a whole number of units; a cost that is none fails the job."""
        scaled = F.col(self.cost) * per_cost
        units = F.round(scaled)
        partial = F.raise_error(F.concat(F.lit("cost is not a whole number of units: "), F.col(self.cost).cast("string")))
        return F.when(F.abs(scaled - units) > 1e-6, partial).otherwise(units).cast("bigint")


def by_position(values: Mapping[str, int], position: Column) -> Column:
    """The per-position constant of each row."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[position]
