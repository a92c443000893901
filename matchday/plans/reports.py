"""The views a front end reads: rankings, line-up, totals and gameweek."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchday import schemas
from matchday.functions.scalars import badge_url, fixed, full_name, portrait_url
from matchday.operators.lineup import squad_order, squad_summary
from matchday.operators.ranking import top_n, top_n_per_key
from matchday.operators.squad_rules import BUDGET, CandidateColumns
from matchday.plans.silver import POSITIONS
from matchday.sources.tables import Warehouse

# List lengths of the report pages.
TOP_PER_POSITION = 20
TOP_OVERALL = 10

PLACE_OF = {label: place for place, label in enumerate(POSITIONS.values(), start=1)}


def position_order(position: str = "position"):
    """Positions in line-up order, from the goalkeeper forward."""
    pairs = [F.lit(x) for pair in PLACE_OF.items() for x in pair]
    return F.create_map(*pairs)[F.col(position)]


def rankings(scores: DataFrame, n: int = TOP_PER_POSITION) -> DataFrame:
    """The best players of each position, ready for display."""
    listed = scores.filter(F.col("position").isin(list(PLACE_OF)))
    best = top_n_per_key(listed, ["position"], "recommendation_score", n, ["player_id"], rank="place")
    return best.select(
        "player_id", "position", position_order().alias("position_order"), "place",
        full_name(F.col("first_name"), F.col("second_name")).alias("full_name"),
        portrait_url(F.col("photo")).alias("portrait_url"),
        badge_url(F.col("team_code")).alias("badge_url"),
        fixed(F.col("cost_millions"), 1, "M").alias("cost"),
        fixed(F.col("avg_points_recent"), 1).alias("form"),
        fixed(F.col("points_per_million"), 2).alias("points_per_million"),
        fixed(F.col("avg_upcoming_difficulty"), 1, "/5").alias("calendar"),
        fixed(F.col("recommendation_score"), 3).alias("score"),
    )


def top_players(scores: DataFrame, n: int = TOP_OVERALL) -> DataFrame:
    return top_n(scores, "recommendation_score", n, ["player_id"])


def lineup_cards(team: DataFrame, squad: Sequence[str] = (), cols: CandidateColumns = CandidateColumns()) -> DataFrame:
    """The starters with what their card shows, and their place in the line-up of their squad."""
    cards = squad_places(team.filter(F.col("is_starter")), squad, cols)
    return cards.select(
        *squad, "place", cols.id, "web_name", F.col(cols.position).alias("position"),
        position_order(cols.position).alias("position_order"),
        portrait_url(F.col("photo")).alias("portrait_url"),
        badge_url(F.col("team_code")).alias("badge_url"),
        fixed(F.col(cols.cost), 1, "M").alias("cost"),
        F.col(cols.score).alias("recommendation_score"),
    )


def squad_places(team: DataFrame, squad: Sequence[str] = (), cols: CandidateColumns = CandidateColumns()) -> DataFrame:
    """Each squad's players numbered in list order: starters before the bench, then by position, score and id."""
    order = Window.partitionBy(*squad).orderBy(*squad_order(position_order(cols.position), cols))
    return team.withColumn("place", F.row_number().over(order))


def squad_list(team: DataFrame) -> DataFrame:
    """One whole squad, starters before the bench."""
    return team.orderBy(*squad_order(position_order()))


def with_total_texts(totals: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Totals with their display texts."""
    of_budget = f"M / {budget:.1f}M"
    return totals.select(
        "*",
        fixed(F.col("total_cost"), 1, of_budget).alias("total_cost_text"),
        fixed(F.col("starters_cost"), 1, of_budget).alias("starters_cost_text"),
        fixed(F.col("starters_score"), 3).alias("starters_score_text"),
    )


def team_totals(team: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Totals of one squad, per position and in all, as numbers and as text."""
    return with_total_texts(squad_summary(team, []), budget)


def gameweek_badge(current_gameweek: DataFrame) -> DataFrame:
    """One row with the gameweek's name, NULL when the table is empty."""
    return current_gameweek.agg(F.first("name").alias("name"))


#: The columns a front end reads, by view: the layer table it is read from and the fields it leaves out.
SERVED = {
    "serving_rankings": ("player_recommendation_scores", schemas.GOLD_SCORES, {"player_id"}),
    "serving_lineups": ("lineups", schemas.GOLD_LINEUPS, {"player_id", "team_id"}),
    "serving_gameweek": ("current_gameweek", schemas.CURRENT_GAMEWEEK, set()),
}


def register_views(warehouse: Warehouse) -> list[str]:
    """Temporary views over the gold tables that exist, with the declared fields a front end reads; returns their names."""
    made = []
    for view, (table, schema, hidden) in SERVED.items():
        if warehouse.exists("gold", table):
            shown = [name for name in schema.names if name not in hidden]
            warehouse.read("gold", table).select(*shown).createOrReplaceTempView(view)
            made.append(view)
    return made
