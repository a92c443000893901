"""The star-schema tables read as a league.

Nations are teams, parts are players, orders are fixtures and line items are the
players' matches, so every table is used whole. Columns are renamed and coded the
way the landed records are, so that the silver and gold transforms apply as is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from matchday.functions.projection import project
from matchday.plans import gold, silver

# Matches of one player, fixture and month can repeat; ordering by the measured
# values as well makes the newest rows well defined.
FORM_TIE_BREAK = ["fixture_id", "total_points", "minutes", "expected_goals", "expected_assists"]


@dataclass(frozen=True)
class Star:
    """The tables of one directory."""

    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path.rstrip('/')}/{name}.parquet")


class League(Star):
    """Landed-record shapes over the star tables, and the layers built from them."""

    @cached_property
    def bronze_teams(self) -> DataFrame:
        strengths = [
            f"1000 + 10 * n_regionkey + {i} AS {name}" for i, name in enumerate(silver.STRENGTHS)
        ]
        return self.table("nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS id", "CAST(n_nationkey + 100 AS BIGINT) AS code", "n_name AS name",
            "right(n_name, 3) AS short_name", *strengths,
        )

    @cached_property
    def bronze_players(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS id", "p_name AS web_name", "p_type AS first_name", "p_brand AS second_name",
            "concat(p_partkey, '.jpg') AS photo", "CAST(substring(p_brand, 7) AS BIGINT) AS team",
            "CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'MEDIUM' THEN 2 WHEN 'STANDARD' THEN 3 "
            "WHEN 'LARGE' THEN 3 WHEN 'PROMO' THEN 4 END AS element_type",
            "CAST(p_size + 35 AS BIGINT) AS now_cost", "CAST(floor(p_retailprice / 10) AS BIGINT) AS total_points",
            "CAST(p_retailprice AS STRING) AS form", "CAST(p_size AS STRING) AS selected_by_percent",
            "CASE WHEN p_size % 10 = 0 THEN 'i' ELSE 'a' END AS status",
            "CASE WHEN p_size % 10 = 0 THEN 25L END AS chance_of_playing_next_round",
        )

    @cached_property
    def bronze_fixtures(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS id", "CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS event",
            "o_custkey % 25 AS team_h", "o_orderkey % 27 AS team_a",
            "1 + o_custkey % 5 AS team_h_difficulty", "1 + o_orderkey % 5 AS team_a_difficulty",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 4 END AS team_h_score",
            "CASE WHEN o_orderstatus = 'F' THEN o_custkey % 4 END AS team_a_score",
            "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS finished",
            "CASE WHEN o_orderkey % 50 <> 0 THEN date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END "
            "AS kickoff_time",
        )

    @cached_property
    def bronze_history(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_partkey AS player_id", "l_orderkey AS fixture",
            "CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS round", "l_suppkey % 25 AS opponent_team",
            "CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS was_home",
            "CAST(l_quantity AS BIGINT) AS total_points", "CAST(l_quantity AS BIGINT) * 7 % 91 AS minutes",
            "l_linenumber % 3 AS goals_scored", "l_linenumber % 2 AS assists", "l_orderkey % 2 AS clean_sheets",
            "l_orderkey % 4 AS goals_conceded", "l_partkey % 2 AS yellow_cards", "l_partkey % 3 AS red_cards",
            "l_suppkey % 4 AS bonus", "l_suppkey % 50 AS bps", "CAST(abs(l_discount) AS STRING) AS expected_goals",
            "CAST(abs(l_tax) AS STRING) AS expected_assists", "CAST(floor(l_extendedprice / 100) AS BIGINT) AS value",
        )

    @cached_property
    def teams(self) -> DataFrame:
        return silver.silver_teams(self.bronze_teams)

    @cached_property
    def players(self) -> DataFrame:
        return silver.silver_players(self.bronze_players, self.teams)

    @cached_property
    def fixtures(self) -> DataFrame:
        return silver.silver_fixtures(self.bronze_fixtures, self.teams)

    @cached_property
    def stats(self) -> DataFrame:
        return silver.silver_stats(self.bronze_history, self.players, self.fixtures)

    @cached_property
    def form(self) -> DataFrame:
        """From the match rows alone: the dimension columns of the stats are not used,
        and joins on unique keys would neither add nor remove rows."""
        return gold.player_form(project(self.bronze_history, silver.HISTORY_FIELDS), tie_break=FORM_TIE_BREAK)

    @cached_property
    def value(self) -> DataFrame:
        return gold.player_value(self.players)

    @cached_property
    def difficulty(self) -> DataFrame:
        return gold.upcoming_difficulty(project(self.bronze_fixtures, silver.FIXTURE_FIELDS))

    @cached_property
    def scores(self) -> DataFrame:
        return gold.recommendation_scores(self.form, self.value, self.difficulty, self.players, in_order=False)
