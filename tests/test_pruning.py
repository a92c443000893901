from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from matchday.operators import squad
from matchday.operators.pruning import dominance_prune
from matchday.operators.squad_rules import SquadRules

SCHEMA = "g STRING, id BIGINT, pos STRING, club INT, cost BIGINT, score DOUBLE, note STRING"


def plain_prune(rows, same_bound, club_bound):
    """Every pair of candidates, by the definition."""
    kept = set()
    parts = {}
    for r in rows:
        if r[2] is not None and r[5] is not None and r[4] is not None:
            parts.setdefault((r[0], r[2]), []).append(r)
    bound = lambda b, pos: b if isinstance(b, int) else b[pos]
    for (_, pos), members in parts.items():
        for p in members:
            better = [q[3] for q in members if q is not p and q[4] <= p[4] and q[5] >= p[5]
                      and (q[5] > p[5] or q[4] < p[4] or q[1] < p[1])]
            if better.count(p[3]) < bound(same_bound, pos) and len(set(better)) < bound(club_bound, pos):
                kept.add((p[0], p[1]))
    return kept


def candidates(seed, n, clubs, levels, scores):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), i, rng.choice("XY"), rng.randrange(clubs), rng.randrange(levels), float(rng.randrange(scores)), "n")
            for i in range(n)]
    rows += [("a", n, None, 1, 1, 1.0, "n"), ("a", n + 1, "X", 1, None, 1.0, "n"), ("a", n + 2, "X", 1, 1, None, "n"),
             (None, n + 3, "X", None, 3, 2.0, "n"), (None, n + 4, "X", None, 3, 2.0, "n"), (None, n + 5, "X", None, 4, 1.0, None)]
    return rows


@pytest.mark.parametrize("seed,n,clubs,levels,scores,same,club,slices", [
    (1, 300, 12, 40, 30, 3, 7, 9), (2, 400, 25, 400, 400, 2, 4, 20), (3, 200, 3, 8, 6, 1, 1, 5), (4, 500, 40, 5000, 1000, 3, 9, 128),
    (5, 300, 6, 300, 5, {"X": 3, "Y": 1}, {"X": 2, "Y": 5}, 16), (6, 250, 30, 1, 50, 2, 6, 8)])
def test_prune_equals_the_definition(spark, seed, n, clubs, levels, scores, same, club, slices):
    rows = candidates(seed, n, clubs, levels, scores)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = dominance_prune(df, ["g"], "pos", "club", F.col("cost"), "score", "id", same, club, slices)
    assert kept.columns == df.columns
    assert sorted((r["g"] or "", r["id"]) for r in kept.collect()) == sorted((g or "", i) for g, i in plain_prune(rows, same, club))


def test_many_price_levels_use_many_slices_and_no_python(spark):
    """Costs and scores that rise together: nothing is dominated at its own level, and every candidate is looked at."""
    df = spark.range(20_000).selectExpr("'a' AS g", "id", "'X' AS pos", "CAST(id % 50 AS INT) AS club", "id AS cost",
                                        "CAST(IF(id % 4 = 0, id, id / 2) AS DOUBLE) AS score", "'n' AS note").repartition(4)
    kept = dominance_prune(df, ["g"], "pos", "club", F.col("cost"), "score", "id", 3, 7, 40)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Arrow", "Python", "Pandas", "CartesianProduct"))
    assert kept.filter("id % 4 = 0").count() == 5000
    # Of the others, those with fewer than 7 clubs that score no less at no more.
    best, expected = [], 0
    for i in range(20_000):
        score = i if i % 4 == 0 else i / 2
        if i % 4:
            above = [j for j in range(i - i % 4, -1, -4)[:60] if j >= score]
            clubs = {j % 50 for j in above}
            expected += len(clubs) < 7 and sum(j % 50 == i % 50 for j in above) < 3
    assert kept.filter("id % 4 <> 0").count() == expected


def test_league_bounds(spark):
    rows = candidates(9, 400, 20, 900, 300)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "id AS player_id", "IF(pos = 'X', 'GKP', 'MID') AS position", "club AS team_id", "cost / 10 AS cost_millions",
        "score AS recommendation_score")
    rules = SquadRules()
    listed = [(None, r["player_id"], r["position"], r["team_id"], None if r["cost_millions"] is None else round(r["cost_millions"] * 10),
               r["recommendation_score"]) for r in df.collect() if r["cost_millions"] is not None and r["cost_millions"] <= 100]
    expected = {i for _, i in plain_prune(listed, rules.same_club_bound(), rules.club_bound())}
    assert {r["player_id"] for r in squad.prune_candidates(df).collect()} == expected
