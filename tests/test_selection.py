from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from matchday.operators import lineup
from matchday.operators.squad_rules import CandidateColumns, SquadRules

LINE = CandidateColumns("id", "position", "club", "cost", "score")


def brute_lineup(members, rules):
    best = None
    for team in combinations(members, rules.lineup_size):
        counts = {p: sum(r[1] == p for r in team) for p in rules.lineup_bounds}
        if all(low <= counts[p] <= high for p, (low, high) in rules.lineup_bounds.items()):
            total = sum(r[4] for r in team)
            best = total if best is None else max(best, total)
    return best


def test_lineups_equal_exhaustive_search(spark, rows):
    rng = np.random.default_rng(7)
    rules, data, expected = SquadRules(), [], {}
    for s in range(30):
        members = []
        for name, n in rules.position_limits.items():
            members += [(s * 100 + len(members) + i, name, i, 50.0, float(rng.integers(0, 200)) / 16) for i in range(n)]
        expected[s] = brute_lineup(members, rules)
        data += [(s, *m) for m in members]
    squads = spark.createDataFrame(data, "squad INT, id INT, position STRING, club INT, cost DOUBLE, score DOUBLE")
    totals = rows(lineup.squad_totals(lineup.mark_starters(squads, ["squad"], cols=LINE), ["squad"], LINE), "squad")
    assert {r["squad"]: r["total_score"] for r in totals} == expected
    assert {r["starters"] for r in totals} == {11}
    best = {r["squad"]: r["total"] for r in rows(lineup.best_formation(squads, ["squad"], cols=LINE))}
    assert best == expected


def test_lineup_without_a_valid_formation(spark, rows):
    data = [(1, i, "MID", i, 5.0, 1.0) for i in range(15)]
    squads = spark.createDataFrame(data, "squad INT, id INT, position STRING, club INT, cost DOUBLE, score DOUBLE")
    assert not any(r["is_starter"] for r in rows(lineup.mark_starters(squads, ["squad"], cols=LINE)))
    with pytest.raises(Exception, match="no valid formation"):
        lineup.mark_starters(squads, ["squad"], cols=LINE, strict=True).collect()


def test_formations_are_the_eight_usual_ones():
    assert len(SquadRules().formations()) == 8
    assert SquadRules().club_bound() == {"GKP": 6, "DEF": 9, "MID": 9, "FWD": 7}


def test_squad_check_names_each_broken_rule(spark, rows):
    data = [(1, i, "GKP" if i < 3 else "MID", 0 if i < 4 else i, 10.0, 1.0) for i in range(11)]
    squads = spark.createDataFrame(data, "squad INT, id INT, position STRING, club INT, cost DOUBLE, score DOUBLE")
    found = {r["rule"]: (r["actual"], r["violated"]) for r in rows(lineup.squad_check(squads, ["squad"], cols=LINE))}
    assert found == {
        "squad_size": (11.0, True), "budget": (110.0, True), "club_limit": (4.0, True), "position_GKP": (3.0, True),
        "position_DEF": (0.0, True), "position_MID": (8.0, True), "position_FWD": (0.0, True),
    }


def test_starters_of_odd_squads_equal_a_plain_choice(spark, rows):
    """Unknown positions, missing and equal scores, squads of any size and without a line-up."""
    rng = np.random.default_rng(11)
    data = [
        (s, s * 100 + i, ["GKP", "DEF", "MID", "FWD", None][rng.integers(5)], 0, 1.0,
         None if rng.random() < 0.05 else float(rng.integers(-3, 12)))
        for s in range(60) for i in range(rng.integers(8, 26))
    ]
    expected = set()
    for s in range(60):
        listed = {p: sorted((r for r in data if r[0] == s and r[2] == p and r[5] is not None), key=lambda r: (-r[5], r[1]))
                  for p in SquadRules().lineup_bounds}
        best = None
        for split in SquadRules().formations():
            team = [r for p, n in split.items() for r in listed[p][:n]]
            name = "-".join(str(split[p]) for p in ("DEF", "MID", "FWD"))
            if len(team) == 11 and (best is None or (-sum(r[5] for r in team), name) < best[0]):
                best = (-sum(r[5] for r in team), name), team
        expected |= {r[1] for r in best[1]} if best else set()
    squads = spark.createDataFrame(data, "squad INT, id INT, position STRING, club INT, cost DOUBLE, score DOUBLE").repartition(3)
    assert {r["id"] for r in rows(lineup.mark_starters(squads, ["squad"], cols=LINE)) if r["is_starter"]} == expected
    assert lineup.mark_starters(squads, ["squad"], cols=LINE).count() == len(data)
    assert lineup.mark_starters(squads.limit(0), ["squad"], cols=LINE).count() == 0


def test_summary_levels(spark, rows):
    data = [("a", 1, "GKP", 1, 0.1, 3.0, True), ("a", 2, "DEF", 1, 0.2, None, False), (None, 3, None, 1, 0.7, 1.5, True),
            (None, 4, "DEF", 1, None, 1.25, True)]
    marked = spark.createDataFrame(data, "squad STRING, id INT, position STRING, club INT, cost DOUBLE, score DOUBLE, is_starter BOOLEAN")
    found = {(r["level"], r["squad"], r["position"]): (r["players"], r["starters"], r["total_cost"], r["starters_cost"], r["starters_score"])
             for r in rows(lineup.squad_summary(marked, ["squad"], LINE))}
    assert found == {
        ("position", "a", "GKP"): (1, 1, 0.1, 0.1, 3.0), ("position", "a", "DEF"): (1, 0, 0.2, None, None),
        ("position", None, None): (1, 1, 0.7, 0.7, 1.5), ("position", None, "DEF"): (1, 1, None, None, 1.25),
        ("squad", "a", None): (2, 1, 0.3, 0.1, 3.0), ("squad", None, None): (2, 2, 0.7, 0.7, 2.75),
        ("all", None, None): (4, 3, 1.0, 0.8, 5.75)}
    assert {r["level"] for r in rows(lineup.squad_summary(marked, [], LINE))} == {"position", "all"}


def test_a_squad_without_a_name_and_a_repeated_player(spark, rows):
    pool = [("GKP", 2), ("DEF", 5), ("MID", 5), ("FWD", 3)]
    members, player = [], 0
    for position, n in pool:
        for _ in range(n):
            player += 1
            members.append((player, position, player % 7, 5.0, float(player)))
    data = [(squad, *m) for squad in (None, "a") for m in members] + [("a", 1, "GKP", 1, 5.0, 1.0)]
    squads = spark.createDataFrame(data, "squad STRING, id INT, pos STRING, club INT, cost DOUBLE, score DOUBLE")
    cols = CandidateColumns("id", "pos", "club", "cost", "score")
    for strict in (False, True):
        marked = rows(lineup.mark_starters(squads, ["squad"], cols=cols, strict=strict))
        assert len(marked) == len(data)
        assert sum(r["is_starter"] for r in marked if r["squad"] is None) == 11
        assert sum(r["is_starter"] for r in marked if r["squad"] == "a") == 11
