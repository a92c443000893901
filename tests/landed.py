"""A small league written as landed documents."""

from __future__ import annotations

import json
import random
from pathlib import Path

TEAMS = 20
WEEKS = 6


def league(seed: int = 0, finished: int = 3, current: int | None = 3, following: int | None = 4,
           players_per_team: int = 12) -> dict:
    rng = random.Random(seed)
    strengths = [f"strength_{p}_{s}" for p in ("overall", "attack", "defence") for s in ("home", "away")]
    teams = [
        {"id": t, "code": 500 + t, "name": f"Team {t}", "short_name": f"T{t:02d}", "strength": 3, "played": finished,
         **{s: 1000 + 10 * t for s in strengths}}
        for t in range(1, TEAMS + 1)
    ]
    fixtures = []
    for week in range(1, WEEKS + 1):
        order = rng.sample(range(1, TEAMS + 1), TEAMS)
        for home, away in zip(order[::2], order[1::2]):
            done = week <= finished
            fixtures.append({
                "id": len(fixtures) + 1, "event": week, "team_h": home, "team_a": away,
                "team_h_difficulty": rng.randint(1, 5), "team_a_difficulty": rng.randint(1, 5),
                "team_h_score": rng.randint(0, 4) if done else None, "team_a_score": rng.randint(0, 4) if done else None,
                "finished": done, "kickoff_time": f"2025-0{week}-01T15:00:00Z", "stats": [],
            })
    players, history = [], {}
    for team in range(1, TEAMS + 1):
        for n in range(players_per_team):
            pid = len(players) + 1
            players.append({
                "id": pid, "web_name": f"Player {pid}", "first_name": "First", "second_name": f"Last{pid}",
                "photo": f"{9000 + pid}.jpg", "team": team, "element_type": (1, 2, 2, 2, 2, 3, 3, 3, 3, 3, 4, 4)[n % 12],
                "now_cost": rng.randint(40, 110), "total_points": rng.randint(0, 90), "form": f"{rng.random() * 9:.1f}",
                "selected_by_percent": f"{rng.random() * 50:.1f}", "status": "i" if pid % 17 == 0 else "a",
                "chance_of_playing_next_round": 25 if pid % 17 == 0 else None, "news": None, "squad_number": None,
            })
            history[pid] = [
                {"element": pid, "fixture": f["id"], "round": f["event"], "was_home": f["team_h"] == team,
                 "opponent_team": f["team_a"] if f["team_h"] == team else f["team_h"],
                 "total_points": rng.randint(0, 15), "minutes": 90, "goals_scored": 0, "assists": 1, "clean_sheets": 0,
                 "goals_conceded": 1, "yellow_cards": 0, "red_cards": 0, "bonus": 0, "bps": 12,
                 "expected_goals": "0.25", "expected_assists": "0.10", "value": 55}
                for f in fixtures if f["finished"] and team in (f["team_h"], f["team_a"])
            ]
    events = [
        {"id": w, "name": f"Gameweek {w}", "deadline_time": f"2025-0{w}-01T13:30:00Z", "finished": w <= finished,
         "data_checked": w < finished, "is_current": w == current, "is_next": w == following}
        for w in range(1, WEEKS + 1)
    ]
    return {"bootstrap": {"elements": players, "teams": teams, "events": events}, "fixtures": fixtures, "history": history}


def land(path: Path, data: dict) -> str:
    (path / "element-summary").mkdir(parents=True)
    (path / "event").mkdir()
    (path / "bootstrap.json").write_text(json.dumps(data["bootstrap"]))
    (path / "fixtures.json").write_text(json.dumps(data["fixtures"]))
    for player, rows in data["history"].items():
        body = {"fixtures": [], "history": rows, "history_past": []}
        (path / "element-summary" / f"{player}.json").write_text(json.dumps(body))
    live = {"elements": [{"id": 1, "stats": {"minutes": 90}}, {"id": 2, "stats": {"minutes": 0}}]}
    (path / "event" / "3.json").write_text(json.dumps(live))
    return str(path)
