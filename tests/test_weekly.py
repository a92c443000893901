from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest

from landed import TEAMS, land, league
from matchday import schemas
from matchday.operators import lineup
from matchday.operators.squad_rules import SquadRules
from matchday.plans import reports, weekly
from matchday.sinks import RunLog, TableSink
from matchday.sources import landing
from matchday.sources.frames import drop_null_type_columns
from matchday.sources.tables import Warehouse

RUN_TS = datetime(2025, 4, 2, 6, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def data():
    return league()


@pytest.fixture(scope="module")
def landed(tmp_path_factory, data):
    return land(tmp_path_factory.mktemp("landing"), data)


def squads_of(spark, data):
    """Two given squads: per position, the first players of different clubs."""
    chosen = []
    for squad, skip in (("one", 0), ("two", 4)):
        for code, n in ((1, 2), (2, 5), (3, 5), (4, 3)):
            fit = [p for p in data["bootstrap"]["elements"] if p["element_type"] == code and p["status"] == "a"]
            one_each = {p["team"]: p["id"] for p in reversed(fit)}
            chosen += [(squad, one_each[t]) for t in sorted(one_each)[skip + code:skip + code + n]]
    return spark.createDataFrame(chosen, "squad STRING, player_id BIGINT")


@pytest.fixture(scope="module")
def run(spark, landed, data):
    return weekly.run_weekly(spark, landed, "full_", RUN_TS, squads=squads_of(spark, data))


@pytest.fixture(scope="module")
def tables(spark, run):
    assert run.completed
    return Warehouse(spark, "full_")


def test_records_keep_payload_order_and_types(spark, rows, landed, data):
    source = weekly.Landing(spark, landed)
    players = rows(source.players(), "id")
    assert [json.loads(r["raw_payload"]) for r in players] == data["bootstrap"]["elements"]
    assert players[0]["chance_of_playing_next_round"] is None
    assert [r["pos"] for r in rows(source.gameweeks(), "id")] == list(range(6))
    history = source.history()
    assert history.count() == sum(map(len, data["history"].values()))
    for r in history.limit(50).collect():
        assert json.loads(r["raw_payload"])["element"] == r["player_id"]
    assert [(r["gameweek_id"], r["id"]) for r in rows(source.live(), "id")] == [(3, 1), (3, 2)]
    assert json.loads(source.live().first()["stats"])["minutes"] in (0, 90)


def test_malformed_documents_fail_or_are_set_aside(spark, rows, tmp_path):
    for name, text in {"1": '{"history":[{"fixture":1}]}', "2": "<html>no json</html>", "3": '{"other":[]}',
                       "4": '{"history":[{"fixture":1', "5": '{"history":[]}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    documents = landing.with_path_key(landing.read_documents(spark, str(tmp_path)), "player_id")
    with pytest.raises(Exception, match="malformed JSON document"):
        landing.records(documents, "history").collect()
    good = landing.records(documents, "history", ("player_id",), mode="quarantine")
    assert [r["player_id"] for r in rows(good)] == [1]
    assert [r["player_id"] for r in rows(landing.malformed_documents(documents, "history"), "player_id")] == [2, 3, 4]
    with pytest.raises(ValueError):
        landing.records(documents, "history", mode="ignore")
    whole = documents.filter("player_id = 1")
    assert landing.malformed_documents(whole, landing.WHOLE).count() == 1


def test_lines_are_documents_too(spark, rows, tmp_path):
    (tmp_path / "all.jsonl").write_text('{"history":[{"fixture":1},{"fixture":2}]}\n{"history":[{"fixture":3}]}\n')
    documents = landing.read_documents(spark, str(tmp_path), line_delimited=True)
    typed = landing.typed(landing.records(documents, "history"), schemas.HISTORY_RECORD)
    assert [r["fixture"] for r in rows(typed, "fixture")] == [1, 2, 3]


def test_extra_fields_by_inference(spark, rows, landed):
    documents = landing.read_documents(spark, f"{landed}/bootstrap.json")
    found = landing.records(documents, "elements")
    full = landing.complete_schema(schemas.PLAYER_RECORD, landing.infer_schema(found))
    assert full.names[: len(schemas.PLAYER_RECORD)] == schemas.PLAYER_RECORD.names
    assert set(full.names) - set(schemas.PLAYER_RECORD.names) == {"news", "squad_number"}
    kept = drop_null_type_columns(landing.typed(found, full))
    assert kept.columns == [*schemas.PLAYER_RECORD.names, landing.RAW]
    assert kept.count() == TEAMS * 12


def test_bronze_has_every_field_that_has_a_type(spark, landed, tables):
    history = tables.read("bronze", "player_gameweek_history").columns
    assert history == ["player_id", *schemas.HISTORY_RECORD.names, "element", "raw_payload", "ingestion_ts"]
    assert "played" in tables.read("bronze", "teams_snapshot").columns
    assert not {"news", "squad_number"} & set(tables.read("bronze", "players_snapshot").columns)
    declared = weekly.Landing(spark, landed, all_fields=False)
    assert declared.history().columns == ["player_id", *schemas.HISTORY_RECORD.names, "raw_payload"]


def test_tables_have_the_declared_layout(tables):
    expected = {
        ("silver", "teams"): schemas.SILVER_TEAMS, ("silver", "players"): schemas.SILVER_PLAYERS,
        ("silver", "fixtures"): schemas.SILVER_FIXTURES, ("silver", "player_gameweek_stats"): schemas.SILVER_STATS,
        ("silver", "current_gameweek"): schemas.CURRENT_GAMEWEEK, ("bronze", "current_gameweek"): schemas.CURRENT_GAMEWEEK,
        ("gold", "current_gameweek"): schemas.CURRENT_GAMEWEEK, ("gold", "player_form"): schemas.GOLD_FORM,
        ("gold", "player_value"): schemas.GOLD_VALUE, ("gold", "upcoming_fixtures_difficulty"): schemas.GOLD_DIFFICULTY,
        ("gold", "player_recommendation_scores"): schemas.GOLD_SCORES, ("gold", "lineups"): schemas.GOLD_LINEUPS,
    }
    for (layer, table), schema in expected.items():
        assert tables.read(layer, table).dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields], table


def test_counts_and_one_ingestion_time(rows, run, tables, data):
    counts = {r["table"]: r["n"] for r in rows(run.counts)}
    players = data["bootstrap"]["elements"]
    assert counts["bronze.players_snapshot"] == counts["silver.players"] == len(players)
    assert counts["silver.player_gameweek_stats"] == sum(map(len, data["history"].values()))
    assert counts["gold.player_recommendation_scores"] == sum(p["status"] == "a" for p in players)
    assert counts["gold.lineups"] == 30
    for table in ("players_snapshot", "teams_snapshot", "fixtures_snapshot", "player_gameweek_history"):
        times = tables.read("bronze", table).selectExpr("unix_seconds(ingestion_ts) AS at").distinct().collect()
        assert [t["at"] for t in times] == [int(RUN_TS.timestamp())]


def test_current_gameweek_is_carried_through(rows, tables):
    for layer in ("bronze", "silver", "gold"):
        assert [r["name"] for r in rows(tables.read(layer, "current_gameweek"))] == ["Gameweek 3"]


def test_lineups_obey_the_rules(rows, tables):
    team = tables.read("gold", "lineups")
    checked = rows(lineup.squad_check(team, ["squad"], budget=10_000.0))
    assert len(checked) == 14 and not any(r["violated"] for r in checked)
    for squad in ("one", "two"):
        starting = [r["position"] for r in rows(team) if r["is_starter"] and r["squad"] == squad]
        assert len(starting) == 11
        assert all(low <= starting.count(p) <= high for p, (low, high) in SquadRules().lineup_bounds.items())


def test_quality_is_clean(rows, tables):
    assert sum(r["violations"] for r in rows(tables.read("audit", "silver_quality"))) == 0


def test_audit_rows(rows, run, tables, data):
    log = [r for r in rows(tables.read("audit", "run_log")) if r["run_id"] == run.run_id]
    assert {r["status"] for r in log} == {"started", "completed"}
    done = {(r["step"], r["table"]): r for r in log if r["status"] == "completed"}
    assert done[("bronze_write", "players_snapshot")]["row_count"] == len(data["bootstrap"]["elements"])
    assert {"bronze", "silver", "gold", "lineups"} <= {step for step, _ in done}
    assert all(r["duration_s"] >= 0 for r in done.values())


def test_reports(spark, rows, tables):
    scores = tables.read("gold", "player_recommendation_scores")
    both = tables.read("gold", "lineups")
    ranking = rows(reports.rankings(scores), "position_order", "place")
    assert [p for p in dict.fromkeys(r["position"] for r in ranking)] == ["GKP", "DEF", "MID", "FWD"]
    assert all([r["place"] for r in ranking if r["position"] == p] == list(range(1, 21)) for p in ("DEF", "MID"))
    first = ranking[0]
    assert first["cost"].endswith("M") and first["calendar"].endswith("/5") and first["full_name"].startswith("First ")
    cards = rows(reports.lineup_cards(both, ["squad"]), "squad", "place")
    assert [r["place"] for r in cards] == [*range(1, 12)] * 2
    assert [r["position_order"] for r in cards[:11]] == sorted(r["position_order"] for r in cards[:11])
    team = both.filter("squad = 'one'")
    totals = {r["position"]: r for r in rows(reports.team_totals(team))}
    members = rows(team)
    assert totals[None]["total_cost"] == pytest.approx(sum(r["cost_millions"] for r in members))
    starters = [r for r in members if r["is_starter"]]
    assert totals[None]["starters_score_text"] == f"{sum(r['recommendation_score'] for r in starters):.3f}"
    assert totals[None]["starters_cost_text"] == f"{sum(r['cost_millions'] for r in starters):.1f}M / 100.0M"
    assert totals["GKP"]["starters"] == 1 and totals["GKP"]["players"] == 2
    assert [r["is_starter"] for r in reports.squad_list(team).collect()] == [True] * 11 + [False] * 4
    assert len(reports.top_players(scores).collect()) == 10
    assert rows(reports.gameweek_badge(tables.read("gold", "current_gameweek"))) == [{"name": "Gameweek 3"}]
    assert rows(reports.gameweek_badge(tables.read("gold", "current_gameweek").limit(0))) == [{"name": None}]
    assert reports.register_views(tables) == ["serving_rankings", "serving_lineups", "serving_gameweek"]
    assert "player_id" not in spark.table("serving_rankings").columns
    assert spark.sql("SELECT count(*) AS n FROM serving_lineups WHERE is_starter").first()["n"] == 22
    assert spark.sql("SELECT name FROM serving_gameweek").first()["name"] == "Gameweek 3"


def test_a_second_run_replaces_the_tables(spark, landed, tables, run):
    again = weekly.run_weekly(spark, landed, "full_", RUN_TS)
    assert again.completed and again.run_id != run.run_id
    assert tables.read("silver", "teams").count() == TEAMS


def test_no_finished_gameweek_stops_after_players_and_teams(spark, tmp_path):
    path = land(tmp_path / "early", league(finished=0, current=None, following=1))
    result = weekly.run_weekly(spark, path, "early_", RUN_TS)
    tables = Warehouse(spark, "early_")
    assert not result.completed
    assert tables.exists("bronze", "teams_snapshot") and tables.exists("bronze", "players_snapshot")
    assert not tables.exists("bronze", "fixtures_snapshot") and not tables.exists("bronze", "current_gameweek")


def test_next_gameweek_and_missing_gameweek(spark, rows, tmp_path):
    upcoming = weekly.Landing(spark, land(tmp_path / "next", league(current=None, following=4))).gameweeks()
    assert rows(weekly.current_gameweek(upcoming))[0]["name"] == "Gameweek 4"
    assert rows(weekly.last_finished(upcoming)) == [{"id": 3, "name": "Gameweek 3", "data_checked": False}]
    path = land(tmp_path / "none", league(current=None, following=None))
    with pytest.raises(weekly.NoGameweek):
        weekly.run_weekly(spark, path, "none_", RUN_TS)
    log = rows(Warehouse(spark, "none_").read("audit", "run_log"))
    failed = [r for r in log if r["status"] == "failed"]
    assert [(r["step"], r["error_type"]) for r in failed] == [("bronze", "NoGameweek")]


def test_empty_input_keeps_the_old_table(spark, rows):
    warehouse = Warehouse(spark, "keep_")
    warehouse.create_layers()
    sink = TableSink(warehouse, RunLog(warehouse))
    full = spark.range(3)
    sink.write(full, "bronze", "t", keep_if_empty=True)
    assert sink.write(full.limit(0), "bronze", "t", keep_if_empty=True).count() == 3
    assert sink.write(full.limit(0), "bronze", "t").count() == 0
    changed = sink.write(full.selectExpr("CAST(id AS STRING) AS name", "1 AS n"), "bronze", "t")
    assert changed.columns == ["name", "n"]


def test_blocking_quality_stops_before_gold(spark, tmp_path):
    broken = league(seed=4)
    broken["bootstrap"]["elements"][0]["team"] = 99
    path = land(tmp_path / "broken", broken)
    with pytest.raises(Exception, match="orphan"):
        weekly.run_weekly(spark, path, "broken_", RUN_TS, blocking=True)
    assert not Warehouse(spark, "broken_").exists("gold", "player_form")


def test_quarantine_keeps_the_good_and_writes_the_bad(spark, rows, tmp_path):
    data = league(seed=6)
    path = land(tmp_path / "bad", data)
    elements = data["bootstrap"]["elements"]
    broken = {**elements[0], "id": 9001, "now_cost": "dear"}
    (tmp_path / "bad" / "bootstrap.json").write_text(json.dumps({**data["bootstrap"], "elements": [*elements, broken, None]}))
    (tmp_path / "bad" / "element-summary" / "9002.json").write_text("<html>")
    (tmp_path / "bad" / "element-summary" / "9003.json").write_text('{"history_past":[]}')
    whole = json.dumps(data["fixtures"])
    (tmp_path / "bad" / "fixtures.json").write_text(whole[:-40])
    with pytest.raises(Exception, match="malformed|MALFORMED"):
        weekly.run_weekly(spark, path, "bad_", RUN_TS)
    result = weekly.run_weekly(spark, path, "bad_", RUN_TS, mode="quarantine")
    tables = Warehouse(spark, "bad_")
    assert result.completed
    assert tables.read("bronze", "players_snapshot").count() == len(elements)
    assert tables.read("bronze", "fixtures_snapshot").count() == len(data["fixtures"]) - 1
    assert tables.read("bronze", "player_gameweek_history").count() == sum(map(len, data["history"].values()))
    found = rows(tables.read("audit", "quarantine"))
    assert all(r["ingestion_ts"] is not None for r in found)
    assert sorted((r["source"], r["source_path"].rsplit("/", 1)[1], r["pos"], r["reason"]) for r in found if r["pos"] is not None) == [
        ("bootstrap.json:elements", "bootstrap.json", len(elements), landing.NOT_THE_SCHEMA),
        ("bootstrap.json:elements", "bootstrap.json", len(elements) + 1, landing.NO_RECORD),
        ("fixtures.json:[]", "fixtures.json", len(data["fixtures"]) - 1, landing.NOT_JSON)]
    assert sorted((r["source_path"].rsplit("/", 1)[1], r["reason"], r["raw_payload"]) for r in found if r["pos"] is None) == [
        ("9002.json", landing.NOT_JSON, "<html>"), ("9003.json", landing.NO_ARRAY, '{"history_past":[]}')]


def test_a_failing_write_leaves_the_old_table(spark, rows):
    warehouse = Warehouse(spark, "swap_")
    warehouse.create_layers()
    sink = TableSink(warehouse, RunLog(warehouse))
    sink.write(spark.range(5), "silver", "t")
    bad = spark.range(9).selectExpr("IF(id = 7, CAST(raise_error('no') AS BIGINT), id) AS id")
    with pytest.raises(Exception, match="no"):
        sink.write(bad, "silver", "t")
    assert tables_of(spark, "swap_silver") == ["t"] and warehouse.read("silver", "t").count() == 5
    # A table may be rewritten from itself; a run cut off between the renames is put right.
    assert sink.write(warehouse.read("silver", "t").selectExpr("id + 1 AS id"), "silver", "t").agg({"id": "max"}).first()[0] == 5
    spark.sql("ALTER TABLE swap_silver.t RENAME TO swap_silver.t__old")
    assert warehouse.exists("silver", "t") and warehouse.read("silver", "t").count() == 5
    assert tables_of(spark, "swap_silver") == ["t"]


def tables_of(spark, database):
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def test_resume_after_a_failure_in_gold(spark, rows, tmp_path, monkeypatch):
    path = land(tmp_path / "again", league(seed=8))
    tables = Warehouse(spark, "again_")

    def fails(*_):
        raise RuntimeError("gold is broken")

    with monkeypatch.context() as broken:
        broken.setattr(weekly.gold, "player_value", fails)
        with pytest.raises(RuntimeError):
            weekly.run_weekly(spark, path, "again_", RUN_TS)
    files = sorted(tables.read("silver", "players").inputFiles())
    second = weekly.run_weekly(spark, path, "again_", RUN_TS, resume=True)
    assert second.completed and sorted(tables.read("silver", "players").inputFiles()) == files
    events = [r for r in rows(tables.read("audit", "run_log")) if r["run_id"] == second.run_id]
    assert {(r["step"], r["status"]) for r in events if r["table"] is None} == {
        ("bronze", "reused"), ("silver", "reused"), ("gold", "started"), ("gold", "completed")}
    assert not any(r["step"] in ("bronze_write", "silver_write") for r in events)
    # Everything is finished, then the input changes.
    third = weekly.run_weekly(spark, path, "again_", RUN_TS, resume=True)
    assert {r["status"] for r in rows(tables.read("audit", "run_log")) if r["run_id"] == third.run_id} == {"reused"}
    (tmp_path / "again" / "event" / "4.json").write_text('{"elements": []}')
    fourth = weekly.run_weekly(spark, path, "again_", RUN_TS, resume=True)
    assert any(r["step"] == "bronze_write" for r in rows(tables.read("audit", "run_log")) if r["run_id"] == fourth.run_id)
    assert sorted(tables.read("silver", "players").inputFiles()) != files


def test_types_of_all_key_paths(spark, rows):
    texts = ['{"a":1,"b":{"c":null,"VARIANT":2},"d":[1,2.5,null],"e":[]}', '{"a":2.5,"b":{"c":null},"d":null,"f":{}}', '{"a":null,"g":1}',
             '{"g":"x","h":[{"i":true},{"j":12345678901234567890}]}', None, "no json"]
    df = spark.createDataFrame([(t,) for t in texts], f"{landing.RAW} STRING").repartition(3)
    seen = {(".".join(r["path"]), r["type"]): r["n"] for r in rows(landing.observed_types(df))}
    assert seen[("", "object")] == 4 and seen[("", "invalid")] == 2 and seen[("b.c", "null")] == 2 and seen[("d.[]", "double")] == 1
    inferred = landing.infer_schema(df.filter("raw_payload LIKE '{%'"))
    assert inferred.simpleString() == (
        "struct<a:double,b:struct<VARIANT:bigint,c:void>,d:array<double>,e:array<void>,f:string,g:string,"
        "h:array<struct<i:boolean,j:double>>>")
    assert landing.infer_schema(df.limit(0)).names == []
