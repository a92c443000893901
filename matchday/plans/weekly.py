"""The weekly batch: landed documents to bronze, silver, gold and the line-ups of given squads."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchday import schemas
from matchday.operators.quality import require_clean, table_counts
from matchday.operators.ranking import current_or_next, latest_where
from matchday.plans import gold, silver
from matchday.plans.selection import lineups
from matchday.sinks import RunLog, TableSink, finished_steps
from matchday.sources import landing
from matchday.sources.arrays import array_records
from matchday.sources.frames import contains_null_type
from matchday.sources.staging import staged
from matchday.sources.tables import Warehouse


class NoGameweek(ValueError):
    """The calendar names neither a current nor a next gameweek."""


@dataclass
class Landing:
    """Where the fetched documents are, and how they are read.

    ``mode`` treats malformed documents and records: ``failfast`` fails the job, ``quarantine`` sets them aside (see
    :meth:`quarantine`). With ``all_fields`` every field of the records becomes a column, at the price of one more pass to infer the
    types of the undeclared ones; without, those stay in ``raw_payload`` only. ``split_arrays`` reads documents that are one array
    with many tasks."""

    spark: SparkSession
    path: str
    mode: str = "failfast"
    all_fields: bool = True
    split_arrays: bool = True
    rejected: dict[str, DataFrame] = field(default_factory=dict)

    def _raw(self, name: str, array: str | None, key: str | None) -> DataFrame:
        path = f"{self.path.rstrip('/')}/{name}"
        if array is landing.WHOLE and key is None and self.split_arrays:
            return array_records(self.spark, path)
        documents = landing.read_documents(self.spark, path)
        if key:
            documents = landing.with_path_key(documents, key)
        return landing.raw_records(documents, array, (key,) if key else ())

    def _rows(self, name: str, array: str | None, schema: StructType, key: str | None = None) -> DataFrame:
        if self.mode not in ("failfast", "quarantine"):
            raise ValueError(f"unknown mode {self.mode!r}")
        keep = (key, landing.POS) if key else (landing.POS,)
        raw = self._raw(name, array, key)
        if self.mode == "failfast":
            problem = F.raise_error(F.concat(F.lit("malformed JSON document: "), F.coalesce(F.col(landing.PATH), F.lit("?"))))
            raw = raw.withColumn(landing.RAW, F.when(F.col(landing.REASON).isNull(), F.col(landing.RAW)).otherwise(problem))
        if self.all_fields:
            taken = (*keep, landing.RAW, "ingestion_ts")
            found = raw.filter(F.col(landing.REASON).isNull()) if self.mode == "quarantine" else raw
            schema = landing.complete_schema(schema, landing.infer_schema(found), taken)
        schema = StructType([f for f in schema.fields if not contains_null_type(f.dataType)])
        if self.mode == "failfast":
            return landing.typed(raw, schema, keep)
        # Parsed once: the accepted and the rejected rows are read from the staged table.
        parsed = staged(landing.sorted_out(raw, schema, (key,) if key else ()), "parsed")
        self.rejected[f"{name}:{array or '[]'}"] = landing.rejected(parsed)
        return landing.accepted(parsed, keep)

    def quarantine(self, run_ts: Column) -> DataFrame:
        """What the tables read so far did not accept, in the layout of ``audit.quarantine``."""
        empty = self.spark.createDataFrame([], schemas.QUARANTINE)
        rows = [df.withColumn("source", F.lit(source)).withColumn("ingestion_ts", run_ts).select(*schemas.QUARANTINE.names)
                for source, df in self.rejected.items()]
        return reduce(DataFrame.unionByName, rows, empty)

    def players(self) -> DataFrame:
        return self._rows("bootstrap.json", "elements", schemas.PLAYER_RECORD).drop(landing.POS)

    def teams(self) -> DataFrame:
        return self._rows("bootstrap.json", "teams", schemas.TEAM_RECORD).drop(landing.POS)

    def gameweeks(self) -> DataFrame:
        """The calendar, with the position of each gameweek in the document."""
        return self._rows("bootstrap.json", "events", schemas.GAMEWEEK_RECORD)

    def fixtures(self) -> DataFrame:
        return self._rows("fixtures.json", landing.WHOLE, schemas.FIXTURE_RECORD).drop(landing.POS)

    def history(self) -> DataFrame:
        """Every player's matches; the player is taken from the file name."""
        return self._rows("element-summary", "history", schemas.HISTORY_RECORD, "player_id").drop(landing.POS)

    def live(self) -> DataFrame:
        """Live statistics of each landed gameweek."""
        return self._rows("event", "elements", schemas.LIVE_RECORD, "gameweek_id").drop(landing.POS)


def last_finished(gameweeks: DataFrame) -> DataFrame:
    """The last finished gameweek in document order, or no row."""
    return latest_where(gameweeks, [], F.col("finished"), [landing.POS], ["id", "name", "data_checked"])


def current_gameweek(gameweeks: DataFrame) -> DataFrame:
    """The gameweek in progress, else the next one, in the published layout."""
    chosen = current_or_next(
        gameweeks, F.col("is_current"), F.col("is_next"), [landing.POS], ["id", "name", "deadline_time", "finished"]
    )
    return chosen.select("deadline_time", "finished", F.col("id").alias("gameweek_id"), "name")


def input_version(spark: SparkSession, landing_path: str) -> str:
    """A digest of the names, sizes and times of the landed files; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing_path)
    file = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    found = files.select("path", "length", "modificationTime").agg(F.count(F.lit(1)).alias("n"), F.sum(file).alias("digest")).first()
    return f"{found['n']}-{found['digest'] or 0}"


def load_bronze(source: Landing, sink: TableSink, run_ts: datetime) -> bool:
    """Write the raw tables. Returns False, after players and teams, when no gameweek
    has finished yet."""
    at = F.lit(run_ts)
    sink.write(landing.stamp(source.players(), at), "bronze", "players_snapshot")
    sink.write(landing.stamp(source.teams(), at), "bronze", "teams_snapshot")
    gameweeks = source.gameweeks()
    if last_finished(gameweeks).isEmpty():
        return False
    chosen = current_gameweek(gameweeks)
    if chosen.isEmpty():
        raise NoGameweek("no gameweek is marked current or next")
    sink.write(chosen, "bronze", "current_gameweek")
    sink.write(landing.stamp(source.fixtures(), at), "bronze", "fixtures_snapshot")
    sink.write(landing.stamp(source.history(), at), "bronze", "player_gameweek_history", keep_if_empty=True)
    return True


def build_silver(warehouse: Warehouse, sink: TableSink, strict: bool = True, blocking: bool = False) -> DataFrame:
    """Write the silver tables, each derived from tables already written, and the
    quality report. ``blocking`` raises before gold is built."""
    bronze_players = warehouse.read("bronze", "players_snapshot")
    teams = sink.write(silver.silver_teams(warehouse.read("bronze", "teams_snapshot"), strict), "silver", "teams")
    players = sink.write(silver.silver_players(bronze_players, teams, strict), "silver", "players")
    fixtures = sink.write(
        silver.silver_fixtures(warehouse.read("bronze", "fixtures_snapshot"), teams, strict), "silver", "fixtures"
    )
    history = warehouse.read("bronze", "player_gameweek_history")
    stats = sink.write(
        silver.silver_stats(history, players, fixtures, strict), "silver", "player_gameweek_stats"
    )
    sink.write(warehouse.read("bronze", "current_gameweek"), "silver", "current_gameweek")
    checks = sink.write(
        silver.silver_quality(bronze_players, teams, players, fixtures, stats), "audit", "silver_quality"
    )
    if blocking:
        require_clean(checks)
    return checks


def build_gold(warehouse: Warehouse, sink: TableSink, blocking: bool = False) -> DataFrame:
    """Write the gold tables. The score reads form, value and difficulty back, so the
    match history is aggregated once."""
    players = warehouse.read("silver", "players")
    form = sink.write(
        gold.player_form(warehouse.read("silver", "player_gameweek_stats")), "gold", "player_form"
    )
    value = sink.write(gold.player_value(players), "gold", "player_value")
    difficulty = sink.write(
        gold.upcoming_difficulty(warehouse.read("silver", "fixtures")), "gold", "upcoming_fixtures_difficulty"
    )
    scores = sink.write(
        gold.recommendation_scores(form, value, difficulty, players), "gold", "player_recommendation_scores"
    )
    sink.write(warehouse.read("silver", "current_gameweek"), "gold", "current_gameweek")
    if blocking:
        require_clean(gold.gold_quality(scores))
    return scores


@dataclass
class WeeklyResult:
    """What a run did; ``counts`` has one row per written table."""

    completed: bool
    run_id: str
    tables: list[str] = field(default_factory=list)
    counts: DataFrame | None = None


LAYER_STEPS = ("bronze", "silver", "gold")


def run_weekly(spark: SparkSession, landing_path: str, prefix: str = "", run_ts: datetime | None = None,
               table_format: str = "parquet", mode: str = "failfast", strict: bool = True, blocking: bool = False,
               all_fields: bool = True, squads: DataFrame | None = None, resume: bool = False) -> WeeklyResult:
    """Run all layers in dependency order; each reads the tables of the one before.

    ``squads``, rows of (squad, player_id), also writes their line-ups. With ``resume``, layers that the last run finished over the
    same landed files and options are not built again."""
    warehouse = Warehouse(spark, prefix, table_format)
    warehouse.create_layers()
    version = f"{input_version(spark, landing_path)} mode={mode} strict={strict} all_fields={all_fields}"
    done = finished_steps(warehouse, LAYER_STEPS, version) if resume else []
    log = RunLog(warehouse, input_version=version)
    sink = TableSink(warehouse, log)
    run_ts = run_ts or datetime.now(timezone.utc)
    for layer in done:
        log.event(step=layer, status="reused")

    if "bronze" not in done:
        with log.step("bronze") as result:
            source = Landing(spark, landing_path, mode, all_fields)
            finished = load_bronze(source, sink, run_ts)
            if mode == "quarantine":
                sink.write(source.quarantine(F.lit(run_ts)), "audit", "quarantine")
            if not finished:
                result["status"] = "stopped"
        if not finished:
            return WeeklyResult(False, log.run_id)
    if "silver" not in done:
        with log.step("silver"):
            build_silver(warehouse, sink, strict, blocking)
    if "gold" not in done:
        with log.step("gold"):
            build_gold(warehouse, sink, blocking)
    written = {
        "bronze": ["players_snapshot", "teams_snapshot", "fixtures_snapshot", "player_gameweek_history"],
        "silver": ["teams", "players", "fixtures", "player_gameweek_stats"],
        "gold": ["player_form", "player_value", "upcoming_fixtures_difficulty", "player_recommendation_scores"],
    }
    if squads is not None:
        with log.step("lineups"):
            scores = warehouse.read("gold", "player_recommendation_scores")
            named = squads.select(F.col("squad").cast("string").alias("squad"), "player_id")
            sink.write(lineups(scores, named, strict=strict), "gold", "lineups")
        written["gold"].append("lineups")
    tables = {f"{layer}.{t}": warehouse.read(layer, t) for layer, names in written.items() for t in names}
    return WeeklyResult(True, log.run_id, list(tables), table_counts(tables))
