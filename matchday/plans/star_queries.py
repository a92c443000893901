"""One query per operator, over the whole star-schema tables.

Role mapping of the operator queries: nation = team, customer = player, order =
match of a player's history, line item = fixture. The ``silver_*``, ``gold_*`` and
``report_*`` queries run the league transforms of :mod:`matchday.plans.star`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday import schemas
from matchday.functions.projection import Field, cast_failures, project
from matchday.functions.scalars import (
    badge_url, decode_codes, favourability, fixed, full_name, pick_side, portrait_url, safe_ratio, weighted_score,
)
from matchday.operators import lineup, quality
from matchday.operators.pruning import dominance_prune
from matchday.operators.ranking import (
    current_or_next, first_n_per_key, global_rank, last_by, latest_n_agg, latest_where, next_n_agg, ordering, top_n, top_n_per_key,
)
from matchday.operators.rolling import rolling_last_n
from matchday.operators.scaling import min_max_normalize
from matchday.operators.shaping import left_join_dim, union_sides, unpivot_sides
from matchday.operators.squad import prune_candidates
from matchday.operators.squad_rules import CandidateColumns
from matchday.plans import gold, reports, silver
from matchday.plans.selection import lineups
from matchday.plans.star import League
from matchday.plans.weekly import current_gameweek, last_finished
from matchday.session import small_partitions
from matchday.sources import landing
from matchday.sources.arrays import array_records
from matchday.sources.frames import with_payload
from matchday.sources.staging import shared_folder, staged

Query = Callable[[SparkSession, str], DataFrame]

PRIORITY_LABELS = {1: "urgent", 2: "high", 3: "medium", 4: "open"}
SEGMENT_POSITIONS = {"AUTOMOBILE": "GKP", "BUILDING": "DEF", "FURNITURE": "MID", "HOUSEHOLD": "FWD"}
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

_REGISTRY: dict[str, Query] = {}


def _query(build: Callable[[League], DataFrame]) -> Callable[[League], DataFrame]:
    """Register a query under its function name, less a ``_query`` suffix."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(League(spark, sf_dir))

    _REGISTRY[build.__name__.removesuffix("_query")] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _r(column: Column | str, digits: int = 6) -> Column:
    return F.round(column, digits)


def _epoch(column: Column | str) -> Column:
    return F.unix_seconds(F.col(column) if isinstance(column, str) else column)


# --- projections, scalars, sources -----------------------------------------

@_query
def dim_project_cast(t: League) -> DataFrame:
    suppliers = project(t.table("supplier"), [
        Field("team_id", "s_suppkey"), Field("team_name", "s_name"), Field("strength", "s_acctbal", "int"),
        Field("nation_id", "s_nationkey", "bigint"),
    ])
    return suppliers


@_query
def decode_priority(t: League) -> DataFrame:
    code = F.left("o_orderpriority", F.lit(1)).try_cast("int")
    return t.table("orders").select(
        "o_orderkey", code.alias("code"), decode_codes(code, PRIORITY_LABELS).alias("label")
    )


@_query
def cast_report(t: League) -> DataFrame:
    """Values a lenient cast would lose, per column."""
    return cast_failures(t.table("orders"), [
        Field("o_orderpriority", data_type="int"), Field("o_orderstatus", data_type="boolean"),
        Field("o_totalprice", data_type="int"),
    ])


@_query
def raw_payload(t: League) -> DataFrame:
    rows = t.table("customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    return with_payload(rows).select("c_custkey", "raw_payload")


@_query
def json_fields(t: League) -> DataFrame:
    props = F.from_json("props", "k BIGINT")
    return t.table("events").select("event_id", props["k"].alias("k"))


@_query
def document_records(t: League) -> DataFrame:
    """Documents holding arrays of records, cut into raw records and then typed."""
    order = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"),
                               (F.col("o_orderstatus") == "F").alias("finished"),
                               (F.col("o_orderstatus") == "P").alias("is_current")))
    follow = F.to_json(F.struct((F.col("o_orderkey") + 1).alias("id"), F.lit(None).cast("string").alias("name")))
    documents = t.table("orders").select(
        F.concat(F.lit('{"events":['), order, F.lit(","), follow, F.lit("]}")).alias(landing.DOCUMENT),
        F.concat(F.lit("event/"), F.col("o_custkey"), F.lit(".json")).alias(landing.PATH),
    )
    keyed = landing.with_path_key(documents, "customer_id")
    rows = landing.records(keyed, "events", ("customer_id",))
    typed = landing.typed(rows, schemas.GAMEWEEK_RECORD, ("customer_id", landing.POS))
    return typed.select("customer_id", landing.POS, "id", "name", "finished", "is_current")


def _mixed_documents(t: League) -> DataFrame:
    """A document per order: cut short, without the array, or with records that do not fit the schema or are null."""
    key = F.col("o_orderkey")
    record = F.to_json(F.struct(key.alias("id"), F.col("o_orderpriority").alias("name")))
    second = F.when(key % 3 == 0, F.concat(F.lit(',{"id":"x'), key, F.lit('"}'))).when(key % 3 == 1, F.lit(",null")).otherwise("")
    whole = F.concat(F.lit('{"events":['), record, second, F.lit("]}"))
    text = F.when(key % 11 == 0, F.concat(F.lit('{"events":['), record)).when(key % 11 == 1, F.lit('{"other":[]}')).otherwise(whole)
    documents = t.table("orders").select(
        text.alias(landing.DOCUMENT), F.concat(F.lit("event/"), key, F.lit(".json")).alias(landing.PATH))
    return landing.with_path_key(documents, "order_id")


def _sorted_out(t: League) -> DataFrame:
    raw = landing.raw_records(_mixed_documents(t), "events", ("order_id",))
    return staged(landing.sorted_out(raw, schemas.GAMEWEEK_RECORD, ("order_id",)), "parsed")


@_query
def quarantined_records(t: League) -> DataFrame:
    return landing.rejected(_sorted_out(t), ("order_id",)).select(
        "order_id", F.col(landing.POS).cast("bigint").alias(landing.POS), landing.REASON, landing.RAW)


@_query
def accepted_records(t: League) -> DataFrame:
    return landing.accepted(_sorted_out(t), ("order_id", landing.POS)).select(
        "order_id", F.col(landing.POS).cast("bigint").alias(landing.POS), "id", "name", "finished")


@_query
def array_records_query(t: League) -> DataFrame:
    """The orders as four JSON arrays, one file each, read by many tasks; texts hold braces and quotes."""
    part, key = F.col("o_custkey") % 4, F.col("o_orderkey")
    in_file = Window.partitionBy("part").orderBy("o_orderkey")
    record = F.to_json(F.struct(key.alias("id"), F.concat(F.lit('},{"'), F.col("o_orderpriority")).alias("name"),
                                F.struct((key % 3).alias("n")).alias("inner")))
    lines = t.table("orders").withColumn("part", part).select(
        "part", "o_orderkey", F.concat(
            F.when(F.row_number().over(in_file) == 1, "[").otherwise(","), record,
            F.when(F.lead("o_orderkey").over(in_file).isNull(), "]").otherwise("")).alias("value"))
    path = f"{shared_folder(t.spark)}/arrays-{uuid.uuid4().hex}"
    lines.repartition("part").sortWithinPartitions("part", "o_orderkey").drop("o_orderkey").write.partitionBy("part").text(path)
    found = array_records(t.spark, path)
    inner = T.StructField("inner", T.StructType([T.StructField("n", T.LongType())]))
    schema = T.StructType([*schemas.GAMEWEEK_RECORD.fields, inner])
    typed = landing.typed(found.filter(F.col(landing.REASON).isNull()), schema, (landing.PATH, landing.POS))
    return typed.select(F.regexp_extract(landing.PATH, r"part=(\d+)", 1).cast("bigint").alias("part"),
                        F.col(landing.POS).cast("bigint").alias(landing.POS), "id", "name", F.col("inner.n").alias("n"))


@_query
def observed_types(t: League) -> DataFrame:
    """The JSON types under every key path of the events' properties and of documents made of the orders."""
    key = F.col("o_orderkey")
    mixed = F.when(key % 2 == 0, key.cast("string")).otherwise(F.concat(F.lit('"'), key, F.lit('"')))
    text = F.concat(
        F.lit('{"id":'), key, F.lit(',"total":'), F.col("o_totalprice").cast("decimal(20,2)"), F.lit(',"mixed":'), mixed,
        F.lit(',"none":null,"tags":["'), F.col("o_orderpriority"), F.lit('",null],"inner":{"done":'),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("null"), F.lit("}}"))
    found = [landing.observed_types(df).withColumn("source", F.lit(name)) for name, df in (
        ("events", t.table("events").select(F.col("props").alias(landing.RAW))), ("orders", t.table("orders").select(text.alias(landing.RAW))))]
    return found[0].unionByName(found[1]).select("source", F.concat_ws(".", "path").alias("path"), "type", "n")


@_query
def display_fields(t: League) -> DataFrame:
    photo = F.concat(F.col("c_custkey"), F.lit(".jpg"))
    return t.table("customer").select(
        "c_custkey",
        full_name(F.nullif("c_mktsegment", F.lit("MACHINERY")), F.col("c_name")).alias("full_name"),
        portrait_url(F.when(F.col("c_custkey") % 7 != 0, photo)).alias("portrait_url"),
        badge_url(F.nullif("c_nationkey", F.lit(0))).alias("badge_url"),
        fixed(F.col("c_acctbal"), 1, "M").alias("cost"),
    )


def _moved(t: League) -> DataFrame:
    """All customers; every second one has a nation key that no nation has."""
    return t.table("customer").withColumn("c_nationkey", F.col("c_nationkey") + 1000 * (F.col("c_custkey") % 2))


# --- joins ------------------------------------------------------------------

@_query
def left_join_dim_query(t: League) -> DataFrame:
    return left_join_dim(
        _moved(t).select("c_custkey", "c_nationkey"), t.table("nation"), "c_nationkey",
        {"n_nationkey": "c_nationkey", "n_name": "team_name"},
    )


def _line_sides(t: League) -> DataFrame:
    """Line items with the nation of the customer (home) and of the supplier (away)."""
    buyers = left_join_dim(
        t.table("orders").select("o_orderkey", "o_custkey"), t.table("customer"), "o_custkey",
        {"c_custkey": "o_custkey", "c_nationkey": "home_id"},
    ).select(F.col("o_orderkey").alias("l_orderkey"), "home_id")
    lines = t.table("lineitem").join(buyers, "l_orderkey", "left")
    return left_join_dim(lines, t.table("supplier"), "l_suppkey", {"s_suppkey": "l_suppkey", "s_nationkey": "away_id"})


@_query
def role_dims(t: League) -> DataFrame:
    lines = _line_sides(t).select(*LINE_KEY, "home_id", "away_id")
    for side in ("home", "away"):
        lines = left_join_dim(
            lines, t.table("nation"), f"{side}_id", {"n_nationkey": f"{side}_id", "n_name": f"{side}_name"}
        )
    return lines.select(*LINE_KEY, "home_name", "away_name")


@_query
def fact_enriched(t: League) -> DataFrame:
    orders = t.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    fact = left_join_dim(
        orders, t.table("customer"), "o_custkey",
        {"c_custkey": "o_custkey", "c_nationkey": "team_id", "c_mktsegment": "position"},
    )
    sides = t.table("nation").select(
        F.col("n_nationkey").alias("team_id"), (F.col("n_regionkey") + 1).alias("home"),
        (F.col("n_nationkey") % 5 + 1).alias("away"),
    )
    at_home = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    return left_join_dim(fact, sides, "team_id").select(
        "o_orderkey", "team_id", "position", pick_side(at_home, F.col("home"), F.col("away")).alias("difficulty")
    )


# --- newest rows, windows ---------------------------------------------------

@_query
def latest_state(t: League) -> DataFrame:
    return latest_where(
        t.table("events"), ["user_id"], F.col("event_type") == "purchase", ["ts", "event_id"], ["event_id", "value"]
    )


@_query
def last_value(t: League) -> DataFrame:
    """Each customer's last order and its price, as a plain aggregate."""
    order = ["o_orderdate", "o_orderkey"]
    return t.table("orders").groupBy("o_custkey").agg(
        last_by(F.col("o_orderkey"), *order).alias("last_order"), last_by(F.col("o_totalprice"), *order).alias("last_price")
    )


@_query
def current_or_next_query(t: League) -> DataFrame:
    status = F.col("o_orderstatus")
    return current_or_next(
        t.table("orders"), status == "P", status == "O", ["o_orderdate", "o_orderkey"],
        ["o_orderkey", "o_orderstatus"], keys=["o_custkey"],
    )


def _calendar(t: League, current: bool = True) -> DataFrame:
    """Months of the orders as gameweeks; the middle of the calendar is in progress, or just over."""
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    months = t.table("orders").groupBy(month.cast("bigint").alias("id")).agg(
        F.count(F.lit(1)).alias("matches"), F.min("o_orderdate").alias("first_day")
    )
    return months.select(
        "id", F.col("id").alias(landing.POS), F.concat(F.lit("Gameweek "), F.col("id")).alias("name"),
        F.date_format("first_day", "yyyy-MM-dd").alias("deadline_time"), (F.col("id") < 24000).alias("finished"),
        (F.col("id") % 2 == 0).alias("data_checked"), (F.lit(current) & (F.col("id") == 24000)).alias("is_current"),
        (F.col("id") == 24001).alias("is_next"),
    )


@_query
def gameweek_gate(t: League) -> DataFrame:
    return last_finished(_calendar(t))


@_query
def gameweek_current(t: League) -> DataFrame:
    return current_gameweek(_calendar(t))


@_query
def gameweek_upcoming(t: League) -> DataFrame:
    """Between two gameweeks, the next one."""
    return current_gameweek(_calendar(t, current=False))


@_query
def rolling_series(t: League) -> DataFrame:
    orders = t.table("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    series = rolling_last_n(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], 3,
        {"avg_recent": F.avg("o_totalprice"), "matches_in_window": F.count("o_totalprice")}, ["o_totalprice"],
    )
    return series.select("o_custkey", "o_orderkey", _r("avg_recent").alias("avg_recent"), "matches_in_window")


@_query
def rolling_series_skewed(t: League) -> DataFrame:
    """One key for every third line item, over more slices than the default."""
    lines = t.table("lineitem").select(
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey")).otherwise(F.lit(-1)).alias("series"),
        "l_shipdate", *LINE_KEY, "l_quantity",
    )
    series = rolling_last_n(
        lines, ["series"], ["l_shipdate", *LINE_KEY, "l_quantity"], 3,
        {"sum_recent": F.sum("l_quantity"), "lines_in_window": F.count("l_quantity")}, ["l_quantity"],
        slices=16,
    )
    return series.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sum_recent").cast("bigint").alias("total"),
        F.min("sum_recent").cast("bigint").alias("lowest"), F.max("sum_recent").cast("bigint").alias("highest"),
        F.sum("lines_in_window").alias("frames"),
    )


def _customer_form(t: League) -> DataFrame:
    return latest_n_agg(
        t.table("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 3,
        {"avg_recent": F.avg("o_totalprice"), "matches_in_window": F.count("o_totalprice")},
    )


@_query
def form_last3(t: League) -> DataFrame:
    return _customer_form(t).select("o_custkey", _r("avg_recent").alias("avg_recent"), "matches_in_window")


def _sides(t: League) -> DataFrame:
    sides = [
        {"team_id": F.col("home_id"), "difficulty": 1 + 40 * F.col("l_discount"), "side": F.lit(0)},
        {"team_id": F.col("away_id"), "difficulty": 1 + 40 * F.col("l_tax"), "side": F.lit(1)},
    ]
    unplayed = _line_sides(t).filter(F.col("l_linestatus") == "O")
    return unpivot_sides(unplayed, sides, keep=["l_shipdate", *LINE_KEY])


def _nation_difficulty(t: League) -> DataFrame:
    return next_n_agg(
        _sides(t), ["team_id"], ["l_shipdate", *LINE_KEY, "side", "difficulty"], 3,
        {"avg_upcoming_difficulty": F.avg("difficulty"), "n": F.count("difficulty")},
    )


@_query
def next3_difficulty(t: League) -> DataFrame:
    return _nation_difficulty(t).select(
        "team_id", _r("avg_upcoming_difficulty").alias("avg_upcoming_difficulty"), "n"
    )


@_query
def sides_unpivot(t: League) -> DataFrame:
    return _sides(t).groupBy("team_id", "side").agg(
        F.count(F.lit(1)).alias("n"), _r(F.sum("difficulty"), 3).alias("difficulty")
    )


@_query
def sides_union(t: League) -> DataFrame:
    sold = t.table("customer").select(F.col("c_nationkey").alias("team_id"), F.lit("customer").alias("side"))
    made = t.table("supplier").select(F.lit("supplier").alias("side"), F.col("s_nationkey").alias("team_id"))
    return union_sides(sold, made).groupBy("team_id", "side").agg(F.count(F.lit(1)).alias("n"))


# --- scoring ----------------------------------------------------------------

def _customer_value(t: League) -> DataFrame:
    totals = t.table("orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    joined = left_join_dim(t.table("customer"), totals, "c_custkey", {"o_custkey": "c_custkey", "total": "total"})
    return joined.withColumn("points_per_million", safe_ratio(F.col("total"), F.col("c_acctbal")))


@_query
def value_ratio(t: League) -> DataFrame:
    return _customer_value(t).select("c_custkey", _r("points_per_million", 4).alias("points_per_million"))


@_query
def minmax_norm(t: League) -> DataFrame:
    out = min_max_normalize(t.table("lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice"),
                            ["l_quantity", "l_extendedprice"])
    return out.select(*LINE_KEY, _r("l_quantity_norm").alias("quantity_norm"),
                      _r("l_extendedprice_norm").alias("price_norm"))


@_query
def minmax_constant(t: League) -> DataFrame:
    flat = t.table("part").select(
        "p_partkey", F.lit(7).alias("same"), F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("partly"),
    )
    out = min_max_normalize(flat, ["same", "nothing", "partly"])
    return out.select("p_partkey", "same_norm", "nothing_norm", _r("partly_norm").alias("partly_norm"))


@_query
def minmax_by_group(t: League) -> DataFrame:
    out = min_max_normalize(t.table("part"), ["p_retailprice"], by=["p_brand"])
    return out.select("p_partkey", _r("p_retailprice_norm").alias("price_norm"))


@_query
def favourability_query(t: League) -> DataFrame:
    known = F.when(F.col("l_returnflag") != "N", 1 + F.floor(F.abs("l_discount") * 40) % 5)
    return t.table("lineitem").select(*LINE_KEY, _r(favourability(known)).alias("favourability"))


@_query
def weighted_score_query(t: League) -> DataFrame:
    parts = t.table("part").select(
        "p_partkey", (F.col("p_size") / 50).alias("a"), F.when(F.col("p_size") > 10, 0.5).alias("b"),
    )
    return parts.select("p_partkey", _r(weighted_score({"a": 0.4, "b": 0.3})).alias("score"))


def _recommendation(t: League) -> DataFrame:
    base = _customer_value(t).select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "points_per_million")
    base = left_join_dim(base, _customer_form(t), "c_custkey", {"o_custkey": "c_custkey", "avg_recent": "avg_recent"})
    base = left_join_dim(
        base, _nation_difficulty(t), "c_nationkey",
        {"team_id": "c_nationkey", "avg_upcoming_difficulty": "avg_upcoming_difficulty"},
    )
    scaled = min_max_normalize(base, ["avg_recent", "points_per_million"])
    scored = scaled.filter(F.col("c_acctbal") >= 0).withColumn(
        "calendar_norm", favourability(F.col("avg_upcoming_difficulty"))
    )
    weights = {"avg_recent_norm": 0.4, "points_per_million_norm": 0.3, "calendar_norm": 0.3}
    return scored.withColumn("recommendation_score", weighted_score(weights))


@_query
def recommendation(t: League) -> DataFrame:
    return _recommendation(t).select("c_custkey", _r("recommendation_score").alias("recommendation_score"))


# --- top k ------------------------------------------------------------------

@_query
def top10(t: League) -> DataFrame:
    return top_n(t.table("customer"), "c_acctbal", 10, ["c_custkey"]).select("c_custkey", "c_acctbal")


@_query
def customer_places(t: League) -> DataFrame:
    """The place of every customer by balance."""
    placed = global_rank(t.table("customer"), "c_acctbal", ["c_custkey"])
    return placed.select("c_custkey", "c_acctbal", F.col("place").cast("bigint").alias("place"))


@_query
def line_places(t: League) -> DataFrame:
    """The place of every line item by quantity, a measure of few values."""
    placed = global_rank(t.table("lineitem").select(*LINE_KEY, "l_shipdate", "l_extendedprice", "l_quantity"), "l_quantity",
                         [*LINE_KEY, "l_shipdate", "l_extendedprice"], slices=16)
    return placed.select(*LINE_KEY, "l_shipdate", F.col("place").cast("bigint").alias("place"))


@_query
def top20_per_segment(t: League) -> DataFrame:
    best = top_n_per_key(t.table("customer"), ["c_mktsegment"], "c_acctbal", 20, ["c_custkey"], rank="place")
    return best.select("c_mktsegment", F.col("place").cast("bigint").alias("place"), "c_custkey", "c_acctbal")


@_query
def ranked_segments(t: League) -> DataFrame:
    """Newest order of every status and priority, nulls placed explicitly."""
    order = ordering(["o_orderdate", "o_orderkey"], descending=True, nulls="last")
    newest = first_n_per_key(t.table("orders"), ["o_orderstatus", "o_orderpriority"], order, 1)
    return newest.select("o_orderstatus", "o_orderpriority", "o_orderkey")


# --- quality ----------------------------------------------------------------

@_query
def table_counts(t: League) -> DataFrame:
    names = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
             "conversations").split()
    return quality.table_counts({name: t.table(name) for name in names})


@_query
def dq_duplicates(t: League) -> DataFrame:
    return quality.duplicate_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@_query
def dq_orphans(t: League) -> DataFrame:
    return quality.orphan_keys(_moved(t), "c_nationkey", t.table("nation"), "n_nationkey")


@_query
def dq_ranges(t: League) -> DataFrame:
    return quality.check_rules(t.table("lineitem"), "lineitem", {
        "quantity": quality.outside("l_quantity", 5, 45), "discount": quality.outside("l_discount", 0.02, 0.08),
        "flag": F.col("l_returnflag") == "N",
    })


# --- selection --------------------------------------------------------------

@_query
def dominance_prune_query(t: League) -> DataFrame:
    sold = t.table("lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("score"))
    parts = t.table("part").join(sold, F.col("p_partkey") == F.col("l_partkey"))
    units = F.round(F.col("p_retailprice") * 10).cast("bigint")
    kept = dominance_prune(parts, [], "p_type", "p_brand", units, "score", "p_partkey", same_bound=3, club_bound=7)
    return kept.select(F.col("p_partkey").alias("id"))


def _nation_squads(t: League) -> tuple[DataFrame, CandidateColumns]:
    pairs = [F.lit(x) for pair in SEGMENT_POSITIONS.items() for x in pair]
    squads = t.table("customer").withColumn("position", F.create_map(*pairs)[F.col("c_mktsegment")])
    squads = squads.withColumn("cost", (F.col("c_custkey") % 97).cast("double"))
    return squads, CandidateColumns("c_custkey", "position", "c_mktsegment", "cost", "c_acctbal")


@_query
def best_lineup(t: League) -> DataFrame:
    squads, cols = _nation_squads(t)
    best = lineup.best_formation(squads, ["c_nationkey"], cols=cols)
    return best.select("c_nationkey", "formation", _r("total", 2).alias("total"))


@_query
def lineup_starters(t: League) -> DataFrame:
    squads, cols = _nation_squads(t)
    return lineup.mark_starters(squads, ["c_nationkey"], cols=cols).select("c_nationkey", "c_custkey", "is_starter")


@_query
def lineup_totals(t: League) -> DataFrame:
    squads, cols = _nation_squads(t)
    marked = lineup.mark_starters(squads, ["c_nationkey"], cols=cols)
    totals = lineup.squad_totals(marked, ["c_nationkey"], cols)
    sums = ["total_cost", "total_score", "starters_cost"]
    return totals.select("c_nationkey", *[_r(c, 2).alias(c) for c in sums], "starters", "players")


def _nation_team(t: League) -> tuple[DataFrame, CandidateColumns]:
    """The nations' squads with their starters and what a card shows."""
    squads, cols = _nation_squads(t)
    shown = squads.select("*", F.col("c_name").alias("web_name"), F.concat("c_custkey", F.lit(".jpg")).alias("photo"),
                          (F.col("c_nationkey") + 100).alias("team_code"))
    return lineup.mark_starters(shown, ["c_nationkey"], cols=cols), cols


@_query
def lineup_cards(t: League) -> DataFrame:
    team, cols = _nation_team(t)
    cards = reports.lineup_cards(team, ["c_nationkey"], cols)
    whole = {c: F.col(c).cast("bigint").alias(c) for c in ("place", "position_order")}
    return cards.select(*[whole.get(c, F.col(c)) for c in cards.columns])


@_query
def squad_places(t: League) -> DataFrame:
    """Every player's place in the list of their nation, starters before the bench."""
    team, cols = _nation_team(t)
    placed = reports.squad_places(team, ["c_nationkey"], cols)
    return placed.select("c_nationkey", "c_custkey", "is_starter", F.col("place").cast("bigint").alias("place"))


@_query
def squad_summary(t: League) -> DataFrame:
    """Totals per nation and position, per nation, and in all, with their texts."""
    team, cols = _nation_team(t)
    return reports.with_total_texts(lineup.squad_summary(team, ["c_nationkey"], cols))


@_query
def given_lineups(t: League) -> DataFrame:
    """The line-ups of given squads: every fortieth player."""
    scores = t.scores.withColumn("recommendation_score", _r("recommendation_score"))
    squads = t.table("part").select((F.col("p_partkey") % 40).alias("squad"), F.col("p_partkey").alias("player_id"))
    return lineups(scores, squads).select("squad", "player_id", "position", "is_starter", "recommendation_score")


@_query
def squad_check(t: League) -> DataFrame:
    cols = CandidateColumns("p_partkey", "position", "team_id", "cost_millions", "p_size")
    squads = t.table("part").selectExpr(
        "p_size AS squad", "p_partkey", "p_brand AS team_id", "p_retailprice / 100 AS cost_millions", "p_size",
        "CASE p_type WHEN 'ECONOMY' THEN 'GKP' WHEN 'SMALL' THEN 'DEF' WHEN 'STANDARD' THEN 'MID' "
        "WHEN 'PROMO' THEN 'FWD' END AS position",
    )
    return lineup.squad_check(squads, ["squad"], cols=cols)


@_query
def prune_league(t: League) -> DataFrame:
    """The candidates the squad solver of the league needs to look at."""
    return prune_candidates(t.scores).select("player_id")


# --- league layers ----------------------------------------------------------

@_query
def silver_teams(t: League) -> DataFrame:
    return t.teams


@_query
def silver_players(t: League) -> DataFrame:
    return t.players


@_query
def silver_fixtures(t: League) -> DataFrame:
    return t.fixtures.withColumn("kickoff_time", _epoch("kickoff_time"))


@_query
def silver_stats(t: League) -> DataFrame:
    return t.stats


@_query
def silver_quality(t: League) -> DataFrame:
    """In small partitions: nearly every match has a key of its own, so a task keeps all its matches in memory."""
    t = League(small_partitions(t.spark), t.path)
    return silver.silver_quality(t.bronze_players, t.teams, t.players, t.fixtures, t.stats)


@_query
def gold_form(t: League) -> DataFrame:
    means = [c for c in t.form.columns if c.startswith("avg_")]
    return t.form.select("player_id", *[_r(c).alias(c) for c in means], "matches_in_window")


@_query
def gold_value(t: League) -> DataFrame:
    return t.value.withColumn("points_per_million", _r("points_per_million"))


@_query
def gold_difficulty(t: League) -> DataFrame:
    return t.difficulty.withColumn("avg_upcoming_difficulty", _r("avg_upcoming_difficulty"))


@_query
def gold_scores(t: League) -> DataFrame:
    measures = ["avg_points_recent", "points_per_million", "avg_upcoming_difficulty", "recommendation_score"]
    return t.scores.select(*[_r(c).alias(c) if c in measures else c for c in t.scores.columns])


@_query
def gold_quality(t: League) -> DataFrame:
    return gold.gold_quality(t.scores)


@_query
def report_rankings(t: League) -> DataFrame:
    """Ranked on the rounded score, so that equal scores rank by player."""
    rounded = t.scores.withColumn("recommendation_score", _r("recommendation_score"))
    listed = reports.rankings(rounded)
    whole = {c: F.col(c).cast("bigint").alias(c) for c in ("place", "position_order")}
    return listed.select(*[whole.get(c, F.col(c)) for c in listed.columns])


@_query
def report_top10(t: League) -> DataFrame:
    rounded = t.scores.withColumn("recommendation_score", _r("recommendation_score"))
    return reports.top_players(rounded).select("player_id", "web_name", "recommendation_score")


@_query
def report_gameweek(t: League) -> DataFrame:
    return reports.gameweek_badge(current_gameweek(_calendar(t)))
