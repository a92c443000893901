"""Best line-up of every squad, squad totals and rule checks: all relational."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.operators.ranking import first_n_per_key
from matchday.operators.squad_rules import BUDGET, CandidateColumns, SquadRules


def _formations(rules: SquadRules) -> dict[str, dict[str, int]]:
    """Every formation by name, as in 4-4-2: the positions whose number can vary."""
    varying = [p for p, (low, high) in rules.lineup_bounds.items() if low != high]
    named = {"-".join(str(split[p]) for p in varying): split for split in rules.formations()}
    return dict(sorted(named.items()))


def _no_formation() -> Column:
    return F.raise_error(F.lit("no valid formation: check the number of players per position"))


def _choices(squads: DataFrame, squad: Sequence[str], rules: SquadRules, cols: CandidateColumns) -> DataFrame:
    """Per squad, ``formation``, ``total`` and ``__last``: by position, the last starter as (score, id).

    A line-up uses the best few players of a position, so those are all that leaves the map side. One aggregation adds up the best k of
    each position for every k that a formation asks for; a formation's total is the sum of four of them."""
    most = max(high for _, high in rules.lineup_bounds.values())
    formations = _formations(rules)
    wanted = sorted({(p, k) for split in formations.values() for p, k in split.items() if k})
    usable = squads.filter(F.col(cols.position).isin(list(rules.lineup_bounds)) & F.col(cols.score).isNotNull())
    usable = usable.select(*squad, F.col(cols.position).alias("__position"), F.col(cols.score).alias("score"), F.col(cols.id).alias("id"))
    best = first_n_per_key(usable, [*squad, "__position"], [F.col("score").desc(), F.col("id").asc()], most, rank="__place")
    place, score = F.col("__place"), F.col("score").cast("double")
    sums = []
    for i, (position, k) in enumerate(wanted):
        here = F.col("__position") == position
        sums += [F.sum(F.when(here & (place <= k), score)).alias(f"__sum{i}"),
                 F.max(F.when(here & (place == k), F.struct("score", "id"))).alias(f"__last{i}")]
    summed = best.groupBy(*squad).agg(*sums)

    options, lasts = [], []
    for number, (name, split) in enumerate(formations.items()):
        used = [wanted.index((p, k)) for p, k in split.items() if k]
        total = F.lit(0.0)
        for i in used:
            # A position with fewer players has no k-th one, and the formation no total.
            total = total + F.when(F.col(f"__last{i}").isNotNull(), F.col(f"__sum{i}"))
        # Rounding keeps the choice independent of the order of summation.
        options.append(F.when(total.isNotNull(), F.struct(
            F.round(total, 6).alias("rounded"), F.lit(-number).alias("place"), F.lit(name).alias("formation"), total.alias("total"))))
    chosen = summed.withColumn("__best", F.array_max(F.array(*options))).filter(F.col("__best").isNotNull())
    for position in rules.lineup_bounds:
        last = F.lit(None)
        for name, split in formations.items():
            if split[position]:
                last = F.when(F.col("__best.formation") == name, F.col(f"__last{wanted.index((position, split[position]))}")).otherwise(last)
        lasts.append(last)
    return chosen.select(*squad, F.col("__best.formation").alias("formation"), F.col("__best.total").alias("total"),
                         F.array(*lasts).alias("__last"))


def best_formation(squads: DataFrame, squad: Sequence[str], rules: SquadRules = SquadRules(),
                   cols: CandidateColumns = CandidateColumns()) -> DataFrame:
    """Per squad, the formation with the highest total: ``(squad, formation, total)``."""
    return _choices(squads, squad, rules, cols).drop("__last")


def mark_starters(squads: DataFrame, squad: Sequence[str], rules: SquadRules = SquadRules(),
                  cols: CandidateColumns = CandidateColumns(), strict: bool = False) -> DataFrame:
    """Add ``is_starter``; the rest of each squad is its bench. A squad without a
    valid line-up has no starters, or fails the job when ``strict``.

    A player starts who is not behind the last starter of their position by (score, id), so a row listed twice with one score starts
    twice or not at all. Squads are matched with their line-up by their own columns, where NULL is a squad too."""
    if not squad:
        whole = mark_starters(squads.withColumn("__squad", F.lit(0)), ["__squad"], rules, cols, strict)
        return whole.drop("__squad")
    chosen = _choices(squads, squad, rules, cols).withColumnsRenamed({c: f"__chosen_{c}" for c in squad})
    same = [squads[c].eqNullSafe(F.col(f"__chosen_{c}")) for c in squad]
    score, player, starts = F.col(cols.score), F.col(cols.id), F.lit(False)
    for i, position in enumerate(rules.lineup_bounds):
        last = F.col("__last")[i]
        ahead = (score > last["score"]) | ((score == last["score"]) & (player <= last["id"]))
        starts = F.when(F.col(cols.position) == position, ahead).otherwise(starts)
    is_starter = F.coalesce(starts, F.lit(False))
    if strict:
        is_starter = F.when(F.col("__last").isNull(), _no_formation()).otherwise(is_starter)
    marked = squads.join(chosen.drop("formation", "total"), same, "left")
    return marked.select(*[squads[c] for c in squads.columns], is_starter.alias("is_starter"))


def squad_order(position_place: Column, cols: CandidateColumns = CandidateColumns()) -> list[Column]:
    """The order of a squad list: starters before the bench, then by position, score and id."""
    return [F.col("is_starter").desc(), position_place.asc_nulls_last(), F.col(cols.score).desc_nulls_last(), F.col(cols.id).asc()]


def squad_summary(marked: DataFrame, squad: Sequence[str], cols: CandidateColumns = CandidateColumns()) -> DataFrame:
    """Totals per squad and position, per squad, and over all squads, in one pass.

    ``(squad, position, level, players, starters, total_cost, starters_cost, starters_score)`` with level position, squad or all; the
    columns that a level sums over are NULL, as are unknown squads and positions, which the level tells apart. Sums are of decimals, so
    they do not depend on the order of rows."""
    sets = [[*squad, cols.position], [*squad], []]
    everything = [F.col(c) for c in (*squad, cols.position)]
    started, exact = F.col("is_starter"), "decimal(28,6)"
    cost, score = F.col(cols.cost).cast(exact), F.col(cols.score).cast(exact)
    level = F.when(F.grouping(cols.position) == 0, "position")
    level = level.when(F.grouping(squad[0]) == 0, "squad").otherwise("all") if squad else level.otherwise("all")
    if not squad:
        sets = sets[::2]
    return marked.groupingSets([[F.col(c) for c in one] for one in sets], *everything).agg(
        level.alias("level"), F.count(F.lit(1)).alias("players"), F.count_if(started).alias("starters"),
        F.sum(cost).cast("double").alias("total_cost"),
        F.sum(F.when(started, cost)).cast("double").alias("starters_cost"),
        F.sum(F.when(started, score)).cast("double").alias("starters_score"))


def squad_totals(marked: DataFrame, squad: Sequence[str], cols: CandidateColumns = CandidateColumns()) -> DataFrame:
    """Cost and score of the whole squad and of its starters, under separate names."""
    started = F.col("is_starter")

    def over(column: str, flag: Column | None = None) -> Column:
        return F.sum(F.col(column) if flag is None else F.when(flag, F.col(column)))

    return marked.groupBy(*squad).agg(
        over(cols.cost).alias("total_cost"),
        over(cols.score, started).alias("total_score"),
        over(cols.cost, started).alias("starters_cost"),
        F.count_if(started).alias("starters"),
        F.count(cols.id).alias("players"),
    )


def squad_check(squads: DataFrame, squad: Sequence[str], budget: float = BUDGET,
                rules: SquadRules = SquadRules(), cols: CandidateColumns = CandidateColumns()) -> DataFrame:
    """Count rule violations per squad: ``(squad, rule, actual, allowed, violated)``.

    Counted per club first, so a large squad reaches its final group as one row
    per club."""
    positions = list(rules.position_limits)
    counts = [
        F.count_if(F.col(cols.position) == p).alias(f"__p{i}") for i, p in enumerate(positions)
    ]
    per_club = squads.groupBy(*squad, cols.club).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(F.col(cols.cost).cast("decimal(28,6)")).alias("__cost"), *counts
    )
    per_squad = per_club.groupBy(*squad).agg(
        F.sum("__n").alias("__n"), F.max("__n").alias("__club"), F.sum("__cost").alias("__cost"),
        *[F.sum(f"__p{i}").alias(f"__p{i}") for i in range(len(positions))],
    )

    def rule(name: str, actual: Column, allowed: float, broken: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"), actual.cast("double").alias("actual"),
            F.lit(float(allowed)).alias("allowed"), F.coalesce(broken, F.lit(True)).alias("violated"),
        )

    cost = F.col("__cost").cast("double")  # the raw cost, summed as decimals in any order
    rows = [
        rule("squad_size", F.col("__n"), rules.size, F.col("__n") != rules.size),
        rule("budget", cost, budget, cost > budget),
        rule("club_limit", F.col("__club"), rules.club_limit, F.col("__club") > rules.club_limit),
        *[
            rule(f"position_{p}", F.col(f"__p{i}"), limit, F.col(f"__p{i}") != limit)
            for i, (p, limit) in enumerate(rules.position_limits.items())
        ],
    ]
    return per_squad.select(*squad, F.inline(F.array(*rows)))
