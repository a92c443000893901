"""Exact removal of candidates that no best squad needs.

A candidate is dominated by another of its position that costs no more and scores no less (ties by cost, then id). It is dropped when
enough dominators sit in its own club, or in enough different clubs. No pair of candidates is ever formed: in the order of cost, then
score, the dominators of a candidate are the earlier ones that score no less, so it is enough to know the k-th highest score so far in
its club, and the k-th highest of the clubs' best scores so far.

Both are running maxima in a cascade: what the running maximum does not keep of each new value (the value itself, or the maximum it
replaces) is the input of the next running maximum, which is then the second highest, and so on. The rows are cut into slices of cost;
a slice starts from the best clubs of the slices before it, a bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.operators.slices import SLICE, range_slices
from matchday.operators.squad_rules import by_position

UNITS = "__units"
SAME_BOUND = "__same_bound"
CLUB_BOUND = "__club_bound"
CARRIED = "__carried"

# Every slice carries its best clubs to each later slice of the group, so their number is bounded.
MOST_SLICES = 128


def _bound(value: int | Mapping[str, int], position: str) -> tuple[Column, int]:
    if isinstance(value, int):
        return F.lit(value), value
    return by_position(value, F.col(position)), max(value.values())


def _best_of_best_clubs(pool: DataFrame, part: Sequence[str], club: str, score: str, id_column: str, most_same: int,
                        most_clubs: int) -> DataFrame:
    """Of every part, the ``most_clubs`` clubs with the highest best score, ``most_same`` rows of each, within the row's bounds."""
    in_club = Window.partitionBy(*part, club).orderBy(F.col(score).desc(), F.col(id_column).asc())
    pool = pool.withColumn("__rank", F.row_number().over(in_club)).filter(
        (F.col("__rank") <= most_same) & (F.col("__rank") <= F.col(SAME_BOUND)))
    leader = F.first(F.struct((-F.col(score)).alias("s"), F.col(id_column).alias("i"))).over(in_club)
    by_leader = Window.partitionBy(*part).orderBy(F.col("__leader"))
    return pool.withColumn("__leader", leader).withColumn("__club_rank", F.dense_rank().over(by_leader)).filter(
        (F.col("__club_rank") <= most_clubs) & (F.col("__club_rank") <= F.col(CLUB_BOUND))
    ).drop("__rank", "__leader", "__club_rank")


def _greater(a: Column, b: Column) -> Column:
    """Whether ``a`` is there and above ``b``, or ``b`` is missing."""
    return a.isNotNull() & (b.isNull() | (a > b))


def _running_tops(rows: DataFrame, before: Window, new: Column, old: Column | None, k: int, name: str) -> DataFrame:
    """Add ``name`` 1 to k: the highest, second highest, ... of the values that stand before each row.

    A row adds ``new`` (NULL: nothing) and, with ``old``, takes that lower value away. The highest never falls; below it, the value
    that the row pushes out takes the place of ``new``, unless ``old`` was the highest itself."""
    added, removed = f"__{name}_new", f"__{name}_old"
    rows = rows.withColumns({added: new, removed: F.lit(None) if old is None else old})
    for i in range(1, k + 1):
        top = F.col(f"{name}{i}")
        rows = rows.withColumn(f"{name}{i}", F.max(added).over(before))
        up = _greater(F.col(added), top)
        out = F.when(F.col(removed).eqNullSafe(top), None).otherwise(top) if old is not None else top
        pushed = F.when(up, out).otherwise(F.col(added))
        rows = rows.withColumns({added: pushed, removed: F.when(pushed.isNotNull(), F.col(removed))} if old is not None else {added: pushed})
    return rows.drop(added, removed)


def dominance_prune(df: DataFrame, groups: Sequence[str], position: str, club: str, units: Column,
                    score: str, id_column: str, same_bound: int | Mapping[str, int],
                    club_bound: int | Mapping[str, int], slices: int | None = None) -> DataFrame:
    """Keep the candidates with fewer than ``same_bound`` dominators in their own
    club and dominators in fewer than ``club_bound`` clubs, per group and position.

    Candidates without a position, a score, a cost or a club are not looked at: NULL clubs count as one club. The first filter is the
    same rule at equal cost: it runs as group limits on the map side and leaves at most ``club_bound x same_bound`` rows per cost
    level, whatever the input size. The rest is cut into slices of cost, so many price levels of one position use many tasks."""
    same, most_same = _bound(same_bound, position)
    clubs, most_clubs = _bound(club_bound, position)
    pool = df.filter(F.col(position).isNotNull() & F.col(score).isNotNull() & units.isNotNull())
    pool = pool.select("*", units.alias(UNITS), same.alias(SAME_BOUND), clubs.alias(CLUB_BOUND))
    part = [*groups, position]
    pool = _best_of_best_clubs(pool, [*part, UNITS], club, score, id_column, most_same, most_clubs)

    by_cost = [F.col(UNITS).asc(), F.col(score).desc(), F.col(id_column).asc()]
    if slices is None:
        slices = min(MOST_SLICES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sliced = range_slices(pool, [*[F.col(c).asc() for c in part], *by_cost], min(slices, MOST_SLICES))

    # The best clubs of a slice, sent to every later slice of its part: at most club_bound x same_bound rows for each of them.
    best = _best_of_best_clubs(sliced, [SLICE, *part], club, score, id_column, most_same, most_clubs)
    later = sliced.groupBy(SLICE, *part).agg(F.lit(None).alias("__none")).select(
        F.col(SLICE).alias("__later"), *[F.col(c).alias(f"__part_{c}") for c in part])
    same_part = [F.col(c).eqNullSafe(F.col(f"__part_{c}")) for c in part]
    carried = best.join(later, [*same_part, F.col(SLICE) < F.col("__later")]).withColumn(SLICE, F.col("__later"))
    rows = sliced.withColumn(CARRIED, F.lit(False)).unionByName(carried.select(*sliced.columns).withColumn(CARRIED, F.lit(True)))

    # Carried rows stand first by their cost; ties by score and id hold between slices as they do within one.
    rows = rows.repartition(SLICE, *part)
    value = F.col(score)
    in_club = Window.partitionBy(SLICE, *part, club).orderBy(*by_cost).rowsBetween(Window.unboundedPreceding, -1)
    rows = _running_tops(rows, in_club, value, None, most_same, "__own")
    own_best = F.col("__own1")
    raised = _greater(value, own_best)
    in_part = Window.partitionBy(SLICE, *part).orderBy(*by_cost).rowsBetween(Window.unboundedPreceding, -1)
    rows = _running_tops(rows, in_part, F.when(raised, value), F.when(raised, own_best), most_clubs, "__club")
    own = F.coalesce(*[F.when(F.col(SAME_BOUND) == i, F.col(f"__own{i}")) for i in range(1, most_same + 1)])
    others = F.coalesce(*[F.when(F.col(CLUB_BOUND) == i, F.col(f"__club{i}")) for i in range(1, most_clubs + 1)])
    kept = rows.filter(~F.col(CARRIED) & _greater(value, own) & _greater(value, others))
    return kept.select(*df.columns)
