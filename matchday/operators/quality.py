"""Data-quality checks; each gives rows ``(check, table, violations)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A blocking check found violations."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphan_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Foreign keys absent from the dimension, with their row count. The fact is
    aggregated before the anti join, so a frequent key travels once per map task."""
    used = fact.filter(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias("__known"))
    return used.join(known, F.col(fact_key) == F.col("__known"), "left_anti")


def outside(column: str, low: float, high: float) -> Column:
    """True where the value is missing or outside [low, high]."""
    return F.col(column).isNull() | ~F.col(column).between(low, high)


def _named(check: str, table: str, violations: DataFrame) -> DataFrame:
    return violations.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"),
        F.col("violations").cast("bigint").alias("violations"),
    )


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    name = f"unique({','.join(keys)})"
    return _named(name, table, duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations")))


def check_orphans(fact: DataFrame, table: str, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    counted = orphan_keys(fact, fact_key, dim, dim_key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
    return _named(f"orphan({fact_key})", table, counted)


def check_rules(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Count the rows breaking each rule (a true rule is a violation), in one pass."""
    names = list(rules)
    counts = df.agg(*[F.count_if(rules[name]).alias(f"v{i}") for i, name in enumerate(names)])
    rows = F.array(*[
        F.struct(F.lit(name).alias("check"), F.lit(table).alias("table"), F.col(f"v{i}").alias("violations"))
        for i, name in enumerate(names)
    ])
    return counts.select(F.inline(rows))


@dataclass(frozen=True)
class TableChecks:
    """What is checked of one table: unique keys, references ``column -> (table, key)`` and rules (true is a violation)."""

    table: str
    df: DataFrame
    unique: Sequence[Sequence[str]] = ()
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    rules: Mapping[str, Column] = field(default_factory=dict)


def check_tables(tables: Sequence[TableChecks]) -> DataFrame:
    """All checks of several tables: one scan of each table and one aggregation by (check, key).

    Every row gives one entry for each check it takes part in: the key it must be alone with, the key it refers to, the key it makes
    known to the tables that refer to it, or a broken rule. Keys are compared as JSON text, NULL as a value of its own; a NULL
    reference is no orphan. Frequent keys are added up before the shuffle."""
    names: list[tuple[str, str, str]] = []  # check, table, kind
    entries: dict[str, list[Column]] = {t.table: [] for t in tables}

    def entry(check: int, key: Column, uses: int) -> Column:
        return F.struct(F.lit(check).alias("id"), key.alias("key"), F.lit(uses).cast("bigint").alias("uses"))

    def numbered(check: str, table: str, kind: str) -> int:
        names.append((check, table, kind))
        return len(names) - 1

    for t in tables:
        for keys in t.unique:
            check = numbered(f"unique({','.join(keys)})", t.table, "unique")
            entries[t.table].append(entry(check, F.to_json(F.struct(*keys)), 1))
        for column, (dim, key) in t.references.items():
            check = numbered(f"orphan({column})", t.table, "orphan")
            used = F.when(F.col(column).isNotNull(), entry(check, F.to_json(F.struct(F.col(column).alias("k"))), 1))
            entries[t.table].append(used)
            entries[dim].append(entry(check, F.to_json(F.struct(F.col(key).alias("k"))), 0))
        for name, rule in t.rules.items():
            check = numbered(name, t.table, "rule")
            entries[t.table].append(F.when(rule, entry(check, F.lit(None).cast("string"), 1)))

    used = [t.df.select(F.inline(F.array_compact(F.array(*entries[t.table])))) for t in tables if entries[t.table]]
    if not used:
        raise ValueError("no checks")
    per_key = reduce(DataFrame.unionAll, used).groupBy("id", "key").agg(
        F.sum("uses").alias("n"), F.max(F.col("uses") == 0).alias("known"))
    kinds = F.array(*[F.lit(kind) for _, _, kind in names])[F.col("id")]
    broken = F.when(kinds == "unique", (F.col("n") > 1).cast("bigint")).when(
        kinds == "orphan", F.when(F.col("known"), F.lit(0)).otherwise(F.col("n"))).otherwise(F.col("n"))
    violations = per_key.groupBy("id").agg(F.sum(broken).alias("violations"))
    listed = used[0].sparkSession.createDataFrame(
        [(i, check, table) for i, (check, table, _) in enumerate(names)], "id INT, check STRING, table STRING")
    return listed.join(violations, "id", "left").select("check", "table", F.coalesce("violations", F.lit(0)).alias("violations"))


def report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require_clean(checks: DataFrame, blocking: Sequence[str] | None = None) -> None:
    """Raise if any check (or any of the ``blocking`` ones) has violations."""
    failed = checks.filter(F.col("violations") > 0)
    if blocking is not None:
        failed = failed.filter(F.col("check").isin(list(blocking)))
    rows = failed.orderBy("table", "check").collect()  # at most one row per check
    if rows:
        raise QualityError("; ".join(f"{r['table']}: {r['check']} = {r['violations']}" for r in rows))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows ``(table, n)``, one per table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        for name, df in tables.items()
    ])
