"""Audited table writes."""

from __future__ import annotations

import itertools
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from matchday import schemas
from matchday.sources.tables import Warehouse


class RunLog:
    """Rows per step event in ``audit.run_log``, written once at the end of each outermost step (a layer)."""

    def __init__(self, warehouse: Warehouse, run_id: str | None = None, input_version: str | None = None):
        self.warehouse = warehouse
        self.run_id = run_id or uuid.uuid4().hex
        self.input_version = input_version
        self._events: list[tuple] = []
        self._depth = 0

    def event(self, **event) -> None:
        row = {"run_id": self.run_id, "logged_at": datetime.now(timezone.utc), "input_version": self.input_version, **event}
        self._events.append(tuple(row.get(name) for name in schemas.RUN_LOG.names))
        if not self._depth:
            self.flush()

    def flush(self) -> None:
        """Write the events held so far."""
        if self._events:
            rows = self.warehouse.spark.createDataFrame(self._events, schemas.RUN_LOG).coalesce(1)
            self.warehouse.append(rows, "audit", "run_log")
            self._events = []

    @contextmanager
    def step(self, step: str, table: str | None = None) -> Iterator[dict]:
        """Log started and completed or failed around a block; errors are re-raised.
        The block may set ``row_count`` and another final ``status`` in the yielded dict."""
        result: dict = {}
        started = time.perf_counter()
        self._depth += 1
        self.event(step=step, table=table, status="started")
        try:
            yield result
        except Exception as error:
            self.event(step=step, table=table, status="failed", duration_s=round(time.perf_counter() - started, 2),
                       error_type=type(error).__name__, error=str(error))
            raise
        else:
            self.event(step=step, table=table, status=result.get("status", "completed"),
                       duration_s=round(time.perf_counter() - started, 2), row_count=result.get("row_count"))
        finally:
            self._depth -= 1
            if not self._depth:
                self.flush()


def finished_steps(warehouse: Warehouse, steps: Sequence[str], input_version: str) -> list[str]:
    """The first of ``steps`` that the last run finished, if it read the same input; none otherwise."""
    if not warehouse.exists("audit", "run_log"):
        return []
    log = warehouse.read("audit", "run_log")
    if "input_version" not in log.columns:
        return []
    last = log.agg(F.max_by("run_id", "logged_at").alias("run_id"))
    own = log.join(last, "run_id").filter(F.col("input_version") == input_version)
    done = own.filter(F.col("table").isNull() & F.col("step").isin(list(steps)) & F.col("status").isin("completed", "reused"))
    names = {r["step"] for r in done.select("step").distinct().collect()}  # at most the given steps
    return list(itertools.takewhile(names.__contains__, steps))


class TableSink:
    """Overwrites layer tables, counting the rows while they are written."""

    def __init__(self, warehouse: Warehouse, log: RunLog):
        self.warehouse = warehouse
        self.log = log

    def write(self, df: DataFrame, layer: str, table: str, keep_if_empty: bool = False) -> DataFrame:
        """Write and return the table read back. With ``keep_if_empty`` an empty
        input leaves an existing table as it is."""
        with self.log.step(f"{layer}_write", table) as result:
            if keep_if_empty and self.warehouse.exists(layer, table) and df.isEmpty():
                result["row_count"] = 0
            else:
                seen = Observation()
                self.warehouse.overwrite(df.observe(seen, F.count(F.lit(1)).alias("rows")), layer, table)
                result["row_count"] = seen.get.get("rows", 0)
        return self.warehouse.read(layer, table)
