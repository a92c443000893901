"""Layer databases and the tables in them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold", "audit")


@dataclass(frozen=True)
class Warehouse:
    """Names tables ``<prefix><layer>.<table>``; the prefix is the run parameter."""

    spark: SparkSession
    prefix: str = ""
    table_format: str = "parquet"

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def create_layers(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}")

    def read(self, layer: str, table: str) -> DataFrame:
        self._recover(layer, table)
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        self._recover(layer, table)
        return self.spark.catalog.tableExists(self.name(layer, table))

    def overwrite(self, df: DataFrame, layer: str, table: str) -> None:
        """Replace the table's rows and, if it changed, its schema; a write that fails leaves the old table as it is.

        The rows go to a new table first, which then takes the name of the old one. If a run ends between the two renames, the next
        :meth:`exists`, :meth:`read` or :meth:`overwrite` puts the old table back. Delta tables are replaced in one commit."""
        if self.table_format == "delta":
            df.write.format("delta").mode("overwrite").option("overwriteSchema", "true").saveAsTable(self.name(layer, table))
            return
        staging = self.name(layer, f"{table}__new_{uuid.uuid4().hex[:12]}")
        try:
            df.write.format(self.table_format).saveAsTable(staging)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {staging}")
            raise
        name, old = self.name(layer, table), self._old(layer, table)
        if self.exists(layer, table):
            self.spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
        self.spark.sql(f"DROP TABLE IF EXISTS {old}")

    def _old(self, layer: str, table: str) -> str:
        return self.name(layer, f"{table}__old")

    def _recover(self, layer: str, table: str) -> None:
        """Finish or undo a replacement that was cut off."""
        if self.spark.catalog.tableExists(self._old(layer, table)):
            if self.spark.catalog.tableExists(self.name(layer, table)):
                self.spark.sql(f"DROP TABLE {self._old(layer, table)}")
            else:
                self.spark.sql(f"ALTER TABLE {self._old(layer, table)} RENAME TO {self.name(layer, table)}")

    def append(self, df: DataFrame, layer: str, table: str) -> None:
        df.write.format(self.table_format).mode("append").saveAsTable(self.name(layer, table))
