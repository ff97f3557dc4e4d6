"""Access to the input tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


class Lake:
    """Lazy readers for the parquet tables below ``root``; columns and filters are pruned by the scan."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._rows: dict[str, int] = {}

    def path(self, name: str) -> str:
        if name not in TABLES:
            raise ValueError(f"unknown table {name}; expected one of {sorted(TABLES)}")
        return f"{self.root}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def rows(self, name: str) -> int:
        """Rows of a table, counted once and from the footers of its files."""
        if name not in self._rows:
            self._rows[name] = self.table(name).count()
        return self._rows[name]
