"""Where a run's results go, and the record of each load."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from comarca.sinks import files, tables, warehouse

log = logging.getLogger("comarca")

# Writes one table and returns how many rows the target holds, and where.
Loader = Callable[[DataFrame, str], tuple[int, str]]

TARGETS = ("table", "warehouse", "object_store", "file")


def expand_targets(targets: list[str] | None = None) -> list[str]:
    """The default is the catalog; ``all`` stands for the catalog and the cloud warehouse."""
    targets = list(targets or ["table"])
    return ["table", "warehouse"] if "all" in targets else targets


@dataclass
class LoadLog:
    """Rows ``(timestamp, table, rows_loaded, status)``."""

    entries: list[tuple[datetime, str, int, str]] = field(default_factory=list)

    def add(self, table: str, rows: int, status: str) -> None:
        self.entries.append((datetime.now(), table, rows, status))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.entries, "timestamp timestamp, table string, rows_loaded long, status string"
        )


def table_loader(
    mode: str = "replace",
    folder: str | None = None,
    prefix: str = "",
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> Loader:
    """Loads into catalog tables; ``partition_by`` names the partition columns of a table."""

    def load(df: DataFrame, name: str) -> tuple[int, str]:
        table = f"{prefix}{name}"
        if mode == "replace":
            path = f"{folder}/{name}" if folder else None
            tables.replace_table(df, table, path, (partition_by or {}).get(name, ()))
        else:
            tables.append_table(df, table)
        return tables.loaded_rows(df, table), table

    return load


def _counting(write: Callable[[DataFrame, str], str]) -> Loader:
    """Counts the rows as they are written, instead of working out the table twice."""

    def load(df: DataFrame, name: str) -> tuple[int, str]:
        written = Observation()
        place = write(df.observe(written, F.count(F.lit(1)).alias("rows")), name)
        return written.get.get("rows", 0), place

    return load


def file_loader(base: str, kind: str = "parquet") -> Loader:
    return _counting(lambda df, name: files.export_file(df, base, name, kind))


def object_loader(base: str, kind: str = "jsonl") -> Loader:
    return _counting(lambda df, name: files.export_object(df, base, name, kind))


def warehouse_loader(url: str, mode: str = "replace", properties: Mapping[str, str] | None = None) -> Loader:
    def write(df: DataFrame, name: str) -> str:
        warehouse.load(df, url, name, mode, properties)
        return name.upper()

    return _counting(write)


def load_one(df: DataFrame, name: str, loader: Loader, record: LoadLog) -> bool:
    try:
        rows, place = loader(df, name)
    except Exception as error:
        log.error("load of %s failed: %s", name, error)
        record.add(name, 0, f"FAILED: {error}")
        return False
    record.add(name, rows, f"SUCCESS - {place}")
    return True


def load_all(
    data: Mapping[str, DataFrame], target: str, loaders: Mapping[str, Loader], record: LoadLog | None = None
) -> dict[str, bool]:
    """Loads every table as ``fact_<name>``; an empty one is not loaded."""
    if target not in loaders:
        raise ValueError(f"unsupported target: {target}")
    record = record if record is not None else LoadLog()
    results = {}
    for name, df in data.items():
        results[name] = False if df.isEmpty() else load_one(df, f"fact_{name}", loaders[target], record)
    return results
