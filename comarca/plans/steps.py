"""Steps shared by the transforms, and the record of what was done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.functions import naming
from comarca.operators import duplicates, missing
from comarca.operators.combine import union_all
from comarca.schemas import PIPELINE_VERSION


# What the log calls each operation.
CLEAN_NAMES = "clean_column_names"
REMOVE_DUPLICATES = "remove_duplicates"
HANDLE_MISSING = "handle_missing"
RENAME_COLUMNS = "rename_columns"
CALCULATE_RATIO = "calculate_ratio"
CATEGORIZE = "categorize"
EXTRACT_MUNICIPALITY = "extract_municipio"
CLEAN_TOTALS = "clean_totals"
ADD_CODES = "add_codes"


class StepLog:
    """Applied steps, as rows ``(position, timestamp, operation, details)``.

    A detail may be text or a one-row frame that works it out, so keeping the
    log starts no job of its own.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, str | tuple[DataFrame, Column]]] = []

    def add(self, operation: str, details: str) -> None:
        self._steps.append((operation, details))

    def add_counted(self, operation: str, counts: DataFrame, details: Column) -> None:
        self._steps.append((operation, (counts, details)))

    def frame(self, spark: SparkSession) -> DataFrame:
        parts = []
        for position, (operation, details) in enumerate(self._steps, 1):
            counts, text = (spark.range(1), F.lit(details)) if isinstance(details, str) else details
            parts.append(
                counts.select(
                    F.lit(position).alias("position"),
                    F.current_timestamp().alias("timestamp"),
                    F.lit(operation).alias("operation"),
                    text.alias("details"),
                )
            )
        if not parts:
            return spark.createDataFrame([], "position int, timestamp timestamp, operation string, details string")
        return union_all(parts)


def clean_names(df: DataFrame, log: StepLog | None = None) -> DataFrame:
    cleaned = naming.clean_names(df)
    if log:
        changed = sum(a != b for a, b in zip(df.columns, cleaned.columns))
        log.add(CLEAN_NAMES, f"{changed} of {len(cleaned.columns)} names changed: {', '.join(cleaned.columns)}")
    return cleaned


def remove_duplicates(
    df: DataFrame, subset: list[str] | None = None, order: list[str] | None = None, log: StepLog | None = None
) -> DataFrame:
    if log:
        details = F.concat(F.lit("rows dropped: "), F.col("removed").cast("string"))
        log.add_counted(REMOVE_DUPLICATES, duplicates.duplicate_counts(df, subset), details)
    return duplicates.drop_duplicates(df, subset, order)


def handle_missing(
    df: DataFrame,
    strategy: str = "drop",
    order: tuple[str, ...] = (),
    by: tuple[str, ...] = (),
    log: StepLog | None = None,
) -> DataFrame:
    handled = missing.handle_missing(df, strategy, order, by)
    if log:
        details = F.concat(F.lit(f"{strategy}: rows touched: "), F.col("affected").cast("string"))
        log.add_counted(HANDLE_MISSING, missing.missing_report(df, handled, strategy), details)
    return handled


def add_audit_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"fecha_procesamiento": F.current_timestamp(), "version_pipeline": F.lit(PIPELINE_VERSION)}
    )
