"""The set of sources a run reads, and the first look at what came back."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca import schemas
from comarca.sources import delimited, workbook

log = logging.getLogger("comarca")

Reader = Callable[[SparkSession], DataFrame]


def open_data_readers(root: str, industry_schema: str | None = None, rejected: str | None = None) -> dict[str, Reader]:
    """Readers of the three published sources below ``root``.

    ``rejected`` names a column for the cells of text files that did not parse; a run takes
    ``schemas.REJECTED_CELLS`` apart as a report of its own.
    """
    indicators = f"{root}/despoblamiento/{schemas.INDICATOR_FILE}"
    return {
        "despoblamiento": partial(delimited.read_file, path=indicators, schema=schemas.INDICATOR_SCHEMA, rejected=rejected),
        "poblacion": partial(
            delimited.read_folder, folder=f"{root}/pob_x_munic_y_sexo", schema=schemas.POPULATION_SCHEMA, rejected=rejected
        ),
        "industria": partial(workbook.read_folder, folder=f"{root}/industria", schema=industry_schema),
    }


def empty_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "source_file string")


def extract_all(
    spark: SparkSession, readers: dict[str, Reader], errors: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Lazy plan of every source; one that cannot be opened becomes an empty table.

    Reads are lazy, so a file that breaks while it is scanned shows up at the
    action that reads it: the run isolates that one per source as well.
    """
    data = {}
    for name, read in readers.items():
        try:
            data[name] = read(spark)
        except Exception as error:
            log.error("extraction of %s failed: %s", name, error)
            if errors is not None:
                errors[name] = str(error)
            data[name] = empty_table(spark)
    return data


def is_valid(df: DataFrame) -> bool:
    """Whether there is at least one row; stops at the first one found."""
    return not df.isEmpty()


def validation_report(data: dict[str, DataFrame]) -> DataFrame:
    """``(source, non_empty, total_rows, total_columns)`` of each table, in one pass each."""
    reports = [
        df.agg(F.count(F.lit(1)).alias("total_rows")).select(
            F.lit(name).alias("source"),
            (F.col("total_rows") > 0).alias("non_empty"),
            "total_rows",
            F.lit(len(df.columns)).alias("total_columns"),
        )
        for name, df in data.items()
    ]
    result = reports[0]
    for report in reports[1:]:
        result = result.union(report)
    return result
