"""Reports over several of the datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.operators.combine import union_all
from comarca.plans.indicators import CATEGORY
from comarca.plans.industry import GDP


def count_per_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("tabla"), "registros")
            for name, df in tables.items()
        ]
    )


def industry_gdp_by_code(industry: DataFrame, code: str = "codigo_provincia_ine") -> DataFrame:
    known = industry.where(F.col(GDP).isNotNull() & F.col(code).isNotNull())
    return known.groupBy(F.col(code).alias("codigo_provincia")).agg(F.round(F.sum(GDP), 0).alias("pib_industrial"))


def cross_analysis(indicators: DataFrame, industry: DataFrame) -> DataFrame:
    """Economic means per depopulation class beside the industrial GDP of its provinces.

    Province names differ between the sources, so they meet on the INE code. Each
    side is summed per code before they are joined: what is shuffled is a few
    rows per code and class, whatever share of the rows one province has.
    """
    per_province = (
        indicators.where(F.col(CATEGORY).isNotNull())
        .groupBy(CATEGORY, "codigo_provincia")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[
                f(column).alias(f"{name}_{column}")
                for column in ("poblacion_total", "pib_precios_corrientes", "tasa_paro_total")
                for name, f in (("sum", F.sum), ("count", F.count))
            ],
        )
    )
    joined = per_province.join(industry_gdp_by_code(industry), "codigo_provincia", "left")

    def mean(column: str, digits: int):
        total = F.try_divide(F.sum(f"sum_{column}"), F.sum(f"count_{column}"))
        return F.round(total, digits)

    return joined.groupBy(CATEGORY).agg(
        F.sum("n").alias("num_registros"),
        mean("poblacion_total", 0).alias("poblacion_promedio"),
        mean("pib_precios_corrientes", 0).alias("pib_promedio"),
        mean("tasa_paro_total", 2).alias("tasa_paro_promedio"),
        F.round(F.sum("pib_industrial"), 0).alias("pib_industrial"),
    )
