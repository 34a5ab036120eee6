"""Industry by municipality: transform and reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca import schemas
from comarca.functions import scalars
from comarca.operators.combine import lookup_codes
from comarca.plans import steps
from comarca.plans.ranking import descending, largest, rounded_mean, rounded_sum, top

GDP = "pib_municipios_2016"
GVA = "vab_corregido_2016"
AFFILIATES = "afiliados_diciembre_de_2016"
SECTOR = schemas.SECTOR_COLUMN


def transform(
    df: DataFrame, log: steps.StepLog | None = None, codes: Mapping[str, int] = schemas.PROVINCE_CODES
) -> DataFrame:
    df = steps.clean_names(df, log)
    if "provincia" in df.columns:
        df = lookup_codes(df, codes)
        if log:
            unknown = df.agg(F.count_if(F.col("codigo_provincia_ine").isNull()).alias("n"))
            details = F.concat(F.lit("column added: codigo_provincia_ine; rows without a code: "), F.col("n").cast("string"))
            log.add_counted(steps.ADD_CODES, unknown, details)
    return steps.add_audit_columns(df)


def filter_industry(
    df: DataFrame,
    province: str | None = None,
    sector: str | None = None,
    limit: int = 100,
    order: tuple[str, ...] = (),
    sector_column: str = SECTOR,
) -> DataFrame:
    if not 0 <= limit <= 10_000:
        raise ValueError("limit must be between 0 and 10000")
    if province:
        df = df.where(scalars.contains_ignoring_case(F.col("provincia"), province))
    if sector:
        df = df.where(scalars.contains_ignoring_case(F.col(sector_column), sector))
    return (df.orderBy(*order) if order else df).limit(limit)


def industry_by_province_top(df: DataFrame, k: int = 10) -> DataFrame:
    grouped = df.where(F.col(GDP).isNotNull()).groupBy("provincia").agg(
        F.countDistinct("municipio").alias("num_municipios"),
        rounded_sum(GDP).alias("pib_total"),
        rounded_mean(GDP, 0).alias("pib_promedio"),
    )
    return top(grouped, "pib_total", k, "provincia")


def industry_by_province(df: DataFrame) -> DataFrame:
    grouped = df.where(F.col("provincia").isNotNull()).groupBy("provincia").agg(
        F.countDistinct("municipio").alias("num_municipios"),
        rounded_sum(GDP).alias("pib_total"),
        rounded_sum(GVA).alias("valor_anadido_total"),
        rounded_sum(AFFILIATES).alias("afiliados_total"),
    )
    return descending(grouped, "pib_total", "provincia")


def industry_gdp(df: DataFrame, k: int | None = None) -> DataFrame:
    grouped = df.where(F.col(GDP).isNotNull()).groupBy("provincia").agg(F.sum(GDP).alias("pib"))
    return largest(grouped, "pib", k, "provincia")


def industry_gdp_detail(df: DataFrame, k: int | None = None) -> DataFrame:
    grouped = df.where(F.col(GDP).isNotNull()).groupBy("provincia").agg(
        F.sum(GDP).alias("pib_total"),
        F.countDistinct("municipio").alias("num_municipios"),
        F.sum(AFFILIATES).alias("afiliados"),
    )
    return largest(grouped, "pib_total", k, "provincia")


def industry_gdp_top(df: DataFrame, k: int = 10) -> DataFrame:
    grouped = df.where(F.col(GDP).isNotNull()).groupBy(F.col("provincia").alias("province")).agg(
        rounded_sum(GDP).alias("total_gdp"), F.countDistinct("municipio").alias("municipalities")
    )
    return top(grouped, "total_gdp", k, "province")


def _by_sector(df: DataFrame, sector_column: str):
    return df.where(F.col(sector_column).isNotNull()).groupBy(F.col(sector_column).alias("sector"))


def sectors_top(df: DataFrame, k: int = 10, sector_column: str = SECTOR) -> DataFrame:
    grouped = _by_sector(df, sector_column).agg(
        F.count(F.lit(1)).alias("num_registros"),
        rounded_sum(GVA).alias("vab_total"),
        rounded_sum(AFFILIATES).alias("total_afiliados"),
    )
    return top(grouped, "vab_total", k, "sector")


def sectors_all(df: DataFrame, sector_column: str = SECTOR) -> DataFrame:
    grouped = _by_sector(df, sector_column).agg(
        F.count(F.lit(1)).alias("num_registros"),
        rounded_sum(GVA).alias("valor_anadido_total"),
        rounded_sum(AFFILIATES).alias("afiliados_total"),
        rounded_mean(GVA, 2).alias("valor_anadido_promedio"),
    )
    return descending(grouped, "valor_anadido_total", "sector")


def sectors_gva(df: DataFrame, k: int = 10, sector_column: str = SECTOR) -> DataFrame:
    grouped = _by_sector(df, sector_column).agg(
        rounded_sum(GVA).alias("gross_value_added"), rounded_sum(AFFILIATES).alias("affiliates")
    )
    return top(grouped, "gross_value_added", k, "sector")


def sectors_gva_known(df: DataFrame, k: int = 10, sector_column: str = SECTOR) -> DataFrame:
    """The same, unrounded, over rows whose value added is known."""
    grouped = _by_sector(df.where(F.col(GVA).isNotNull()), sector_column).agg(
        F.sum(GVA).alias("vab"), F.sum(AFFILIATES).alias("afiliados")
    )
    return top(grouped, "vab", k, "sector")
