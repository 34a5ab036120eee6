"""The given tables seen as the three datasets the library works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.plans import indicators as indicator_plans
from comarca.plans import industry as industry_plans
from comarca.schemas import SexLabels

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Values of l_returnflag that play the three sexes.
SEXES = SexLabels(total="N", men="A", women="R")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, names=NAMES) -> list[str]:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return list(names)


def population(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``first``/``last`` bound the years at the scan, where they become pushed filters."""
    rows = table(spark, sf_dir, "lineitem")
    if first is not None:
        rows = rows.where(F.col("l_shipdate") >= F.lit(f"{first}-01-01").cast("timestamp_ntz"))
    if last is not None:
        rows = rows.where(F.col("l_shipdate") < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz"))
    return rows.select(
        F.col("l_suppkey").alias("codigo_provincia"),
        F.col("l_suppkey").alias("nombre_provincia"),
        F.col("l_partkey").alias("codigo_municipio"),
        F.col("l_linenumber").alias("nombre_municipio"),
        F.col("l_returnflag").alias("sexo"),
        F.year("l_shipdate").alias("periodo"),
        F.col("l_quantity").alias("total"),
    )


POPULATION = """population AS (
  SELECT l_suppkey AS codigo_provincia, l_suppkey AS nombre_provincia, l_partkey AS codigo_municipio,
         l_linenumber AS nombre_municipio, l_returnflag AS sexo,
         CAST(year(l_shipdate) AS INTEGER) AS periodo, l_quantity AS total
  FROM lineitem)"""


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("int").alias("codigo_provincia"),
        F.col("l_suppkey").alias("nombre_provincia"),
        (F.col("l_discount") * 1000).alias("porcentaje_despoblamiento"),
        F.col("l_extendedprice").alias("poblacion_total"),
        F.col("l_quantity").alias("poblacion_hombres"),
        F.col("l_linenumber").alias("poblacion_mujeres"),
        F.col("l_linenumber").cast("double").alias("tasa_actividad_total"),
        F.col("l_quantity").alias("tasa_empleo_total"),
        (F.col("l_tax") * 100).alias("tasa_paro_total"),
        F.col("l_extendedprice").alias("pib_precios_corrientes"),
        "l_orderkey",
        "l_partkey",
    )
    return indicator_plans.add_category(rows)


CATEGORY = """CASE WHEN {x} > 0 AND {x} <= 25 THEN 'Low' WHEN {x} > 25 AND {x} <= 50 THEN 'Medium'
       WHEN {x} > 50 AND {x} <= 75 THEN 'High' WHEN {x} > 75 AND {x} <= 100 THEN 'Very High' END"""

INDICATORS = f"""indicators AS (
  SELECT CAST(l_quantity AS INTEGER) AS codigo_provincia, l_suppkey AS nombre_provincia,
         l_discount * 1000 AS porcentaje_despoblamiento, l_extendedprice AS poblacion_total,
         l_quantity AS poblacion_hombres, l_linenumber AS poblacion_mujeres,
         CAST(l_linenumber AS DOUBLE) AS tasa_actividad_total, l_quantity AS tasa_empleo_total,
         l_tax * 100 AS tasa_paro_total, l_extendedprice AS pib_precios_corrientes, l_orderkey, l_partkey,
         {CATEGORY.format(x="(l_discount * 1000)")} AS categoria_despoblamiento
  FROM lineitem)"""

# The order of rows with the same percentage, so that a top-k has one answer.
INDICATOR_TIES = ("nombre_provincia", "poblacion_total", "l_orderkey", "tasa_empleo_total", "tasa_paro_total")


def industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as decimals, so that their sums do not depend on the order of rows."""
    price = F.col("p_retailprice").cast("decimal(18,2)")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("provincia"),
        F.col("p_partkey").alias("municipio"),
        F.col("p_size").alias("codigo_provincia_ine"),
        F.col("p_type").alias(industry_plans.SECTOR),
        price.alias(industry_plans.GDP),
        price.alias(industry_plans.GVA),
        F.col("p_size").cast("double").alias(industry_plans.AFFILIATES),
    )


INDUSTRY = f"""industry AS (
  SELECT p_brand AS provincia, p_partkey AS municipio, p_size AS codigo_provincia_ine,
         p_type AS {industry_plans.SECTOR}, CAST(p_retailprice AS DECIMAL(18,2)) AS {industry_plans.GDP},
         CAST(p_retailprice AS DECIMAL(18,2)) AS {industry_plans.GVA},
         CAST(p_size AS DOUBLE) AS {industry_plans.AFFILIATES}
  FROM part)"""


def decimals_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    )
