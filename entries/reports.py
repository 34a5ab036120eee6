"""Filters, aggregates, rankings, windows and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from comarca.functions import scalars
from comarca.operators import distributions, questions, sketches
from comarca.plans import adhoc, cross, indicators, industry, population, ranking
from comarca.sinks.pinned import pin
from entries.tables import (
    INDICATOR_TIES,
    INDICATORS,
    INDUSTRY,
    POPULATION,
    SEXES,
    decimals_as_double,
    register,
    table,
)
from entries.tables import indicators as indicator_rows
from entries.tables import industry as industry_rows
from entries.tables import population as population_rows

QUERIES = {}
ORACLES = {}


def entry(key, sql=None):
    def add(query):
        QUERIES[key] = query
        if sql:
            ORACLES[key] = sql
        return query

    return add


_GDP, _GVA, _AFFILIATES, _SECTOR = industry.GDP, industry.GVA, industry.AFFILIATES, industry.SECTOR
_TIES = ", ".join(INDICATOR_TIES)

# ---- filters and projections -------------------------------------------------

_ORDER_ROWS = """SELECT o_orderkey, o_orderpriority AS nombre_provincia, o_orderstatus AS nombre_municipio,
  CAST(year(o_orderdate) AS INTEGER) AS periodo, o_totalprice AS total FROM orders"""


def _orders_as_population(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("nombre_provincia"),
        F.col("o_orderstatus").alias("nombre_municipio"),
        F.year("o_orderdate").alias("periodo"),
        F.col("o_totalprice").alias("total"),
    )


@entry(
    "filter_population",
    f"""SELECT * FROM ({_ORDER_ROWS}) WHERE lower(nombre_provincia) LIKE lower('%mEd%')
        AND lower(nombre_municipio) LIKE lower('%f%') AND periodo = 1998 ORDER BY o_orderkey LIMIT 100""",
)
def _(spark, sf_dir):
    rows = _orders_as_population(spark, sf_dir)
    return population.filter_population(rows, "mEd", "f", 1998, order=("o_orderkey",))


@entry(
    "filter_population_wildcard",
    f"""SELECT * FROM ({_ORDER_ROWS}) WHERE lower(nombre_provincia) LIKE lower('%N_T%D%')
        ORDER BY o_orderkey LIMIT 10000""",
)
def _(spark, sf_dir):
    rows = _orders_as_population(spark, sf_dir)
    return population.filter_population(rows, "N_T%D", "", 0, limit=10_000, order=("o_orderkey",))


@entry(
    "filter_indicators",
    f"""WITH {INDICATORS} SELECT * FROM indicators WHERE lower(categoria_despoblamiento) LIKE lower('%high%')
        ORDER BY porcentaje_despoblamiento DESC NULLS LAST, {_TIES}, l_partkey LIMIT 1000""",
)
def _(spark, sf_dir):
    ties = (*INDICATOR_TIES, "l_partkey")
    return indicators.filter_indicators(indicator_rows(spark, sf_dir), "high", 1000, ties)


@entry(
    "filter_industry",
    f"""WITH {INDUSTRY} SELECT provincia, municipio, codigo_provincia_ine, {_SECTOR}, CAST({_GDP} AS DOUBLE) AS {_GDP},
        CAST({_GVA} AS DOUBLE) AS {_GVA}, {_AFFILIATES} FROM industry WHERE lower(provincia) LIKE lower('%brand#1%')
        AND lower({_SECTOR}) LIKE lower('%econ%') ORDER BY municipio LIMIT 100""",
)
def _(spark, sf_dir):
    rows = industry_rows(spark, sf_dir)
    return decimals_as_double(industry.filter_industry(rows, "brand#1", "econ", order=("municipio",)))


_PROJECTED = """porcentaje_despoblamiento, poblacion_total, poblacion_hombres, poblacion_mujeres, tasa_actividad_total,
  tasa_empleo_total, tasa_paro_total, pib_precios_corrientes, categoria_despoblamiento"""


@entry(
    "project_not_null",
    f"WITH {INDICATORS} SELECT {_PROJECTED} FROM indicators WHERE porcentaje_despoblamiento IS NOT NULL",
)
def _(spark, sf_dir):
    return indicators.project_not_null(indicator_rows(spark, sf_dir))


@entry(
    "scatter_projection",
    f"""WITH {INDICATORS} SELECT tasa_empleo_total, tasa_paro_total, porcentaje_despoblamiento,
        pib_precios_corrientes / 1e9 AS pib_miles_de_millones
        FROM indicators WHERE porcentaje_despoblamiento IS NOT NULL""",
)
def _(spark, sf_dir):
    return indicators.scatter_projection(indicator_rows(spark, sf_dir))


@entry(
    "predicates",
    f"""WITH {POPULATION} SELECT sexo, periodo, COUNT(*) AS n FROM population
        WHERE sexo != 'N' AND periodo >= 1997 AND total > 25 AND nombre_municipio IN (1, 3, 5)
        AND codigo_municipio IS NOT NULL AND CAST(codigo_municipio AS VARCHAR) LIKE '%7%' AND nombre_provincia = 7
        GROUP BY sexo, periodo""",
)
def _(spark, sf_dir):
    rows = population_rows(spark, sf_dir, first=1997)
    kept = rows.where(
        (F.col("sexo") != SEXES.total)
        & (F.col("periodo") >= 1997)
        & (F.col("total") > 25)
        & F.col("nombre_municipio").isin(1, 3, 5)
        & F.col("codigo_municipio").isNotNull()
        & F.col("codigo_municipio").cast("string").like("%7%")
        & (F.col("nombre_provincia") == 7)
    )
    return kept.groupBy("sexo", "periodo").agg(F.count(F.lit(1)).alias("n"))


@entry(
    "adhoc_sql",
    """SELECT l_returnflag, COUNT(*) AS n, SUM(l_quantity) AS quantity FROM lineitem
       WHERE l_linestatus = 'O' AND l_quantity > 10 GROUP BY l_returnflag""",
)
def _(spark, sf_dir):
    register(spark, sf_dir, ["lineitem"])
    text = """SELECT l_returnflag, COUNT(*) AS n, SUM(l_quantity) AS quantity FROM lineitem
              WHERE l_linestatus = :status AND l_quantity > :least GROUP BY l_returnflag"""
    return adhoc.read_only_sql(spark, text, {"status": "O", "least": 10})


@entry(
    "preview_query",
    """SELECT l_suppkey, SUM(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey
       ORDER BY quantity DESC, l_suppkey LIMIT 15""",
)
def _(spark, sf_dir):
    register(spark, sf_dir, ["lineitem"])
    text = """SELECT l_suppkey, SUM(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey
              ORDER BY quantity DESC, l_suppkey"""
    return adhoc.preview(adhoc.read_only_sql(spark, text))


# ---- aggregates over the indicators ------------------------------------------


@entry(
    "count_per_table",
    """SELECT 'fact_despoblamiento' AS tabla, COUNT(*) AS registros FROM lineitem
       UNION ALL SELECT 'fact_poblacion', COUNT(*) FROM orders
       UNION ALL SELECT 'fact_industria', COUNT(*) FROM part""",
)
def _(spark, sf_dir):
    names = {"fact_despoblamiento": "lineitem", "fact_poblacion": "orders", "fact_industria": "part"}
    return cross.count_per_table({fact: table(spark, sf_dir, name) for fact, name in names.items()})


@entry(
    "indicators_by_category",
    f"""WITH {INDICATORS} SELECT categoria_despoblamiento, COUNT(*) AS provincias,
        format('{{:,.0f}}', AVG(poblacion_total)) AS poblacion_promedio,
        ROUND(AVG(tasa_paro_total), 2) AS tasa_paro_promedio, ROUND(AVG(pib_precios_corrientes), 0) AS pib_promedio
        FROM indicators WHERE categoria_despoblamiento IS NOT NULL GROUP BY categoria_despoblamiento""",
)
def _(spark, sf_dir):
    return indicators.indicators_by_category(indicator_rows(spark, sf_dir))


@entry(
    "category_stats",
    f"""WITH {INDICATORS} SELECT categoria_despoblamiento, COUNT(*) AS num_registros,
        ROUND(AVG(poblacion_total), 0) AS poblacion_promedio, ROUND(AVG(tasa_paro_total), 2) AS tasa_paro_promedio,
        ROUND(AVG(tasa_empleo_total), 2) AS tasa_empleo_promedio,
        ROUND(AVG(porcentaje_despoblamiento), 2) AS despoblamiento_promedio
        FROM indicators WHERE categoria_despoblamiento IS NOT NULL GROUP BY categoria_despoblamiento""",
)
def _(spark, sf_dir):
    return indicators.category_stats(indicator_rows(spark, sf_dir))


@entry(
    "category_economics",
    f"""WITH {INDICATORS} SELECT categoria_despoblamiento, COUNT(*) AS num_registros,
        ROUND(AVG(poblacion_total), 0) AS poblacion_promedio, ROUND(AVG(pib_precios_corrientes), 0) AS pib_promedio,
        ROUND(AVG(tasa_paro_total), 2) AS tasa_paro_promedio
        FROM indicators WHERE categoria_despoblamiento IS NOT NULL GROUP BY categoria_despoblamiento""",
)
def _(spark, sf_dir):
    return indicators.category_economics(indicator_rows(spark, sf_dir))


@entry(
    "rates_by_category",
    f"""WITH {INDICATORS} SELECT categoria_despoblamiento AS depopulation_category,
        ROUND(AVG(tasa_paro_total), 2) AS avg_unemployment_rate,
        ROUND(AVG(tasa_empleo_total), 2) AS avg_employment_rate,
        ROUND(AVG(tasa_actividad_total), 2) AS avg_activity_rate
        FROM indicators WHERE tasa_paro_total IS NOT NULL GROUP BY categoria_despoblamiento""",
)
def _(spark, sf_dir):
    return indicators.rates_by_category(indicator_rows(spark, sf_dir))


@entry(
    "category_correlation",
    f"""WITH {INDICATORS} SELECT categoria_despoblamiento, COUNT(*) AS num_records,
        ROUND(AVG(tasa_paro_total), 2) AS avg_unemployment, ROUND(AVG(tasa_empleo_total), 2) AS avg_employment
        FROM indicators WHERE categoria_despoblamiento IS NOT NULL GROUP BY categoria_despoblamiento""",
)
def _(spark, sf_dir):
    return indicators.category_correlation(indicator_rows(spark, sf_dir))


@entry(
    "category_means",
    f"""WITH {INDICATORS} SELECT categoria_despoblamiento, ROUND(AVG(tasa_paro_total), 6) AS tasa_paro_total,
        ROUND(AVG(poblacion_total), 6) AS poblacion_total
        FROM indicators WHERE categoria_despoblamiento IS NOT NULL GROUP BY categoria_despoblamiento""",
)
def _(spark, sf_dir):
    means = indicators.category_means(indicator_rows(spark, sf_dir))
    return means.select(
        "categoria_despoblamiento",
        *[F.round(c, 6).alias(c) for c in ("tasa_paro_total", "poblacion_total")],
    )


@entry(
    "order_by_category_rank",
    f"""WITH {INDICATORS}, ranked AS (SELECT categoria_despoblamiento, COUNT(*) AS n,
          CASE categoria_despoblamiento WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3
               WHEN 'Very High' THEN 4 END AS category_rank
        FROM indicators WHERE categoria_despoblamiento IS NOT NULL GROUP BY categoria_despoblamiento)
        SELECT * FROM ranked ORDER BY category_rank""",
)
def _(spark, sf_dir):
    rows = indicator_rows(spark, sf_dir).where(F.col(indicators.CATEGORY).isNotNull())
    counted = rows.groupBy(indicators.CATEGORY).agg(F.count(F.lit(1)).alias("n"))
    ranked = counted.withColumn("category_rank", scalars.label_rank(F.col(indicators.CATEGORY)))
    return indicators.order_by_category_rank(ranked)


# ---- aggregates over the population ------------------------------------------


@entry(
    "population_by_sex_top",
    f"""WITH {POPULATION} SELECT nombre_provincia, periodo AS anio, SUM(total) AS poblacion_total,
        SUM(CASE WHEN sexo = 'A' THEN total ELSE 0 END) AS hombres,
        SUM(CASE WHEN sexo = 'R' THEN total ELSE 0 END) AS mujeres
        FROM population WHERE sexo != 'N' AND periodo = 2000 GROUP BY nombre_provincia, periodo
        ORDER BY poblacion_total DESC, nombre_provincia LIMIT 10""",
)
def _(spark, sf_dir):
    return population.population_by_sex_top(population_rows(spark, sf_dir, 2000, 2000), 2000, sexes=SEXES)


_PIVOT = f"""WITH {POPULATION} SELECT nombre_provincia, SUM(CASE WHEN sexo = 'N' THEN total END) AS poblacion_total,
  SUM(CASE WHEN sexo = 'A' THEN total END) AS hombres, SUM(CASE WHEN sexo = 'R' THEN total END) AS mujeres
  FROM population WHERE periodo = 2000 GROUP BY nombre_provincia"""


@entry("population_pivot_sex", _PIVOT)
def _(spark, sf_dir):
    return population.population_pivot_sex(population_rows(spark, sf_dir, 2000, 2000), 2000, sexes=SEXES)


@entry(
    "population_pivot_sex_top", f"{_PIVOT} ORDER BY poblacion_total DESC NULLS LAST, nombre_provincia LIMIT 10"
)
def _(spark, sf_dir):
    return population.population_pivot_sex(population_rows(spark, sf_dir, 2000, 2000), 2000, 10, SEXES)


_BY_PROVINCE = f"""WITH {POPULATION} SELECT nombre_provincia, SUM(total) AS poblacion FROM population
  WHERE sexo = 'N' AND periodo = 2000 GROUP BY nombre_provincia"""


@entry("population_by_province", f"{_BY_PROVINCE} ORDER BY poblacion DESC, nombre_provincia LIMIT 15")
def population_by_province(spark, sf_dir):
    return population.population_by_province(population_rows(spark, sf_dir, 2000, 2000), 2000, 15, SEXES)


@entry("population_by_province_all", _BY_PROVINCE)
def _(spark, sf_dir):
    return population.population_by_province(population_rows(spark, sf_dir, 2000, 2000), 2000, sexes=SEXES)


@entry(
    "evolution_distinct",
    f"""WITH {POPULATION} SELECT periodo AS anio, SUM(total) AS poblacion_total,
        COUNT(DISTINCT codigo_municipio) AS num_municipios
        FROM population WHERE sexo = 'N' AND periodo >= 1997 GROUP BY periodo""",
)
def _(spark, sf_dir):
    return population.evolution_distinct(population_rows(spark, sf_dir, 1997), 1997, SEXES)


_SPANS = [(1992, 1993), (1994, 1998), (1992, 1998), (1990, 1991)]


@entry(
    "municipality_spans",
    f"""WITH {POPULATION} SELECT s.first, s.last, COUNT(DISTINCT codigo_municipio) AS num_municipios, true AS within_error
        FROM population JOIN (VALUES {', '.join(map(str, _SPANS))}) AS s(first, last) ON periodo BETWEEN s.first AND s.last
        WHERE sexo = 'N' GROUP BY s.first, s.last""",
)
def _(spark, sf_dir):
    """Estimates from stored sketches beside the exact counts, and whether their error is as stated."""
    rows = population_rows(spark, sf_dir)
    stored = pin(population.municipality_sketches(rows, SEXES), "sketches")
    estimates = population.municipalities_of_spans(stored, _SPANS)
    spans = F.explode(F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("last")) for a, b in _SPANS]))
    years = rows.where(F.col("sexo") == SEXES.total).groupBy("periodo", "codigo_municipio").agg(F.count(F.lit(1)).alias("n"))
    within = years.withColumn("span", spans).where(F.col("periodo").between(F.col("span.first"), F.col("span.last")))
    exact = within.groupBy("span.first", "span.last").agg(F.countDistinct("codigo_municipio").alias("num_municipios"))
    off = F.abs(F.col("estimate") - F.col("num_municipios"))
    return exact.join(estimates, ["first", "last"]).select(
        "first", "last", "num_municipios", (off <= sketches.largest_error(F.col("num_municipios"))).alias("within_error")
    )


@entry(
    "evolution",
    f"""WITH {POPULATION} SELECT periodo AS anio, SUM(total) AS poblacion_total
        FROM population WHERE sexo = 'N' GROUP BY periodo""",
)
def _(spark, sf_dir):
    return population.evolution(population_rows(spark, sf_dir), sexes=SEXES)


@entry(
    "evolution_since",
    f"""WITH {POPULATION} SELECT periodo AS anio, SUM(total) AS poblacion_total
        FROM population WHERE sexo = 'N' AND periodo >= 1998 GROUP BY periodo""",
)
def _(spark, sf_dir):
    return population.evolution(population_rows(spark, sf_dir, 1998), since=1998, sexes=SEXES)


@entry(
    "evolution_province",
    f"""SELECT periodo AS anio, CAST(SUM(CAST(total AS DECIMAL(18,2))) AS DOUBLE) AS poblacion_total
        FROM ({_ORDER_ROWS}) WHERE nombre_municipio = 'O' AND lower(nombre_provincia) LIKE lower('%Urg%')
        GROUP BY periodo""",
)
def _(spark, sf_dir):
    rows = _orders_as_population(spark, sf_dir).withColumns(
        {"sexo": F.col("nombre_municipio"), "total": F.col("total").cast("decimal(18,2)")}
    )
    return decimals_as_double(population.evolution(rows, "Urg", sexes=type(SEXES)(total="O")))


def _growth_sql(old, new, base):
    return f"""WITH {POPULATION}, sized AS (SELECT nombre_provincia, nombre_municipio,
        MAX(CASE WHEN periodo = {new} THEN total END) AS pob_{new},
        MAX(CASE WHEN periodo = {old} THEN total END) AS pob_{old}
        FROM population WHERE sexo = 'N' AND periodo IN ({old}, {new}) GROUP BY nombre_provincia, nombre_municipio
        HAVING MAX(CASE WHEN periodo = {old} THEN total END) > {base})
      SELECT *, ROUND((pob_{new} - pob_{old}) * 100.0 / NULLIF(pob_{old}, 0), 2) AS variacion_pct FROM sized
      ORDER BY variacion_pct DESC NULLS LAST, nombre_provincia, nombre_municipio LIMIT 10"""


@entry("growth_two_years", _growth_sql(1996, 2000, 10))
def _(spark, sf_dir):
    return population.growth(population_rows(spark, sf_dir, 1996, 2000), 1996, 2000, 10, sexes=SEXES)


@entry("growth_two_years_b", _growth_sql(1997, 2000, 5))
def _(spark, sf_dir):
    return population.growth(population_rows(spark, sf_dir, 1997, 2000), 1997, 2000, 5, sexes=SEXES)


@entry(
    "top_municipalities",
    f"""WITH {POPULATION} SELECT nombre_provincia AS province_name, nombre_municipio AS municipality_name,
        MAX(total) AS population FROM population WHERE sexo = 'N' AND periodo = 2000
        GROUP BY nombre_provincia, nombre_municipio
        ORDER BY population DESC, province_name, municipality_name LIMIT 15""",
)
def _(spark, sf_dir):
    return population.top_municipalities(population_rows(spark, sf_dir, 2000, 2000), 2000, sexes=SEXES)


@entry(
    "sum_by_sex",
    f"""WITH {POPULATION} SELECT sexo, SUM(total) AS poblacion FROM population
        WHERE sexo != 'N' AND periodo = 2000 GROUP BY sexo""",
)
def _(spark, sf_dir):
    return population.sum_by_sex(population_rows(spark, sf_dir, 2000, 2000), 2000, SEXES)


@entry(
    "municipalities_per_province",
    f"""WITH {POPULATION} SELECT nombre_provincia, COUNT(DISTINCT nombre_municipio) AS num_municipios,
        SUM(total) AS poblacion_total FROM population WHERE sexo = 'N' AND periodo = 2000
        GROUP BY nombre_provincia ORDER BY poblacion_total DESC, nombre_provincia LIMIT 10""",
)
def _(spark, sf_dir):
    return population.municipalities_per_province(population_rows(spark, sf_dir, 2000, 2000), 2000, sexes=SEXES)


def _summary_sql(where):
    return f"""WITH {POPULATION} SELECT codigo_provincia, nombre_provincia, periodo, SUM(total) AS poblacion_total,
        ROUND(AVG(total), 6) AS poblacion_media_municipio, COUNT(total) AS num_municipios
        FROM population {where} GROUP BY codigo_provincia, nombre_provincia, periodo"""


def _rounded_summary(df):
    return df.withColumn("poblacion_media_municipio", F.round("poblacion_media_municipio", 6))


@entry("population_summary", _summary_sql("WHERE sexo = 'N'"))
def _(spark, sf_dir):
    return _rounded_summary(population.population_summary(population_rows(spark, sf_dir), sexes=SEXES))


@entry("population_summary_unfiltered", _summary_sql(""))
def _(spark, sf_dir):
    return _rounded_summary(population.population_summary(population_rows(spark, sf_dir), True, SEXES))


@entry(
    "yoy_growth",
    f"""WITH {POPULATION}, yearly AS (SELECT periodo AS year, SUM(total) AS total_population FROM population
          WHERE sexo = 'N' AND periodo >= 1996 GROUP BY periodo),
        before AS (SELECT *, LAG(total_population) OVER (ORDER BY year) AS previous_year FROM yearly)
        SELECT *, ROUND((total_population - previous_year) * 100.0 / NULLIF(previous_year, 0), 2) AS growth_pct
        FROM before""",
)
def _(spark, sf_dir):
    return population.yoy_growth(population_rows(spark, sf_dir, 1996), 1996, SEXES)


@entry(
    "share_of_total",
    f"""WITH {POPULATION}, sums AS (SELECT sexo, SUM(total) AS value FROM population
          WHERE sexo != 'N' AND periodo = 2000 GROUP BY sexo)
        SELECT sexo, value, ROUND(100.0 * value / SUM(value) OVER (), 1) AS share_pct FROM sums""",
)
def _(spark, sf_dir):
    rows = population_rows(spark, sf_dir, 2000, 2000)
    rows = rows.where((F.col("sexo") != SEXES.total) & (F.col("periodo") == 2000))
    return population.share_of_total(rows, "sexo", "total")


# ---- aggregates over the industry --------------------------------------------


@entry(
    "industry_by_province_top",
    f"""WITH {INDUSTRY} SELECT provincia, COUNT(DISTINCT municipio) AS num_municipios,
        CAST(ROUND(SUM({_GDP}), 0) AS DOUBLE) AS pib_total, CAST(ROUND(AVG({_GDP}), 0) AS DOUBLE) AS pib_promedio
        FROM industry WHERE {_GDP} IS NOT NULL GROUP BY provincia ORDER BY pib_total DESC, provincia LIMIT 10""",
)
def _(spark, sf_dir):
    return decimals_as_double(industry.industry_by_province_top(industry_rows(spark, sf_dir)))


@entry(
    "industry_by_province",
    f"""WITH {INDUSTRY} SELECT provincia, COUNT(DISTINCT municipio) AS num_municipios,
        CAST(ROUND(SUM({_GDP}), 0) AS DOUBLE) AS pib_total, CAST(ROUND(SUM({_GVA}), 0) AS DOUBLE) AS valor_anadido_total,
        ROUND(SUM({_AFFILIATES}), 0) AS afiliados_total
        FROM industry WHERE provincia IS NOT NULL GROUP BY provincia""",
)
def _(spark, sf_dir):
    return decimals_as_double(industry.industry_by_province(industry_rows(spark, sf_dir)))


_GDP_SQL = f"""WITH {INDUSTRY} SELECT provincia, CAST(SUM({_GDP}) AS DOUBLE) AS pib FROM industry
  WHERE {_GDP} IS NOT NULL GROUP BY provincia"""


@entry("industry_gdp", _GDP_SQL)
def _(spark, sf_dir):
    return decimals_as_double(industry.industry_gdp(industry_rows(spark, sf_dir)))


@entry("industry_gdp_15", f"{_GDP_SQL} ORDER BY pib DESC, provincia LIMIT 15")
def _(spark, sf_dir):
    return decimals_as_double(industry.industry_gdp(industry_rows(spark, sf_dir), 15))


@entry(
    "industry_gdp_detail",
    f"""WITH {INDUSTRY} SELECT provincia, CAST(SUM({_GDP}) AS DOUBLE) AS pib_total,
        COUNT(DISTINCT municipio) AS num_municipios, SUM({_AFFILIATES}) AS afiliados
        FROM industry WHERE {_GDP} IS NOT NULL GROUP BY provincia""",
)
def _(spark, sf_dir):
    return decimals_as_double(industry.industry_gdp_detail(industry_rows(spark, sf_dir)))


@entry(
    "industry_gdp_top",
    f"""WITH {INDUSTRY} SELECT provincia AS province, CAST(ROUND(SUM({_GDP}), 0) AS DOUBLE) AS total_gdp,
        COUNT(DISTINCT municipio) AS municipalities FROM industry WHERE {_GDP} IS NOT NULL
        GROUP BY provincia ORDER BY total_gdp DESC, province LIMIT 10""",
)
def _(spark, sf_dir):
    return decimals_as_double(industry.industry_gdp_top(industry_rows(spark, sf_dir)))


@entry(
    "sectors_top",
    f"""WITH {INDUSTRY} SELECT {_SECTOR} AS sector, COUNT(*) AS num_registros,
        CAST(ROUND(SUM({_GVA}), 0) AS DOUBLE) AS vab_total, ROUND(SUM({_AFFILIATES}), 0) AS total_afiliados
        FROM industry WHERE {_SECTOR} IS NOT NULL GROUP BY {_SECTOR} ORDER BY vab_total DESC, sector LIMIT 10""",
)
def _(spark, sf_dir):
    return decimals_as_double(industry.sectors_top(industry_rows(spark, sf_dir)))


@entry(
    "sectors_all",
    f"""WITH {INDUSTRY} SELECT {_SECTOR} AS sector, COUNT(*) AS num_registros,
        CAST(ROUND(SUM({_GVA}), 0) AS DOUBLE) AS valor_anadido_total,
        ROUND(SUM({_AFFILIATES}), 0) AS afiliados_total,
        CAST(ROUND(AVG({_GVA}), 2) AS DOUBLE) AS valor_anadido_promedio
        FROM industry WHERE {_SECTOR} IS NOT NULL GROUP BY {_SECTOR}""",
)
def _(spark, sf_dir):
    return decimals_as_double(industry.sectors_all(industry_rows(spark, sf_dir)))


@entry(
    "sectors_gva",
    f"""WITH {INDUSTRY} SELECT {_SECTOR} AS sector, CAST(ROUND(SUM({_GVA}), 0) AS DOUBLE) AS gross_value_added,
        ROUND(SUM({_AFFILIATES}), 0) AS affiliates FROM industry WHERE {_SECTOR} IS NOT NULL
        GROUP BY sector ORDER BY gross_value_added DESC, sector LIMIT 10""",
)
def _(spark, sf_dir):
    return decimals_as_double(industry.sectors_gva(industry_rows(spark, sf_dir)))


@entry(
    "sectors_gva_known",
    f"""WITH {INDUSTRY} SELECT {_SECTOR} AS sector, CAST(SUM({_GVA}) AS DOUBLE) AS vab,
        SUM({_AFFILIATES}) AS afiliados FROM industry WHERE {_SECTOR} IS NOT NULL AND {_GVA} IS NOT NULL
        GROUP BY sector ORDER BY vab DESC, sector LIMIT 10""",
)
def _(spark, sf_dir):
    return decimals_as_double(industry.sectors_gva_known(industry_rows(spark, sf_dir)))


@entry(
    "cross_analysis",
    f"""WITH {INDICATORS}, {INDUSTRY}, by_code AS (SELECT codigo_provincia_ine AS code, ROUND(SUM({_GDP}), 0) AS gdp
          FROM industry WHERE {_GDP} IS NOT NULL GROUP BY codigo_provincia_ine),
        provinces AS (SELECT DISTINCT categoria_despoblamiento AS c, codigo_provincia AS code FROM indicators),
        gdp AS (SELECT c, CAST(ROUND(SUM(gdp), 0) AS DOUBLE) AS pib_industrial
          FROM provinces LEFT JOIN by_code USING (code) GROUP BY c),
        means AS (SELECT categoria_despoblamiento, COUNT(*) AS num_registros,
          ROUND(AVG(poblacion_total), 0) AS poblacion_promedio,
          ROUND(AVG(pib_precios_corrientes), 0) AS pib_promedio, ROUND(AVG(tasa_paro_total), 2) AS tasa_paro_promedio
          FROM indicators WHERE categoria_despoblamiento IS NOT NULL GROUP BY categoria_despoblamiento)
        SELECT means.*, pib_industrial FROM means JOIN gdp ON c = categoria_despoblamiento""",
)
def _(spark, sf_dir):
    return decimals_as_double(cross.cross_analysis(indicator_rows(spark, sf_dir), industry_rows(spark, sf_dir)))


# ---- distributions -----------------------------------------------------------


def _describe_sql(columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS "count", ROUND(AVG({c}), 6) AS mean,
            ROUND(STDDEV_SAMP({c}), 6) AS std, CAST(MIN({c}) AS DOUBLE) AS min,
            ROUND(QUANTILE_CONT({c}, 0.25), 6) AS q1, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS median,
            ROUND(QUANTILE_CONT({c}, 0.75), 6) AS q3, CAST(MAX({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in columns
    )


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@entry("describe", _describe_sql(_MEASURES))
def _(spark, sf_dir):
    described = distributions.describe(table(spark, sf_dir, "lineitem"), _MEASURES)
    return described.select(
        "column", "count", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "std", "q1", "median", "q3")]
    )


@entry(
    "histogram",
    """WITH span AS (SELECT MIN(l_extendedprice) AS lo, (MAX(l_extendedprice) - MIN(l_extendedprice)) / 20 AS step
         FROM lineitem),
       counted AS (SELECT CAST(LEAST(FLOOR((l_extendedprice - lo) / step), 19) AS INTEGER) AS bin, COUNT(*) AS n
         FROM lineitem, span GROUP BY 1)
       SELECT CAST(b.bin AS INTEGER) AS bin, ROUND(lo + b.bin * step, 6) AS bin_start,
         ROUND(lo + (b.bin + 1) * step, 6) AS bin_end, COALESCE(n, 0) AS "count"
       FROM (SELECT UNNEST(range(20)) AS bin) b CROSS JOIN span LEFT JOIN counted ON counted.bin = b.bin""",
)
def _(spark, sf_dir):
    bins = distributions.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


_FENCES = """quartiles AS (SELECT event_type, COUNT(value) AS "count", QUANTILE_CONT(value, 0.25) AS q1,
    QUANTILE_CONT(value, 0.5) AS median, QUANTILE_CONT(value, 0.75) AS q3 FROM events GROUP BY event_type),
  fenced AS (SELECT events.event_type, value, "count", q1, median, q3,
    value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
    FROM events JOIN quartiles ON events.event_type = quartiles.event_type)"""


@entry(
    "boxplot_stats",
    f"""WITH {_FENCES} SELECT event_type, "count", LEAST(MIN(value) FILTER (inside), ROUND(q1, 6)) AS whisker_low,
        ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
        GREATEST(MAX(value) FILTER (inside), ROUND(q3, 6)) AS whisker_high, COUNT(*) FILTER (NOT inside) AS outliers
        FROM fenced GROUP BY event_type, "count", fenced.q1, fenced.median, fenced.q3""",
)
def _(spark, sf_dir):
    stats = distributions.boxplot_stats(table(spark, sf_dir, "events"), "value", "event_type")
    return stats.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@entry("boxplot_outliers", f"WITH {_FENCES} SELECT event_type, value FROM fenced WHERE NOT inside")
def _(spark, sf_dir):
    return distributions.boxplot_outliers(table(spark, sf_dir, "events"), "value", "event_type")


# ---- rankings and samples ----------------------------------------------------


@entry(
    "topk_indicators",
    f"""WITH {INDICATORS} SELECT nombre_provincia, ROUND(porcentaje_despoblamiento, 1) AS pct_despoblamiento,
        poblacion_total, ROUND(tasa_actividad_total, 2) AS tasa_actividad, ROUND(tasa_empleo_total, 2) AS tasa_empleo,
        ROUND(tasa_paro_total, 2) AS tasa_paro, categoria_despoblamiento
        FROM indicators WHERE porcentaje_despoblamiento IS NOT NULL
        ORDER BY porcentaje_despoblamiento DESC, {", ".join("indicators." + t for t in INDICATOR_TIES)} LIMIT 10""",
)
def _(spark, sf_dir):
    return indicators.topk_indicators(indicator_rows(spark, sf_dir), ties=INDICATOR_TIES)


@entry(
    "topk_n",
    f"""WITH {INDICATORS} SELECT porcentaje_despoblamiento, poblacion_total, tasa_paro_total, tasa_empleo_total,
        categoria_despoblamiento FROM indicators WHERE porcentaje_despoblamiento IS NOT NULL
        ORDER BY porcentaje_despoblamiento DESC, {_TIES} LIMIT 25""",
)
def _(spark, sf_dir):
    return indicators.ranking(indicator_rows(spark, sf_dir), 25, INDICATOR_TIES)


@entry("sample_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 3")
def _(spark, sf_dir):
    return ranking.sample_rows(table(spark, sf_dir, "orders"), order=["o_orderkey"])


# ---- questions and answers ---------------------------------------------------


def _routing_sql(templates):
    scores = [
        " + ".join(f"CAST(contains(lower(text), '{word}') AS INTEGER)" for word in words)
        for words in templates.values()
    ]
    listed = ", ".join(scores)
    names = ", ".join(f"'{name}'" for name in templates)
    descriptions, reports = (
        ", ".join(f"'{values[name]}'" if name in values else "NULL" for name in templates)
        for values in (questions.TEMPLATE_DESCRIPTIONS, questions.TEMPLATE_REPORTS)
    )
    nothing = questions.no_answer()
    return f"""WITH scored AS (SELECT doc_id, [{listed}] AS scores FROM documents)
        SELECT doc_id, CAST(list_max(scores) AS INTEGER) AS score,
          CASE WHEN list_max(scores) > 0 THEN [{names}][list_position(scores, list_max(scores))] END AS template,
          CASE WHEN list_max(scores) > 0 THEN CAST([{descriptions}] AS VARCHAR[])[list_position(scores, list_max(scores))]
            ELSE '{nothing}' END AS description,
          CASE WHEN list_max(scores) > 0 THEN CAST([{reports}] AS VARCHAR[])[list_position(scores, list_max(scores))] END AS report
        FROM scored"""


@entry("route_questions", _routing_sql(questions.TEMPLATE_KEYWORDS))
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return questions.route_questions(docs).select("doc_id", "score", "template", "description", "report")


# Words the given texts do contain, so that scores and ties occur.
_FREQUENT = {"english": ["the", "that", "and"], "french": ["une", "que", "les"], "spanish": ["que", "los", "con"]}


@entry("route_questions_frequent", _routing_sql(_FREQUENT))
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = questions.route_questions(docs, templates=_FREQUENT)
    return found.select("doc_id", "score", "template", "description", "report")


@entry(
    "extract_fenced_sql",
    """SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'SELECT ' || conv_id || E'\\nFROM t'
         WHEN 1 THEN 'select ' || turn END AS extracted FROM conversations""",
)
def _(spark, sf_dir):
    wrapped = (
        F.when(F.col("turn") % 3 == 0, F.concat("text", F.lit("\n```SQL\n SELECT "), "conv_id", F.lit("\nFROM t \n```\n"), "text"))
        .when(F.col("turn") % 3 == 1, F.concat("text", F.lit("```\nselect "), "turn", F.lit("\n``` "), "text"))
        .otherwise(F.concat("text", F.lit("```python\nprint(1)\n```")))
    )
    answers = table(spark, sf_dir, "conversations").select("conv_id", "turn", wrapped.alias("answer"))
    return answers.select("conv_id", "turn", questions.fenced_sql(F.col("answer")).alias("extracted"))


@entry(
    "last_n_messages",
    """SELECT conv_id, turn, role, substr(text, 1, 500) AS content FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations)
       WHERE n <= 4 AND role IN ('user', 'assistant')""",
)
def _(spark, sf_dir):
    return questions.last_messages(table(spark, sf_dir, "conversations"))


# ---- scalar functions --------------------------------------------------------


@entry(
    "fn_round",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS one_digit,
       CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)), 0) AS DOUBLE) AS whole FROM lineitem""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round("l_extendedprice", 1).alias("one_digit"),
        F.round("l_extendedprice", 0).alias("whole"),
    )


@entry(
    "fn_format_number",
    "SELECT o_orderkey, format('{:,.0f}', o_totalprice * 1000) AS formatted FROM orders",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", scalars.thousands(F.col("o_totalprice") * 1000).alias("formatted"))


@entry(
    "fn_nullif_ratio",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 100.0 / NULLIF(l_tax, 0) AS pct FROM lineitem""",
)
def _(spark, sf_dir):
    pct = scalars.ratio(F.col("l_quantity") * F.lit(100.0), F.nullif(F.col("l_tax"), F.lit(0.0)))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", pct.alias("pct"))


@entry(
    "fn_case",
    """SELECT l_returnflag, SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS with_else,
       SUM(CASE WHEN l_linestatus = 'Z' THEN l_quantity END) AS without_else FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, sf_dir):
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.sum(F.when(F.col("l_linestatus") == "O", quantity).otherwise(0)).alias("with_else"),
        F.sum(F.when(F.col("l_linestatus") == "Z", quantity)).alias("without_else"),
    )


@entry(
    "fn_ci_like",
    """SELECT doc_id, lower(text) LIKE lower('%É%') AS accented, lower(text) LIKE lower('%T_e%') AS wildcard
       FROM documents""",
)
def _(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        scalars.contains_ignoring_case(text, "É").alias("accented"),
        scalars.contains_ignoring_case(text, "T_e").alias("wildcard"),
    )


@entry(
    "fn_scale",
    "SELECT o_orderkey, o_totalprice / 1e6 AS millions, o_totalprice / 1e9 AS billions FROM orders",
)
def _(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", scalars.scaled(price, 1e6).alias("millions"), scalars.scaled(price, 1e9).alias("billions")
    )


@entry("fn_ts_to_string", "SELECT event_id, CAST(ts AS VARCHAR) AS ts_text FROM events")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", scalars.timestamp_text(F.col("ts")).alias("ts_text"))
