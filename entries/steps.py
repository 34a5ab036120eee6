"""Row and column transforms, set operations, joins and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from comarca.functions import naming, scalars
from comarca.operators import combine, duplicates, missing, ordered, quality
from comarca.plans import etl, indicators, industry, population, steps
from comarca.sinks import warehouse
from comarca.sinks.bucketed import bucketed
from entries.tables import CATEGORY, table

QUERIES = {}
ORACLES = {}


def entry(key, sql=None):
    def add(query):
        QUERIES[key] = query
        if sql:
            ORACLES[key] = sql
        return query

    return add


# ---- names -------------------------------------------------------------------


@entry(
    "clean_names",
    """SELECT c_custkey AS codigo_cliente, c_name AS nombre_del_cliente, c_nationkey AS anotherkey,
       c_acctbal AS saldo_, c_mktsegment AS saldo__2 FROM customer""",
)
def _(spark, sf_dir):
    odd = ["  Código Cliente ", "Nombre del Cliente", "Another-Key", "Saldo (€)", "Saldo_"]
    return naming.clean_names(table(spark, sf_dir, "customer").toDF(*odd))


@entry(
    "rename_columns",
    "SELECT s_suppkey AS codigo_provincia, s_name AS nombre_provincia, s_nationkey, s_acctbal FROM supplier",
)
def _(spark, sf_dir):
    names = {"s_suppkey": "codigo_provincia", "s_name": "nombre_provincia", "absent": "ignored"}
    return table(spark, sf_dir, "supplier").withColumnsRenamed(names)


# ---- duplicates --------------------------------------------------------------


@entry("drop_duplicates", "SELECT DISTINCT text, lang FROM documents")
def _(spark, sf_dir):
    return duplicates.drop_duplicates(table(spark, sf_dir, "documents").select("text", "lang"))


@entry(
    "drop_duplicates_subset",
    """SELECT doc_id, text, lang, source, n_chars FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) WHERE n = 1""",
)
def _(spark, sf_dir):
    return duplicates.drop_duplicates(table(spark, sf_dir, "documents"), ["text"], ["doc_id"])


# ---- missing values ----------------------------------------------------------

_GAPS = """gaps AS (SELECT event_id, ts, user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
  CASE WHEN value >= 5 THEN value END AS value FROM events)"""


def _gaps(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
    )


@entry("na_drop", f"WITH {_GAPS} SELECT * FROM gaps WHERE event_type IS NOT NULL AND value IS NOT NULL")
def _(spark, sf_dir):
    return missing.handle_missing(_gaps(spark, sf_dir), "drop")


@entry("na_drop_subset", f"WITH {_GAPS} SELECT * FROM gaps WHERE value IS NOT NULL")
def _(spark, sf_dir):
    return missing.drop_missing(_gaps(spark, sf_dir), ["value"])


@entry(
    "na_fill_zero",
    f"""WITH {_GAPS} SELECT event_id, ts, user_id, COALESCE(event_type, '0') AS event_type,
        COALESCE(value, 0) AS value FROM gaps""",
)
def _(spark, sf_dir):
    return missing.handle_missing(_gaps(spark, sf_dir), "fill_zero")


@entry(
    "na_fill_mean",
    f"""WITH {_GAPS} SELECT event_id, event_type, ROUND(COALESCE(value, (SELECT AVG(value) FROM gaps)), 6) AS value
        FROM gaps""",
)
def _(spark, sf_dir):
    filled = missing.handle_missing(_gaps(spark, sf_dir).drop("user_id", "ts"), "fill_mean")
    return filled.select(F.col("event_id").cast("long").alias("event_id"), "event_type", F.round("value", 6).alias("value"))


def _fill_sql(partition):
    window = f"({partition} ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""WITH {_GAPS} SELECT event_id, ts, user_id,
        LAST_VALUE(event_type IGNORE NULLS) OVER {window} AS event_type,
        LAST_VALUE(value IGNORE NULLS) OVER {window} AS value FROM gaps"""


@entry("na_fill_forward", _fill_sql("PARTITION BY user_id"))
def _(spark, sf_dir):
    return missing.handle_missing(_gaps(spark, sf_dir), "fill_forward", ["ts", "event_id"], ["user_id"])


@entry("na_fill_forward_global", _fill_sql(""))
def _(spark, sf_dir):
    return ordered.forward_fill(_gaps(spark, sf_dir), ["event_type", "value"], ["ts", "event_id"])


@entry(
    "na_affected",
    f"""WITH {_GAPS}, counts AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (event_type IS NULL) AS t,
          COUNT(*) FILTER (value IS NULL) AS v, COUNT(*) FILTER (event_type IS NOT NULL AND value IS NOT NULL) AS whole
          FROM gaps)
        SELECT 'drop' AS strategy, n AS rows_before, whole AS rows_after, t + v AS missing_before,
          CAST(0 AS BIGINT) AS missing_after, n - whole AS affected FROM counts
        UNION ALL SELECT 'fill_zero', n, n, t + v, 0, 0 FROM counts
        UNION ALL SELECT 'fill_mean', n, n, t + v, t, t FROM counts""",
)
def _(spark, sf_dir):
    gaps = _gaps(spark, sf_dir)
    return combine.union_all(
        [missing.missing_report(gaps, missing.handle_missing(gaps, s), s) for s in ("drop", "fill_zero", "fill_mean")]
    )


# ---- derived columns ---------------------------------------------------------


@entry(
    "ratio",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / NULLIF(l_tax, 0) AS ratio_genero FROM lineitem""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").alias("poblacion_hombres"),
        F.col("l_tax").alias("poblacion_mujeres"),
    )
    return indicators.add_gender_ratio(rows).drop("poblacion_hombres", "poblacion_mujeres")


@entry(
    "bucketize",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_discount * 1000 AS porcentaje_despoblamiento,
        {CATEGORY.format(x="(l_discount * 1000)")} AS categoria_despoblamiento,
        {CATEGORY.format(x="l_quantity * 2.5")} AS wide FROM lineitem""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_discount") * 1000).alias("porcentaje_despoblamiento"),
        scalars.bucketize(F.col("l_quantity") * 2.5).alias("wide"),
    )
    return indicators.add_category(rows)


@entry("audit_columns", "SELECT *, '1.0.0' AS version_pipeline, true AS stamped FROM part")
def _(spark, sf_dir):
    audited = steps.add_audit_columns(table(spark, sf_dir, "part"))
    stamped = F.col("fecha_procesamiento").isNotNull()
    return audited.withColumn("stamped", stamped).drop("fecha_procesamiento")


@entry(
    "regex_extract_code",
    r"""SELECT c_custkey, NULLIF(regexp_extract(municipios, '^(\d+)', 1), '') AS codigo_municipio,
        NULLIF(regexp_extract(municipios, '\d+\s+(.+)$', 1), '') AS nombre_municipio
        FROM (SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ' ' || c_name
              ELSE c_name END AS municipios FROM customer)""",
)
def _(spark, sf_dir):
    code = F.lpad(F.col("c_custkey").cast("string"), 5, "0")
    text = F.when(F.col("c_nationkey") < 20, F.concat_ws(" ", code, "c_name")).otherwise(F.col("c_name"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", text.alias("municipios"))
    return population.add_municipality(rows).drop("municipios")


@entry(
    "to_numeric_coerce",
    """SELECT p_partkey, TRY_CAST(p_name AS INTEGER) AS from_name,
       TRY_CAST(CASE WHEN p_size > 10 THEN CAST(p_retailprice AS VARCHAR) ELSE '..' END AS DOUBLE) AS from_text
       FROM part""",
)
def _(spark, sf_dir):
    text = F.when(F.col("p_size") > 10, F.col("p_retailprice").cast("string")).otherwise(F.lit(".."))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        scalars.coerce_number(F.col("p_name"), "int").alias("from_name"),
        scalars.coerce_number(text).alias("from_text"),
    )


_BRAND_CODES = {f"Brand#{n}": n * 10 for n in range(1, 20)}


@entry(
    "lookup_codes",
    """SELECT p_partkey, p_brand AS provincia, CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) BETWEEN 1 AND 19
         THEN CAST(substr(p_brand, 7) AS INTEGER) * 10 END AS codigo_provincia_ine FROM part""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("provincia"))
    return combine.lookup_codes(rows, _BRAND_CODES)


# ---- whole transforms --------------------------------------------------------


def raw_indicators(spark, sf_dir):
    """Orders in the layout of the indicator file."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("cod_prov"),
        F.col("o_orderpriority").alias("nom_prov"),
        (F.floor(price) % 130).cast("double").alias("porcen_desp"),
        F.floor(price).alias("pob_tot"),
        F.floor(price / 2).alias("pob_hom"),
        (F.floor(price) % 7).alias("pob_muj"),
        F.lit("x").alias("Otro Índice"),
    )


_RAW_INDICATORS = """SELECT o_orderkey AS codigo_provincia, o_orderpriority AS nombre_provincia,
    CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 130 AS DOUBLE) AS porcentaje_despoblamiento,
    CAST(FLOOR(o_totalprice) AS BIGINT) AS poblacion_total, CAST(FLOOR(o_totalprice / 2) AS BIGINT) AS poblacion_hombres,
    CAST(FLOOR(o_totalprice) AS BIGINT) % 7 AS poblacion_mujeres, 'x' AS otro_indice FROM orders"""

TRANSFORMED_INDICATORS = f"""SELECT *, CAST(poblacion_hombres AS DOUBLE) / NULLIF(poblacion_mujeres, 0) AS ratio_genero,
    {CATEGORY.format(x="porcentaje_despoblamiento")} AS categoria_despoblamiento, '1.0.0' AS version_pipeline
    FROM ({_RAW_INDICATORS})"""


@entry("transform_indicators", TRANSFORMED_INDICATORS)
def _(spark, sf_dir):
    return indicators.transform(raw_indicators(spark, sf_dir)).drop("fecha_procesamiento")


def raw_population(spark, sf_dir):
    """Customers in the layout of the population files, with gaps in both numbers."""
    name = F.concat_ws(" ", F.lpad(F.col("c_custkey").cast("string"), 5, "0"), "c_name")
    total = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).when(
        F.col("c_acctbal") < -500, F.lit("..")
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("codigo_provincia"),
        F.col("c_mktsegment").alias("nombre_provincia"),
        name.alias("Municipios"),
        F.lit("Total").alias("Sexo"),
        F.when(F.col("c_nationkey") > 2, (F.col("c_nationkey") + 1996).cast("string"))
        .otherwise(F.lit("n/a"))
        .alias("Periodo"),
        total.alias("Total"),
    )


TRANSFORMED_POPULATION = """SELECT c_nationkey AS codigo_provincia, c_mktsegment AS nombre_provincia,
    lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ' ' || c_name AS municipios, 'Total' AS sexo,
    CASE WHEN c_nationkey > 2 THEN c_nationkey + 1996 END AS periodo, c_acctbal AS total,
    lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS codigo_municipio, c_name AS nombre_municipio,
    '1.0.0' AS version_pipeline FROM customer WHERE c_acctbal >= 0"""


@entry("transform_population", TRANSFORMED_POPULATION)
def _(spark, sf_dir):
    return population.transform(raw_population(spark, sf_dir)).drop("fecha_procesamiento")


def raw_industry(spark, sf_dir):
    """Parts in the layout of the industry workbooks."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("provincia"),
        F.col("p_partkey").alias("Municipio"),
        F.col("p_type").alias("AAEE Sección CNAE09"),
        F.col("p_retailprice").alias("PIB Municipios 2016"),
    )


TRANSFORMED_INDUSTRY = """SELECT p_brand AS provincia, p_partkey AS municipio, p_type AS aaee_seccion_cnae09,
    p_retailprice AS pib_municipios_2016, CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) BETWEEN 1 AND 19
      THEN CAST(substr(p_brand, 7) AS INTEGER) * 10 END AS codigo_provincia_ine, '1.0.0' AS version_pipeline
    FROM part"""


@entry("transform_industry", TRANSFORMED_INDUSTRY)
def _(spark, sf_dir):
    return industry.transform(raw_industry(spark, sf_dir), codes=_BRAND_CODES).drop("fecha_procesamiento")


def transforms():
    return {**etl.TRANSFORMS, "industria": lambda df, log: industry.transform(df, log, _BRAND_CODES)}


@entry(
    "transform_all",
    f"""WITH d AS ({TRANSFORMED_INDICATORS}), p AS ({TRANSFORMED_POPULATION}), i AS ({TRANSFORMED_INDUSTRY})
        SELECT 'despoblamiento' AS source, COUNT(*) AS "rows", COUNT(categoria_despoblamiento) AS filled FROM d
        UNION ALL SELECT 'poblacion', COUNT(*), COUNT(periodo) FROM p
        UNION ALL SELECT 'industria', COUNT(*), COUNT(codigo_provincia_ine) FROM i
        UNION ALL SELECT 'broken', COUNT(*), COUNT(s_name) FROM supplier
        UNION ALL SELECT 'other', COUNT(*), COUNT(r_name) FROM region""",
)
def _(spark, sf_dir):
    def fail(df, log):
        raise ValueError("this source cannot be transformed")

    data = {
        "despoblamiento": raw_indicators(spark, sf_dir),
        "poblacion": raw_population(spark, sf_dir),
        "industria": raw_industry(spark, sf_dir),
        "broken": table(spark, sf_dir, "supplier"),
        "other": table(spark, sf_dir, "region"),
    }
    done = etl.transform_all(data, {**transforms(), "broken": fail})
    watched = {
        "despoblamiento": "categoria_despoblamiento",
        "poblacion": "periodo",
        "industria": "codigo_provincia_ine",
        "broken": "s_name",
        "other": "r_name",
    }
    return combine.union_all(
        [
            done[name]
            .agg(F.count(F.lit(1)).alias("rows"), F.count(column).alias("filled"))
            .select(F.lit(name).alias("source"), "rows", "filled")
            for name, column in watched.items()
        ]
    )


@entry(
    "transform_log",
    """WITH d AS (SELECT COUNT(*) - COUNT(DISTINCT text) AS removed FROM documents),
       v AS (SELECT COUNT(*) AS short FROM (SELECT DISTINCT ON (text) n_chars FROM documents ORDER BY text, doc_id)
             WHERE n_chars < 50)
       SELECT 1 AS position, 'clean_column_names' AS operation,
         '0 of 5 names changed: doc_id, text, lang, source, n_chars' AS details
       UNION ALL SELECT 2, 'remove_duplicates', 'rows dropped: ' || removed FROM d
       UNION ALL SELECT 3, 'handle_missing', 'drop: rows touched: ' || short FROM v""",
)
def _(spark, sf_dir):
    log = steps.StepLog()
    docs = steps.clean_names(table(spark, sf_dir, "documents"), log)
    unique = steps.remove_duplicates(docs, ["text"], ["doc_id"], log)
    known = unique.withColumn("n_chars", F.when(F.col("n_chars") >= 50, F.col("n_chars")))
    steps.handle_missing(known, "drop", log=log)
    return log.frame(spark).drop("timestamp")


# ---- set operations and joins ------------------------------------------------


@entry("union_all", "SELECT s_name AS name, s_acctbal AS balance FROM supplier UNION ALL SELECT c_name, c_acctbal FROM customer")
def _(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, sf_dir, "customer").select("c_name", "c_acctbal")
    return combine.union_all([suppliers, customers])


@entry(
    "union_by_name",
    """SELECT s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
       UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer""",
)
def _(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    return combine.union_by_name([suppliers, customers])


def _municipalities(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("codigo_provincia"),
        F.concat(F.lit("Provincia "), "l_suppkey").alias("nombre_provincia"),
        F.lpad(F.col("l_partkey").cast("string"), 7, "0").alias("codigo_municipio"),
        F.concat(F.lit("Municipio "), "l_partkey").alias("nombre_municipio"),
        F.col("l_quantity").alias("total"),
    )


_DIM = """dim AS (SELECT CAST(codigo_municipio AS INTEGER) AS id_municipio, * FROM (
    SELECT lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS codigo_municipio,
      MIN('Municipio ' || l_partkey) AS nombre_municipio, CAST(MIN(l_suppkey) AS INTEGER) AS codigo_provincia
    FROM lineitem GROUP BY 1))"""


@entry("dim_build", f"WITH {_DIM} SELECT * FROM dim")
def _(spark, sf_dir):
    return combine.municipality_dimension(_municipalities(spark, sf_dir)).drop("created_at")


@entry(
    "dim_provincia",
    """SELECT CAST(l_suppkey AS INTEGER) AS codigo_provincia, MIN('Provincia ' || l_suppkey) AS nombre_provincia
       FROM lineitem GROUP BY l_suppkey""",
)
def _(spark, sf_dir):
    return combine.province_dimension(_municipalities(spark, sf_dir)).drop("created_at")


@entry(
    "fact_dim_join",
    f"""WITH {_DIM} SELECT lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS codigo_municipio, l_quantity AS total,
        id_municipio, nombre_municipio FROM lineitem
        JOIN dim ON dim.codigo_municipio = lpad(CAST(l_partkey AS VARCHAR), 7, '0')""",
)
def _(spark, sf_dir):
    rows = _municipalities(spark, sf_dir)
    dim = combine.municipality_dimension(rows)
    facts = rows.select("codigo_municipio", "total")
    return combine.attach_dimension(facts, dim, "codigo_municipio", ["id_municipio", "nombre_municipio"])


@entry(
    "fact_dim_bucketed",
    f"""WITH {_DIM} SELECT lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS codigo_municipio, l_quantity AS total,
        id_municipio, nombre_municipio FROM lineitem
        LEFT JOIN dim ON dim.codigo_municipio = lpad(CAST(l_partkey AS VARCHAR), 7, '0')""",
)
def _(spark, sf_dir):
    """Facts and dimension in buckets of the code, so that their join moves no row."""
    rows = _municipalities(spark, sf_dir)
    facts = bucketed(rows.select("codigo_municipio", "total"), "codigo_municipio", 8)
    dim = combine.municipality_dimension(rows).select("codigo_municipio", "id_municipio", "nombre_municipio")
    return combine.join_bucketed(facts, bucketed(dim, "codigo_municipio", 8), "codigo_municipio")


# ---- quality -----------------------------------------------------------------

_GAP_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
_COMPLETE = f"""WITH {_GAPS}, counts AS (SELECT COUNT(*) AS n,
    COUNT(*) FILTER (event_type IS NOT NULL AND value IS NOT NULL) AS whole FROM gaps)
  """


def _completeness_sql(select):
    parts = [
        select.format(c=c, pct=f"(SELECT COUNT(*) FILTER ({c} IS NULL) FROM gaps) * 100.0 / n") for c in _GAP_COLUMNS
    ]
    return " UNION ALL ".join(parts)


@entry(
    "dq_completeness",
    _COMPLETE
    + _completeness_sql(
        """SELECT 'events' AS dataset, n AS total_rows, 5 AS total_columns, whole AS complete_rows, '{c}' AS "column",
           CAST({pct} AS DOUBLE) AS missing_percentage FROM counts"""
    ),
)
def _(spark, sf_dir):
    return quality.completeness(_gaps(spark, sf_dir), "events")


@entry(
    "dq_uniqueness",
    """SELECT 'documents' AS dataset, 'text' AS key_columns, COUNT(*) - COUNT(DISTINCT text) AS total_duplicates,
       (COUNT(*) - COUNT(DISTINCT text)) * 100.0 / COUNT(*) AS duplicate_percentage FROM documents""",
)
def _(spark, sf_dir):
    return quality.uniqueness(table(spark, sf_dir, "documents"), "documents", ["text"])


@entry(
    "dq_report",
    _COMPLETE
    + _completeness_sql(
        """SELECT 'events_completeness' AS "check", 'missing_percentage' AS measure, '{c}' AS subject,
           CAST({pct} AS DOUBLE) AS value FROM counts"""
    )
    + """ UNION ALL SELECT 'events_completeness', 'total_rows', 'events', CAST(n AS DOUBLE) FROM counts
      UNION ALL SELECT 'events_completeness', 'total_columns', 'events', 5 FROM counts
      UNION ALL SELECT 'events_completeness', 'complete_rows', 'events', whole FROM counts
      UNION ALL SELECT 'events_uniqueness', 'total_duplicates', 'user_id, event_type',
        (SELECT COUNT(*) FROM gaps) - (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, event_type FROM gaps))
      UNION ALL SELECT 'events_uniqueness', 'duplicate_percentage', 'user_id, event_type',
        ((SELECT COUNT(*) FROM gaps) - (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, event_type FROM gaps)))
          * 100.0 / (SELECT COUNT(*) FROM gaps)""",
)
def _(spark, sf_dir):
    return quality.quality_report({"events": _gaps(spark, sf_dir)}, {"events": ["user_id", "event_type"]})


@entry(
    "clean_cells",
    """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, CASE WHEN value >= 5 THEN value END AS value
       FROM events""",
)
def _(spark, sf_dir):
    not_a_number = F.when(F.col("value") >= 5, F.col("value")).otherwise(F.lit(float("nan")))
    return warehouse.clean_cells(table(spark, sf_dir, "events").drop("props").withColumn("value", not_a_number))
