"""Sources, sinks, the catalog and whole runs."""

from __future__ import annotations

import math
import time
import uuid
from functools import partial

from pyspark.sql import functions as F

from comarca.operators import combine
from comarca.plans import population, industry
from comarca.plans.etl import Run
from comarca.session import scratch_path
from comarca.sinks import documents, files, registry, tables, warehouse
from comarca.sources import catalog, delimited, staged, workbook
from comarca.sources import registry as sources
from comarca.streaming import batched
from entries import steps
from entries.tables import NAMES, SEXES, decimals_as_double, register, table
from entries.tables import industry as industry_rows
from entries.tables import population as population_rows
from entries.workbooks import write_workbooks

QUERIES = {}
ORACLES = {}


def entry(key, sql=None):
    def add(query):
        QUERIES[key] = query
        if sql:
            ORACLES[key] = sql
        return query

    return add


def _csv(df, path, mode="errorifexists"):
    df.write.mode(mode).options(sep=";", header=True).csv(path)
    return path


_CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
_ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"

# Text of a file, as much as Spark reads in one task of a file it can split.
_FILE_BYTES = 128 << 20


def _spread(df, least):
    """At least so many parts, and more where a part would have more text than a file should."""
    size = df.agg(F.sum(F.octet_length(F.concat_ws(";", *df.columns)))).first()[0] or 0
    return df.repartition(max(least, math.ceil(size / _FILE_BYTES)))


# ---- sources -----------------------------------------------------------------


@entry("scan_csv", "SELECT * FROM customer")
def _(spark, sf_dir):
    path = _csv(table(spark, sf_dir, "customer"), scratch_path(spark, "csv"))
    return delimited.read_file(spark, path, _CUSTOMER).drop("source_file")


@entry(
    "scan_csv_dir",
    """SELECT p_partkey, p_size, CASE WHEN p_size <= 25 THEN p_name END AS p_name,
       CASE WHEN p_size > 25 THEN p_brand END AS p_brand FROM part""",
)
def _(spark, sf_dir):
    part, folder = table(spark, sf_dir, "part"), scratch_path(spark, "csv")
    _csv(part.where("p_size <= 25").select("p_partkey", "p_name", "p_size"), folder)
    _csv(part.where("p_size > 25").select("p_size", "p_brand", "p_partkey"), folder, "append")
    schema = "p_partkey long, p_size int, p_name string, p_brand string"
    return delimited.read_folder(spark, folder, schema).drop("source_file")


@entry("scan_csv_batched", "SELECT * FROM orders")
def _(spark, sf_dir):
    folder, out = scratch_path(spark, "csv"), scratch_path(spark, "batched")
    _csv(_spread(table(spark, sf_dir, "orders"), 8), folder)
    stream = batched.stream_folder(spark, folder, _ORDERS, files_per_batch=3)
    batched.drain_to_parquet(stream, out, scratch_path(spark, "offsets"))
    return spark.read.schema(stream.schema).parquet(out).drop("source_file")


@entry(
    "scan_csv_rejected",
    """SELECT "column", COUNT(*) AS cells, COUNT(DISTINCT text) AS texts, MIN(text) AS least, MAX(text) AS most FROM (
         SELECT 'o_totalprice' AS "column", CAST(o_totalprice AS VARCHAR) AS text FROM orders WHERE o_totalprice > 200000
         UNION ALL SELECT 'o_orderdate', strftime(o_orderdate, '%d/%m/%Y') FROM orders WHERE o_orderstatus = 'F'
         UNION ALL SELECT 'o_custkey', 'C' || o_custkey FROM orders WHERE o_orderpriority LIKE '1%') GROUP BY 1""",
)
def _(spark, sf_dir):
    """Prices with a fraction, days in another order and keys with a letter among cells that parse."""
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority").like("1%"), F.concat(F.lit("C"), "o_custkey")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice").cast("string")).otherwise(F.col("o_totalprice").cast("long").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
    )
    schema = "o_orderkey long, o_custkey long, o_totalprice long, o_orderdate date"
    rows = delimited.read_file(spark, _csv(text, scratch_path(spark, "csv")), schema, rejected="lost")
    return delimited.rejected_cells(rows, "lost").groupBy("column").agg(
        F.count(F.lit(1)).alias("cells"), F.countDistinct("text").alias("texts"), F.min("text").alias("least"), F.max("text").alias("most")
    )


_QUOTED = "doc_id long, source string, n_chars int, text string"
_QUOTED_ROWS = """SELECT doc_id, source, {n_chars} AS n_chars,
  '"' || doc_id || '";' || chr(10) || coalesce(text, '') || ' "" ;' AS text FROM documents"""


def _quoted(spark, sf_dir):
    """Whole documents between quotes, separators and line breaks."""
    text = F.concat(F.lit('"'), "doc_id", F.lit('";\n'), F.coalesce("text", F.lit("")), F.lit(' "" ;'))
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.col("n_chars").cast("int").alias("n_chars"), text.alias("text"))


def _quoted_csv(df, path, mode="errorifexists"):
    df.write.mode(mode).options(**files.CSV_OPTIONS, sep=";").csv(path)
    return path


@entry("scan_csv_quoted", _QUOTED_ROWS.format(n_chars="CAST(n_chars AS INTEGER)"))
def _(spark, sf_dir):
    path = _quoted_csv(_quoted(spark, sf_dir).select("text", "n_chars", "doc_id", "source"), scratch_path(spark, "csv"))
    return delimited.read_file(spark, path, _QUOTED, multi_line=True).drop("source_file")


def _two_layouts(spark, sf_dir):
    """Documents in files of two layouts, of other columns and another order each, by their length.

    Such a file is read by one task, so their number grows with the text.
    """
    docs, folder = _spread(_quoted(spark, sf_dir), 4), scratch_path(spark, "csv")
    _quoted_csv(docs.where("n_chars > 800").select("text", "n_chars", "doc_id", "source"), folder)
    return _quoted_csv(docs.where("n_chars <= 800 OR n_chars IS NULL").select("source", "doc_id", "text"), folder, "append")


_LONG_ONLY = "CASE WHEN n_chars > 800 THEN CAST(n_chars AS INTEGER) END"


@entry("scan_csv_dir_quoted", _QUOTED_ROWS.format(n_chars=_LONG_ONLY))
def _(spark, sf_dir):
    folder = _two_layouts(spark, sf_dir)
    return delimited.read_folder(spark, folder, _QUOTED, multi_line=True).drop("source_file")


@entry("scan_csv_batched_quoted", _QUOTED_ROWS.format(n_chars=_LONG_ONLY))
def _(spark, sf_dir):
    folder, out = _two_layouts(spark, sf_dir), scratch_path(spark, "batched")
    rows = batched.drain_by_name(
        spark, folder, _QUOTED, out, scratch_path(spark, "offsets"), files_per_batch=3, multi_line=True
    )
    return rows.drop("source_file")


@entry("export_csv_quoted", _QUOTED_ROWS.format(n_chars="CAST(n_chars AS INTEGER)"))
def _(spark, sf_dir):
    docs = _quoted(spark, sf_dir)
    path = files.export_csv(docs, scratch_path(spark, "query"))
    return spark.read.schema(docs.schema).options(**delimited.csv_options(",", multi_line=True)).csv(path)


@entry("with_source_file", "SELECT s_suppkey, true AS from_part_file FROM supplier")
def _(spark, sf_dir):
    folder = _csv(table(spark, sf_dir, "supplier"), scratch_path(spark, "csv"))
    schema = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    rows = delimited.read_folder(spark, folder, schema, same_headers=True, skip_bad_files=False)
    return rows.select("s_suppkey", F.col("source_file").rlike(r"^part-.*\.csv$").alias("from_part_file"))


@entry(
    "filename_columns",
    """SELECT p_partkey, p_brand || ' 2019' || p_type || ' 2019.xlsx' AS source_file, p_brand || p_type AS provincia,
       2019 AS anio FROM part""",
)
def _(spark, sf_dir):
    name = F.concat("p_brand", F.lit(" 2019"), "p_type", F.lit(" 2019.xlsx"))
    return workbook.with_file_columns(table(spark, sf_dir, "part").select("p_partkey", name.alias("source_file")))


def _part_workbooks(spark, sf_dir):
    folder = scratch_path(spark, "xlsx")
    write_workbooks(steps.raw_industry(spark, sf_dir), folder, "provincia")
    return folder


_WORKBOOK = "`Municipio` long, `AAEE Sección CNAE09` string, `PIB Municipios 2016` double"


_WORKBOOK_NAMES = {"Municipio": "municipio", "AAEE Sección CNAE09": "sector", "PIB Municipios 2016": "pib"}
_WORKBOOK_ROWS = """SELECT p_brand AS provincia, 2019 AS anio, p_brand || ' 2019.xlsx' AS source_file,
  p_partkey AS municipio, p_type AS sector, p_retailprice AS pib FROM part"""


@entry("scan_xlsx_dir", _WORKBOOK_ROWS)
def _(spark, sf_dir):
    rows = workbook.read_folder(spark, _part_workbooks(spark, sf_dir), _WORKBOOK, recursive=True)
    return rows.withColumnsRenamed(_WORKBOOK_NAMES)


@entry("scan_xlsx_dir_inferred", _WORKBOOK_ROWS)
def _(spark, sf_dir):
    rows = workbook.read_folder(spark, _part_workbooks(spark, sf_dir), recursive=True)
    return rows.withColumnsRenamed(_WORKBOOK_NAMES)


@entry("list_provinces", "SELECT DISTINCT p_brand AS provincia FROM part")
def _(spark, sf_dir):
    # Large provinces are written as several workbooks of one name.
    return workbook.list_provinces(spark, _part_workbooks(spark, sf_dir), recursive=True).distinct()


_SOURCE_COUNTS = """SELECT 'clientes' AS source, COUNT(*) > 0 AS non_empty, COUNT(*) AS total_rows, 6 AS total_columns
    FROM customer"""


@entry("validate_non_empty", " UNION ALL ".join(
    f"SELECT '{n}' AS source, COUNT(*) > 0 AS non_empty, COUNT(*) AS total_rows, {k} AS total_columns FROM {n}"
    for n, k in (("orders", 6), ("part", 6), ("events", 6))
) + " UNION ALL SELECT 'none', false, COUNT(*), 6 FROM orders WHERE o_totalprice < 0")
def _(spark, sf_dir):
    data = {name: table(spark, sf_dir, name) for name in ("orders", "part", "events")}
    return sources.validation_report({**data, "none": data["orders"].where("o_totalprice < 0")})


@entry("extract_all", _SOURCE_COUNTS + " UNION ALL SELECT 'ausente', false, 0, 6 UNION ALL SELECT 'rota', false, 0, 1")
def _(spark, sf_dir):
    path = _csv(table(spark, sf_dir, "customer"), scratch_path(spark, "csv"))

    def broken(spark):
        raise OSError("this source cannot be opened")

    readers = {
        "clientes": partial(delimited.read_file, path=path, schema=_CUSTOMER),
        "ausente": partial(delimited.read_file, path=f"{path}/absent.csv", schema=_CUSTOMER),
        "rota": broken,
    }
    return sources.validation_report(sources.extract_all(spark, readers))


@entry("scan_parquet", "SELECT * FROM lineitem")
def _(spark, sf_dir):
    return staged.read_parquet(spark, f"{sf_dir}/lineitem.parquet")


@entry("scan_table", "SELECT * FROM orders")
def _(spark, sf_dir):
    register(spark, sf_dir, ["orders"])
    return staged.read_table(spark, "orders")


# ---- sinks -------------------------------------------------------------------


def _new_name(label):
    return f"{label}_{uuid.uuid4().hex}"


@entry("load_replace", "SELECT * FROM orders")
def _(spark, sf_dir):
    name, path = _new_name("replaced"), scratch_path(spark, "table")
    tables.replace_table(table(spark, sf_dir, "customer"), name, path)
    tables.replace_table(table(spark, sf_dir, "orders"), name, path)
    return spark.table(name)


@entry("load_append", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def _(spark, sf_dir):
    name, supplier = _new_name("appended"), table(spark, sf_dir, "supplier")
    tables.replace_table(supplier, name, scratch_path(spark, "table"))
    tables.append_table(supplier.select(*reversed(supplier.columns)), name)
    tables.append_table(supplier, name, by_position=True)
    return spark.table(name)


@entry(
    "load_verify",
    """SELECT 'orders' AS "table", COUNT(*) AS rows_loaded, true AS success FROM orders
       UNION ALL SELECT 'part', COUNT(*), true FROM part UNION ALL SELECT 'failing', 0, false""",
)
def _(spark, sf_dir):
    load = registry.table_loader(folder=scratch_path(spark, "tables"), prefix=_new_name("v") + "_")
    record = registry.LoadLog()
    done = {name: registry.load_one(table(spark, sf_dir, name), name, load, record) for name in ("orders", "part")}

    def failing(df, name):
        raise OSError("no room")

    done["failing"] = registry.load_one(table(spark, sf_dir, "part"), "failing", failing, record)
    success = F.create_map(*[F.lit(x) for pair in done.items() for x in pair])
    return record.frame(spark).select("table", "rows_loaded", success[F.col("table")].alias("success"))


@entry(
    "load_log",
    """SELECT 'orders' AS "table", COUNT(*) AS rows_loaded, 'SUCCESS' AS status FROM orders
       UNION ALL SELECT 'bad', 0, 'FAILED: unsupported format: avro'""",
)
def _(spark, sf_dir):
    record, base = registry.LoadLog(), scratch_path(spark, "files")
    orders = table(spark, sf_dir, "orders")
    registry.load_one(orders, "orders", registry.file_loader(base), record)
    registry.load_one(orders, "bad", registry.file_loader(base, "avro"), record)
    # Without the clock and the path, which differ from run to run.
    status = F.regexp_replace("status", " - .*", "")
    return record.frame(spark).select("table", "rows_loaded", status.alias("status"))


@entry(
    "warehouse_prepare",
    """SELECT event_id AS "EVENT_ID", CAST(ts AS VARCHAR) AS "TS", user_id AS "USER_ID", event_type AS "EVENT_TYPE",
       CASE WHEN value >= 5 THEN value END AS "VALUE_IN_EUR", props AS "PROPS" FROM events""",
)
def _(spark, sf_dir):
    not_a_number = F.when(F.col("value") >= 5, F.col("value")).otherwise(F.lit(float("nan")))
    events = table(spark, sf_dir, "events").withColumn("value", not_a_number)
    return warehouse.prepare(events.withColumnRenamed("value", "value.in eur"))


@entry(
    "infer_ddl",
    """SELECT 'EVENT_ID' AS column_name, 'INTEGER' AS sql_type, COUNT(event_id) AS filled_cells FROM events
       UNION ALL SELECT 'TS', 'VARCHAR(16777216)', COUNT(ts) FROM events
       UNION ALL SELECT 'USER_ID', 'INTEGER', COUNT(user_id) FROM events
       UNION ALL SELECT 'EVENT_TYPE', 'VARCHAR(16777216)', COUNT(event_type) FROM events
       UNION ALL SELECT 'VALUE', 'FLOAT', COUNT(value) FILTER (value >= 5) FROM events
       UNION ALL SELECT 'PROPS', 'VARCHAR(16777216)', COUNT(props) FROM events
       UNION ALL SELECT 'LARGE', 'BOOLEAN', COUNT(value) FROM events""",
)
def _(spark, sf_dir):
    value = F.col("value")
    events = table(spark, sf_dir, "events").withColumn("large", value > 100)
    return warehouse.load_plan(events.withColumn("value", F.when(value >= 5, value)))


def _exported(key, kind, read):
    @entry(key, "SELECT p_partkey, p_name, CASE WHEN p_size > 10 THEN p_size END AS p_size, p_retailprice FROM part")
    def _(spark, sf_dir):
        size = F.when(F.col("p_size") > 10, F.col("p_size"))
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", size.alias("p_size"), "p_retailprice")
        return read(spark, files.export_object(part, scratch_path(spark, "objects"), "part", kind), part.schema)


_exported("export_jsonl", "jsonl", lambda spark, path, schema: spark.read.schema(schema).json(path))
_exported("export_parquet", "parquet", lambda spark, path, schema: spark.read.parquet(path))
_exported("export_csv", "csv", lambda spark, path, schema: spark.read.schema(schema).csv(path, header=True))


@entry(
    "export_file",
    """SELECT kind, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
       CROSS JOIN (SELECT UNNEST(['parquet', 'csv', 'json']) AS kind)""",
)
def _(spark, sf_dir):
    supplier, base = table(spark, sf_dir, "supplier"), scratch_path(spark, "files")
    parts = []
    for kind in ("parquet", "csv", "json"):
        path = files.export_file(supplier, base, "supplier", kind)
        reader = spark.read.schema(supplier.schema).options(header=True)
        parts.append(reader.format(kind).load(path).withColumn("kind", F.lit(kind)))
    return combine.union_all(parts)


@entry(
    "to_documents",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name_in_struct, c_acctbal AS balance_in_struct,
       CAST(to_json({c_custkey: c_custkey, c_name: c_name, c_nationkey: CASE WHEN c_nationkey > 5 THEN c_nationkey END,
         c_acctbal: c_acctbal, c_mktsegment: c_mktsegment}) AS VARCHAR) AS json_data FROM customer""",
)
def _(spark, sf_dir):
    key = F.col("c_nationkey")
    customers = table(spark, sf_dir, "customer").withColumn("c_nationkey", F.when(key > 5, key))
    return documents.to_documents(customers, "c_custkey").select(
        "id",
        F.col("structData.c_name").alias("name_in_struct"),
        F.col("structData.c_acctbal").alias("balance_in_struct"),
        F.col("jsonData").alias("json_data"),
    )


@entry(
    "to_documents_by_position",
    """SELECT CAST(ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS VARCHAR) AS id, o_orderkey FROM orders""",
)
def _(spark, sf_dir):
    found = documents.to_documents(table(spark, sf_dir, "orders"), "no_such_column", ["o_orderdate", "o_orderkey"])
    return found.select("id", "structData.o_orderkey")


@entry(
    "load_all",
    """SELECT 'fact_partes' AS "table", COUNT(*) AS rows_loaded, true AS success FROM part
       UNION ALL SELECT 'fact_pedidos', COUNT(*), true FROM orders UNION ALL SELECT 'fact_vacia', 0, false""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    data = {"partes": table(spark, sf_dir, "part"), "pedidos": orders, "vacia": orders.where("o_totalprice < 0")}
    record = registry.LoadLog()
    loaders = {"object_store": registry.object_loader(scratch_path(spark, "objects"))}
    done = registry.load_all(data, "object_store", loaders, record)
    results = spark.createDataFrame([(f"fact_{name}", ok) for name, ok in done.items()], "table string, success boolean")
    loaded = record.frame(spark).select("table", "rows_loaded")
    return results.join(F.broadcast(loaded), "table", "left").na.fill(0, ["rows_loaded"])


@entry("stage_parquet", "SELECT * FROM events")
def _(spark, sf_dir):
    return files.stage_parquet(table(spark, sf_dir, "events"), scratch_path(spark, "staged"))


@entry("export_query_csv", "SELECT l_returnflag, SUM(l_quantity) AS quantity FROM lineitem GROUP BY l_returnflag")
def _(spark, sf_dir):
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.sum("l_quantity").alias("quantity"))
    path = files.export_csv(grouped, scratch_path(spark, "query"))
    return spark.read.schema(grouped.schema).csv(path, header=True)


@entry(
    "export_summaries",
    f"""SELECT 'Evolucion_Poblacion' AS summary, CAST(CAST(year(l_shipdate) AS INTEGER) AS VARCHAR) AS label,
          SUM(l_quantity) AS value FROM lineitem WHERE l_returnflag = 'N' AND year(l_shipdate) >= 1998 GROUP BY 2
        UNION ALL (SELECT 'Top_Provincias', CAST(l_suppkey AS VARCHAR), SUM(l_quantity) AS v FROM lineitem
          WHERE l_returnflag = 'N' AND year(l_shipdate) = 2000 GROUP BY l_suppkey ORDER BY v DESC, l_suppkey LIMIT 15)
        UNION ALL SELECT 'Industria_Provincia', p_brand, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE)
          FROM part GROUP BY p_brand
        UNION ALL SELECT 'Top_Sectores', p_type, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE)
          FROM part GROUP BY p_type""",
)
def _(spark, sf_dir):
    people, firms = population_rows(spark, sf_dir), industry_rows(spark, sf_dir)
    summaries = {
        "Evolucion_Poblacion": population.evolution(people, since=1998, sexes=SEXES),
        "Top_Provincias": population.population_by_province(people, 2000, 15, SEXES),
        "Industria_Provincia": industry.industry_gdp_detail(firms),
        "Top_Sectores": industry.sectors_gva_known(firms),
    }
    summaries = {name: decimals_as_double(df) for name, df in summaries.items()}
    paths = files.export_summaries(summaries, scratch_path(spark, "summaries"))
    parts = []
    for name, df in summaries.items():
        label, value = df.columns[:2]
        rows = spark.read.schema(df.schema).csv(paths[name], header=True)
        parts.append(
            rows.select(F.lit(name).alias("summary"), F.col(label).cast("string").alias("label"), F.col(value).alias("value"))
        )
    return combine.union_all(parts)


# ---- catalog -----------------------------------------------------------------

_TYPES = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
  WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END"""


def _info_sql(name):
    return f"""SELECT '{name}' AS table_name, (SELECT COUNT(*) FROM {name}) AS row_count,
        CAST(ROW_NUMBER() OVER () AS INTEGER) AS position, column_name, {_TYPES} AS column_type,
        CAST(NULL AS VARCHAR) AS error FROM (DESCRIBE {name})"""


@entry("list_tables", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS readable_rows FROM {n}" for n in NAMES))
def _(spark, sf_dir):
    wanted = set(register(spark, sf_dir))
    return catalog.list_tables(spark, [name for name in catalog.table_names(spark) if name in wanted])


@entry("table_info", _info_sql("lineitem"))
def _(spark, sf_dir):
    register(spark, sf_dir, ["lineitem"])
    return catalog.table_info(spark, "lineitem")


@entry(
    "dq_tables",
    " UNION ALL ".join(_info_sql(n) for n in ("lineitem", "orders", "part"))
    + " UNION ALL SELECT 'no_such_table', NULL, NULL, NULL, NULL, 'missing' FROM region WHERE r_regionkey = 0",
)
def _(spark, sf_dir):
    register(spark, sf_dir, ["lineitem", "orders", "part"])
    info = catalog.tables_info(spark, ["lineitem", "orders", "part", "no_such_table"])
    return info.withColumn("error", F.when(F.col("error").isNotNull(), F.lit("missing")))


def _columns_sql(name):
    return f"""(SELECT string_agg(column_name || ' (' || {_TYPES} || ')', ', ') FROM (DESCRIBE {name}))"""


@entry(
    "profile_tables",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, {_columns_sql(n)} AS columns, COUNT(*) AS row_count,
            CAST(LEAST(COUNT(*), 3) AS INTEGER) AS sampled FROM {n}"""
        for n in NAMES
    ),
)
def _(spark, sf_dir):
    profile = catalog.profile_tables(spark, register(spark, sf_dir))
    return profile.select("table_name", "columns", "row_count", F.size("sample").alias("sampled"))


@entry(
    "schema_text",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, E'Table: {n}\\n  Columns: ' || {_columns_sql(n)} || E'\\n  Rows: ' || COUNT(*)
            AS schema_text FROM {n}"""
        for n in NAMES
    ),
)
def _(spark, sf_dir):
    return catalog.schema_text(spark, register(spark, sf_dir))


# ---- whole runs --------------------------------------------------------------


def _run(spark, sf_dir, targets, staging=None):
    """A run over the given tables, written out first in the three published layouts."""
    root = scratch_path(spark, "raw")
    indicators = _csv(steps.raw_indicators(spark, sf_dir), f"{root}/indicators.csv")
    people = _csv(steps.raw_population(spark, sf_dir), f"{root}/people")
    write_workbooks(steps.raw_industry(spark, sf_dir), f"{root}/firms", "provincia")
    layout = "cod_prov long, nom_prov string, porcen_desp double, pob_tot long, pob_hom long, pob_muj long, `Otro Índice` string"
    readers = {
        "despoblamiento": partial(delimited.read_file, path=indicators, schema=layout),
        "poblacion": partial(
            delimited.read_folder,
            folder=people,
            schema=steps.raw_population(spark, sf_dir).schema,
        ),
        "industria": partial(workbook.read_folder, folder=f"{root}/firms", schema=_WORKBOOK, recursive=True),
    }
    loaders = {
        "table": registry.table_loader(folder=f"{root}/tables", prefix=_new_name("run") + "_"),
        "file": registry.file_loader(f"{root}/files"),
        "object_store": registry.object_loader(f"{root}/objects"),
    }
    return Run(spark, readers, loaders, targets, steps.transforms(), staging=staging)


_ROWS = f"""WITH d AS (SELECT COUNT(*) AS n FROM orders), i AS (SELECT COUNT(*) AS n FROM part),
  p AS (SELECT COUNT(*) AS n FROM customer), t AS (SELECT COUNT(*) AS n FROM ({steps.TRANSFORMED_POPULATION})),
  extracted AS (SELECT 'extract' AS phase, 'despoblamiento' AS source, NULL AS target, n AS "rows" FROM d
    UNION ALL SELECT 'extract', 'poblacion', NULL, n FROM p UNION ALL SELECT 'extract', 'industria', NULL, n FROM i),
  finished AS (SELECT 'despoblamiento' AS source, n FROM d UNION ALL SELECT 'poblacion', n FROM t
    UNION ALL SELECT 'industria', n FROM i),
  metrics AS (SELECT * FROM extracted UNION ALL SELECT 'transform', source, NULL, n FROM finished
    UNION ALL SELECT 'load', source, UNNEST(['table', 'file']), n FROM finished)"""


@entry("etl_metrics", f"{_ROWS} SELECT *, true AS success, true AS timed FROM metrics")
def _(spark, sf_dir):
    """``timed``: every step took some time, and no longer than the run."""
    run, start = _run(spark, sf_dir, ["table", "file"]), time.monotonic()
    run.run()
    seconds = F.col("seconds")
    return run.metrics().withColumn("timed", (seconds > 0) & (seconds <= time.monotonic() - start)).drop("seconds")


@entry("etl_phase", f"{_ROWS} SELECT phase, source, \"rows\" FROM metrics WHERE phase <> 'load' OR target = 'file'")
def _(spark, sf_dir):
    run = _run(spark, sf_dir, ["table"])
    run.transform(run.extract())
    # The last phase alone, over what the others left.
    later = _run(spark, sf_dir, ["file"], run.staging)
    if not later.load_staged():
        raise RuntimeError(f"load failed: {later.errors}")
    return run.metrics().union(later.metrics()).select("phase", "source", "rows")


@entry("etl_targets", f"{_ROWS} SELECT 'object_store' AS target, source, n AS \"rows\" FROM finished")
def _(spark, sf_dir):
    run = _run(spark, sf_dir, ["object_store"])
    run.run()
    return run.metrics().where("phase = 'load'").select("target", "source", "rows")


@entry("etl_run", steps.TRANSFORMED_POPULATION)
def _(spark, sf_dir):
    run = _run(spark, sf_dir, ["table"])
    if not run.run():
        raise RuntimeError(f"run failed: {run.errors}")
    loaded = next(status.split(" - ")[1] for _, name, _, status in run.loads.entries if name == "fact_poblacion")
    return spark.table(loaded).drop("fecha_procesamiento", "source_file")
