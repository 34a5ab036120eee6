import pytest
from pyspark.errors import AnalysisException

from comarca.plans import adhoc, cross, indicators, industry, population, ranking, steps
from comarca.operators.combine import lookup_codes
from tests.conftest import as_rows, as_set


@pytest.fixture
def provinces(spark):
    rows = [
        (1, "Araba", 10, 1000, 500, 500, 10.0, 50.0, 5.0, 100),
        (9, "Burgos", 40, 2000, 1000, 0, 20.0, 55.0, 10.0, 300),
        (9, "Burgos", 60, 3000, 1500, 1500, 30.0, None, 30.0, 500),
        (50, "Zaragoza", 90, 4000, 2000, 1000, None, 65.0, 40.0, 700),
        (51, "Ceuta", 0, 80, 40, 40, 50.0, 45.0, 50.0, 1),
    ]
    names = "cod_prov int, nom_prov string, porcen_desp long, pob_tot long, pob_hom long, pob_muj long, "
    raw = spark.createDataFrame(
        rows, names + "asexos_tparo double, asexos_templeo double, asexos_tactividad double, `PIB PREC` long"
    )
    return indicators.transform(raw.withColumnRenamed("PIB PREC", "pib_prec"))


def test_indicator_transform(spark, provinces):
    assert as_set(provinces, "nombre_provincia", "categoria_despoblamiento", "ratio_genero") == {
        ("Araba", "Low", 1.0),
        ("Burgos", "Medium", None),
        ("Burgos", "High", 1.0),
        ("Zaragoza", "Very High", 2.0),
        ("Ceuta", None, 1.0),
    }
    assert {"fecha_procesamiento", "version_pipeline", "pib_precios_corrientes"} <= set(provinces.columns)


def test_transform_without_the_optional_columns(spark):
    log = steps.StepLog()
    done = indicators.transform(spark.createDataFrame([(1,)], "`Otra Cosa` long"), log)
    assert done.drop("fecha_procesamiento").columns == ["otra_cosa", "version_pipeline"]
    assert [r.operation for r in log.frame(spark).collect()] == ["clean_column_names", "rename_columns"]


def test_category_reports(provinces):
    assert as_rows(indicators.indicators_by_category(provinces)) == [
        ("Low", 1, "1,000", 10.0, 100.0),
        ("Medium", 1, "2,000", 20.0, 300.0),
        ("High", 1, "3,000", 30.0, 500.0),
        ("Very High", 1, "4,000", None, 700.0),
    ]
    assert [r[0] for r in as_rows(indicators.category_stats(provinces))] == ["Very High", "High", "Medium", "Low"]
    assert as_rows(indicators.rates_by_category(provinces)) == [
        (None, 50.0, 45.0, 50.0),
        ("High", 30.0, None, 30.0),
        ("Medium", 20.0, 55.0, 10.0),
        ("Low", 10.0, 50.0, 5.0),
    ]
    means = {r[0]: r[1:] for r in as_rows(indicators.category_means(provinces.where("poblacion_total > 1500")))}
    assert means == {
        "Low": (None, None),
        "Medium": (20.0, 2000.0),
        "High": (30.0, 3000.0),
        "Very High": (None, 4000.0),
    }


def test_indicator_rankings(provinces):
    assert [r.porcentaje_despoblamiento for r in indicators.filter_indicators(provinces, "hIgH").collect()] == [90, 60]
    assert [r[0] for r in as_rows(indicators.ranking(provinces, 2))] == [90, 60]
    assert as_rows(indicators.topk_indicators(provinces, 1))[0][:2] == ("Zaragoza", 90)
    with pytest.raises(ValueError):
        indicators.filter_indicators(provinces, limit=1001)


@pytest.fixture
def people(spark):
    rows = []
    for province, town, men, women in (("A", "1 x", 6000, 6001), ("A", "2 y", 10, 20), ("B", "3 z", 500, 400)):
        for year, factor in ((2010, 1), (2022, 2), (2023, 3)):
            numbers = {"Hombres": men * factor, "Mujeres": women * factor, "Total": (men + women) * factor}
            rows += [(ord(province), province, town, sex, str(year), str(n)) for sex, n in numbers.items()]
    rows += [(65, "A", "4 w", "Total", "1997", None), (65, "A", "Sin código", "Total", "n/a", "7")]
    raw = spark.createDataFrame(
        rows, "codigo_provincia int, nombre_provincia string, Municipios string, Sexo string, Periodo string, Total string"
    )
    return population.transform(raw)


def test_population_transform(people):
    assert people.count() == 28
    odd = people.where("municipios = 'Sin código'").first()
    assert (odd.codigo_municipio, odd.nombre_municipio, odd.periodo, odd.total) == (None, None, None, 7.0)


def test_population_reports(people):
    assert as_rows(population.population_by_province(people)) == [("A", 36093.0), ("B", 2700.0)]
    assert as_rows(population.population_pivot_sex(people, 2022)) == [
        ("A", 24062.0, 12020.0, 12042.0),
        ("B", 1800.0, 1000.0, 800.0),
    ]
    assert as_rows(population.population_by_sex_top(people, k=1)) == [("A", 2023, 36093.0, 18030.0, 18063.0)]
    assert as_rows(population.evolution_distinct(people)) == [
        (2023, 38793.0, 3),
        (2022, 25862.0, 3),
        (2010, 12931.0, 3),
    ]
    assert as_rows(population.evolution(people, "b", 2011)) == [(2022, 1800.0), (2023, 2700.0)]
    assert as_rows(population.growth(people)) == [("A", "x", 36003.0, 12001.0, 200.0)]
    assert as_rows(population.top_municipalities(people, k=2)) == [("A", "x", 36003.0), ("B", "z", 2700.0)]
    assert as_set(population.sum_by_sex(people)) == {("Hombres", 19530.0), ("Mujeres", 19263.0)}
    assert as_rows(population.municipalities_per_province(people, k=1)) == [("A", 2, 36093.0)]
    assert as_rows(population.yoy_growth(people)) == [
        (2010, 12931.0, None, None),
        (2022, 25862.0, 12931.0, 100.0),
        (2023, 38793.0, 25862.0, 50.0),
    ]


def test_summary_counts_people_once_unless_asked(people):
    once = as_set(population.population_summary(people).where("periodo = 2023"))
    assert once == {(65, "A", 2023, 36093.0, 18046.5, 2), (66, "B", 2023, 2700.0, 2700.0, 1)}
    twice = as_set(population.population_summary(people, unfiltered=True).where("periodo = 2023"))
    assert twice == {(65, "A", 2023, 72186.0, 12031.0, 6), (66, "B", 2023, 5400.0, 1800.0, 3)}


def test_population_filters(people):
    assert population.filter_population(people, "a", "X", 2023).count() == 3
    assert population.filter_population(people, "", None, 0, limit=5).count() == 5
    with pytest.raises(ValueError):
        population.filter_population(people, limit=-1)


def test_shares(people):
    rows = people.where("periodo = 2023 AND sexo = 'Total'")
    shares = as_rows(population.share_of_total(rows, "nombre_provincia", "total"))
    assert shares == [("A", 36093.0, 93.0), ("B", 2700.0, 7.0)]


@pytest.fixture
def firms(spark):
    rows = [
        ("Burgos", "m1", 10.4, "C", 1.0, 5.0),
        ("Burgos", "m1", 20.2, "D", None, 6.0),
        ("Zaragoza", "m2", 5.0, "C", 3.0, None),
        ("Zaragoza", "m3", None, None, 4.0, 8.0),
        ("Lugo", "m4", None, "E", None, 1.0),
    ]
    names = "provincia string, municipio string, pib_municipios_2016 double, aaee_seccion_cnae09 string, "
    return spark.createDataFrame(rows, names + "vab_corregido_2016 double, afiliados_diciembre_de_2016 double")


def test_industry_reports(firms):
    assert as_rows(industry.industry_by_province_top(firms)) == [("Burgos", 1, 31.0, 15.0), ("Zaragoza", 1, 5.0, 5.0)]
    assert as_rows(industry.industry_by_province(firms)) == [
        ("Burgos", 1, 31.0, 1.0, 11.0),
        ("Zaragoza", 2, 5.0, 7.0, 8.0),
        ("Lugo", 1, None, None, 1.0),
    ]
    assert as_rows(industry.sectors_all(firms)) == [("C", 2, 4.0, 5.0, 2.0), ("D", 1, None, 6.0, None), ("E", 1, None, 1.0, None)]
    assert as_rows(industry.sectors_gva_known(firms)) == [("C", 4.0, 5.0)]
    assert as_rows(industry.sectors_top(firms.withColumnRenamed("aaee_seccion_cnae09", "s"), 1, "s")) == [("C", 2, 4.0, 5.0)]
    assert industry.filter_industry(firms, "BUR", "c").count() == 1


def test_industry_transform(firms):
    assert as_set(industry.transform(firms), "provincia", "codigo_provincia_ine") == {
        ("Burgos", 9),
        ("Zaragoza", 50),
        ("Lugo", 27),
    }


def test_cross_analysis_equals_the_plain_means(provinces, firms):
    found = {r[0]: r for r in as_rows(cross.cross_analysis(provinces, lookup_codes(firms)))}
    plain = {r[0]: r for r in as_rows(indicators.category_economics(provinces))}
    assert {k: v[:5] for k, v in found.items()} == plain
    assert {k: v[5] for k, v in found.items()} == {"Low": None, "Medium": 31.0, "High": 31.0, "Very High": 5.0}


def test_counts_and_samples(spark, firms):
    assert as_rows(cross.count_per_table({"a": firms, "b": firms.limit(0)})) == [("a", 5), ("b", 0)]
    assert [r.municipio for r in ranking.sample_rows(firms, 2, ["municipio"]).collect()] == ["m1", "m1"]


def test_step_log(spark):
    log = steps.StepLog()
    df = spark.createDataFrame([(1, None), (1, None), (2, 5)], "`A b` long, c long")
    df = steps.remove_duplicates(steps.clean_names(df, log), log=log)
    df = steps.handle_missing(df, "fill_zero", log=log)
    assert as_set(df) == {(1, 0), (2, 5)}
    assert [tuple(r)[2:] for r in log.frame(spark).orderBy("position").collect()] == [
        ("clean_column_names", "1 of 2 names changed: a_b, c"),
        ("remove_duplicates", "rows dropped: 1"),
        ("handle_missing", "fill_zero: rows touched: 0"),
    ]


def test_read_only_sql(spark):
    spark.range(20).createOrReplaceTempView("twenty")
    text = "WITH t AS (SELECT id AS created_at FROM twenty) SELECT created_at FROM t WHERE created_at < :top"
    assert adhoc.read_only_sql(spark, text, {"top": 3}).count() == 3
    result = adhoc.execute(spark, "select id from twenty")
    assert result.success and result.row_count == 20 and result.error is None and result.execution_time_ms >= 0
    assert adhoc.preview(result.data).count() == 15
    failed = adhoc.execute(spark, "SELECT nothing FROM twenty")
    assert not failed.success and failed.row_count == 0 and "nothing" in failed.error
    assert adhoc.read_only_sql(spark, "SELECT :v AS v", {"v": "x'; DROP TABLE t"}).first().v == "x'; DROP TABLE t"
    assert adhoc.read_only_sql(spark, "SELECT id FROM twenty WHERE 'update' <> 'drop' -- delete").count() == 20
    with pytest.raises(AnalysisException):
        adhoc.read_only_sql(spark, "SELECT nothing FROM twenty")


REFUSED = """
DROP TABLE twenty
SELECT 1; delete from twenty
selection
WITH x AS (SELECT 1) INSERT INTO t SELECT 1
FROM twenty INSERT INTO a SELECT *
CREATE TABLE q AS SELECT 1
SET x=1
CACHE TABLE twenty
EXPLAIN SELECT 1
SHOW TABLES
ADD JAR x
BEGIN SELECT 1; END
EXECUTE IMMEDIATE 'drop table x'
DECLARE VARIABLE x INT
SELECT TRANSFORM(a) USING 'cat' AS (x STRING) FROM VALUES (1) t(a)
WITH x AS (SELECT TRANSFORM(a) USING 'cat' AS (x STRING) FROM VALUES (1) t(a)) SELECT * FROM x
MAP a USING 'cat' AS b FROM twenty
SELECT reflect('java.lang.System', 'getProperty', 'user.dir')
SELECT `java_method` ('java.lang.System', 'getProperty', 'user.dir')
SELECT try_reflect/* */('java.lang.System', 'getProperty', 'user.dir')
SELECT r'\' AS c, reflect('java.lang.System','getProperty','user.dir')
SELECT (SELECT max(reflect('a','b')))
SELECT id FROM twenty WHERE id IN (SELECT reflect('a','b'))
SELECT transform(array(1), x -> reflect('a','b'))
SELECT sum(1) OVER (ORDER BY reflect('a','b'))
SELECT * FROM twenty t, LATERAL (SELECT reflect('a','b'))
SELECT * FROM twenty LATERAL VIEW reflect('a','b') q AS e
SELECT system.builtin.reflect('a')
SELECT IDENTIFIER('ref' || 'lect')('a','b')
SELECT a_users_own(1)
SELECT * FROM IDENTIFIER('parquet.`/tmp/x`')
SELECT * FROM parquet.`/tmp/x`
SELECT * FROM text.`README.md`
SELECT * FROM twenty JOIN csv.`/x`
SELECT * FROM default.nothing
SELECT * FROM read_files('/x')
""".strip().splitlines()

ALLOWED = """
SELECT id FROM twenty WHERE concat(id, '') <> 'update' -- drop
VALUES (1), (2)
SELECT id AS `drop table`, 'reflect(' AS `TRANSFORM` FROM twenty /* delete */
SELECT t.id, max(u.id) OVER (PARTITION BY t.id % 3 ORDER BY u.id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) FROM twenty t JOIN twenty u USING (id)
SELECT id FROM twenty t WHERE EXISTS (SELECT 1 FROM twenty x WHERE x.id = t.id) AND id IN (SELECT id FROM twenty) AND id BETWEEN 1 AND 5
SELECT e FROM (SELECT array(1, 2) AS xs) LATERAL VIEW explode(xs) q AS e
SELECT transform(array(1, 2), x -> x + 1), CASE WHEN 1 = 1 THEN 'a' ELSE 'b' END, extract(year FROM current_date()), struct(1 AS a).a
SELECT * FROM twenty PIVOT (count(1) FOR id IN (1, 2))
SELECT id FROM twenty UNION ALL SELECT 1 EXCEPT SELECT 2
SELECT k, grouping_id() FROM (SELECT id % 2 AS k FROM twenty) GROUP BY CUBE(k) HAVING count(*) > 0 ORDER BY 1 LIMIT 2
SELECT (SELECT max(id) FROM twenty) AS m, /* + none */ id::string FROM range(5)
SELECT percentile_cont(0.5) WITHIN GROUP (ORDER BY id), count(DISTINCT id) FILTER (WHERE id > 1) FROM twenty
SELECT * EXCEPT (id) FROM (SELECT id, 1 AS a FROM twenty)
SELECT rank() OVER w FROM twenty WINDOW w AS (ORDER BY id)
SELECT id FROM default.kept_numbers
""".strip().splitlines()


@pytest.mark.parametrize("text", REFUSED)
def test_what_is_no_query_is_refused(spark, text):
    spark.range(20).createOrReplaceTempView("twenty")
    with pytest.raises(adhoc.RejectedQuery):
        adhoc.read_only_sql(spark, text)


@pytest.mark.parametrize("text", ALLOWED)
def test_any_query_is_allowed(spark, text):
    spark.range(20).createOrReplaceTempView("twenty")
    if not spark.catalog.tableExists("kept_numbers"):
        spark.range(3).write.saveAsTable("kept_numbers")
    assert adhoc.read_only_sql(spark, text).count() > 0


def test_a_query_runs_once(spark):
    spark.range(20).createOrReplaceTempView("twenty")
    result = adhoc.execute(spark, "SELECT uuid() AS u, id, id, NULL AS n, make_interval(1) AS `a b` FROM twenty")
    assert result.row_count == 20 and result.data.columns == ["u", "id", "id", "n", "a b"]
    # Random values that are worked out once are the same in every reading.
    assert {r[0] for r in result.data.collect()} == {r[0] for r in result.data.collect()}
    assert adhoc.execute(spark, "SELECT 1 WHERE false").row_count == 0
    unparsed = adhoc.execute(spark, "SELECT (1")
    assert not unparsed.success and "SYNTAX" in unparsed.error
    with pytest.raises(adhoc.RejectedQuery):
        adhoc.execute(spark, "DROP VIEW twenty")
    assert spark.catalog.tableExists("twenty")
