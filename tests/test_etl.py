import threading
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comarca import schemas
from comarca.__main__ import main
from comarca.plans import population
from comarca.plans.etl import Run, transform_all
from comarca.sinks import registry
from comarca.sources.registry import open_data_readers
from entries.workbooks import workbook
from tests.conftest import as_rows, as_set


def _raw(root):
    folder = root / "despoblamiento"
    folder.mkdir()
    names = [part.split("`")[1] for part in schemas.INDICATOR_SCHEMA.split(", ")]
    lines = [";".join(names)]
    for code, name, percent in ((1, "Araba/Álava", 10), (51, "Ceuta", 0), (50, "Zaragoza", 100)):
        values = {"cod_prov": code, "nom_prov": name, "porcen_desp": percent, "pob_tot": 100, "pob_hom": 60, "pob_muj": 40}
        lines.append(";".join(str(values.get(n, 1)) for n in names))
    (folder / schemas.INDICATOR_FILE).write_text("\n".join(lines), encoding="utf-8")

    folder = root / "pob_x_munic_y_sexo"
    folder.mkdir()
    header = "codigo_provincia;nombre_provincia;Municipios;Sexo;Periodo;Total"
    for code, name in ((51, "Ceuta"), (52, "Melilla")):
        rows = [
            f"{code};{name};{code}001 {name};{sex};{year};{'' if year == 1997 else 100 + year}"
            for sex in ("Total", "Hombres", "Mujeres")
            for year in (1996, 1997, 2023)
        ]
        (folder / f"29{code}.csv").write_text("\n".join([header, *rows]), encoding="utf-8")

    folder = root / "industria"
    folder.mkdir()
    for name in ("Burgos", "CReal", "Ceuta"):
        sheet = pd.DataFrame({"Municipio": ["m"], "PIB Municipios 2016": [2.5], "AAEE Sección CNAE09": ["C"]})
        (folder / f"{name} 2019.xlsx").write_bytes(workbook(sheet))


def test_whole_run(spark, tmp_path):
    _raw(tmp_path)
    loaders = {
        "table": registry.table_loader(prefix="etl_", folder=f"{tmp_path}/tables"),
        "file": registry.file_loader(f"{tmp_path}/files"),
    }
    run = Run(spark, open_data_readers(str(tmp_path)), loaders, ["table", "file"])
    assert run.run()
    facts = spark.table("etl_fact_despoblamiento")
    assert as_set(facts, "nombre_provincia", "categoria_despoblamiento", "ratio_genero") == {
        ("Araba/Álava", "Low", 1.5),
        ("Ceuta", None, 1.5),
        ("Zaragoza", "Very High", 1.5),
    }
    people = spark.table("etl_fact_poblacion")
    assert people.count() == 12
    assert as_set(people, "codigo_municipio", "nombre_municipio", "source_file") == {
        ("51001", "Ceuta", "2951.csv"),
        ("52001", "Melilla", "2952.csv"),
    }
    assert as_rows(population.population_by_province(people)) == [("Ceuta", 2123.0), ("Melilla", 2123.0)]
    firms = spark.table("etl_fact_industria")
    assert as_set(firms, "provincia", "codigo_provincia_ine", "aaee_seccion_cnae09", "anio") == {
        ("Burgos", 9, "C", 2019),
        ("CReal", 13, "C", 2019),
        ("Ceuta", None, "C", 2019),
    }
    metrics = as_set(run.metrics(), "phase", "source", "target", "rows", "success")
    assert {(p, s, None, n, True) for p, s, n in (("extract", "poblacion", 18), ("transform", "poblacion", 12))} <= metrics
    assert {("load", s, t, n, True) for s, n in (("despoblamiento", 3), ("industria", 3)) for t in loaders} <= metrics
    assert len(metrics) == 12
    missing = as_set(run.quality().where("missing_percentage > 0"), "dataset", "column")
    assert missing == {("despoblamiento", "categoria_despoblamiento"), ("industria", "codigo_provincia_ine")}


def test_a_failing_source_or_target_fails_the_run_but_not_the_others(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"not parquet")

    def reads_badly(spark):
        return spark.read.schema("a long").parquet(f"{tmp_path}/bad")

    loaders = {"file": registry.file_loader(f"{tmp_path}/files")}
    run = Run(spark, {"ok": lambda s: s.range(4), "bad": reads_badly}, loaders, ["file"], {})
    assert not run.run()
    assert set(run.errors) == {"bad"}
    assert as_set(run.metrics().where("phase = 'load'"), "source", "rows", "success") == {("ok", 4, True), ("bad", 0, False)}
    unknown = Run(spark, {"ok": lambda s: s.range(4)}, loaders, ["tape"], {})
    assert not unknown.run()


def test_a_failing_transform_keeps_its_input(spark):
    def fail(df, log):
        raise ValueError("no")

    errors, logs = {}, {}
    data = {"a": spark.range(2), "empty": spark.range(0), "other": spark.range(1)}
    done = transform_all(data, {"a": fail, "empty": fail}, logs, errors)
    assert done == data and errors == {"a": "no"} and set(logs) == {"a", "empty"}


def test_phases_can_run_alone(spark, tmp_path):
    _raw(tmp_path)
    run = Run(spark, open_data_readers(str(tmp_path)), {}, ["table"])
    raw = run.extract()
    assert raw["despoblamiento"].count() == 3 and run.transform(raw)["poblacion"].count() == 12
    assert {row.phase for row in run.metrics().collect()} == {"extract", "transform"}


def test_load_phase_alone(spark, tmp_path):
    _raw(tmp_path)
    stage = ["--root", str(tmp_path), "--staging", f"{tmp_path}/staged"]
    files = ["-t", "file", "--output", f"{tmp_path}/out"]
    with pytest.raises(SystemExit):
        main(["--root", str(tmp_path), "--phase", "load"])
    assert main([*stage, "--phase", "load", *files]) == 1
    assert main([*stage, "--phase", "transform"]) == 0
    assert main([*stage, "--phase", "transform"]) == 1
    assert main([*stage, "--phase", "load", *files]) == 0
    assert [p.name for p in (tmp_path / "out").iterdir()]


def test_load_phase_leaves_out_what_failed(spark, tmp_path):
    def fail(df, log):
        raise ValueError("no")

    readers = {"good": lambda s: s.range(4), "bad": lambda s: s.range(2)}
    first = Run(spark, readers, {}, transforms={"bad": fail}, staging=f"{tmp_path}/staged")
    first.transform(first.extract())
    later = Run(spark, readers, {"file": registry.file_loader(f"{tmp_path}/out")}, ["file"], staging=first.staging)
    assert not later.load_staged() and set(later.errors) == {"bad"}
    assert as_set(later.metrics(), "phase", "source", "rows") == {("load", "good", 4)}


def test_command_line(spark, tmp_path):
    _raw(tmp_path)
    out = f"{tmp_path}/out"
    arguments = ["--root", str(tmp_path), "-t", "table", "-t", "file", "--output", out]
    assert main(arguments) == 0
    assert spark.table("fact_poblacion").count() == 12
    one_year = population.population_by_province(spark.table("fact_poblacion"), 1996)
    assert as_rows(one_year) == [("Ceuta", 2096.0), ("Melilla", 2096.0)]
    scan = one_year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(periodo" in scan
    assert main(["--root", str(tmp_path), "--phase", "extract"]) == 0
    # No source files: nothing reaches the target.
    assert main(["--root", f"{tmp_path}/absent"]) == 1
    with pytest.raises(SystemExit):
        main(["--root", str(tmp_path), "-t", "all"])


def test_sources_go_side_by_side_and_fail_alone(spark, tmp_path):
    together, groups = threading.Barrier(3, timeout=60), {}

    def reader(name, ids):
        def read(spark):
            together.wait()
            groups[name] = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
            return spark.range(ids).withColumn("source", F.lit(name))
        return read

    def broken(df, steps):
        return df.withColumn("id", F.raise_error(F.lit("broken row")))

    readers = {name: reader(name, n) for name, n in (("one", 5), ("two", 7), ("three", 9))}
    run = Run(spark, readers, {"file": registry.file_loader(f"{tmp_path}/files")}, ["file"], transforms={"two": broken})
    assert run.run() is False and set(run.errors) == {"two"} and "broken row" in run.errors["two"]
    assert len(set(groups.values())) == 3 and all(name in group for name, group in groups.items())
    measured = [(m.phase, m.source, m.success) for m in run.metrics().collect()]
    assert measured == [
        *[("extract", n, True) for n in readers], ("transform", "one", True), ("transform", "two", False),
        ("transform", "three", True), ("load", "one", True), ("load", "three", True),
    ]
    assert spark.range(3).count() == 3 and [e[1] for e in run.loads.entries] == ["fact_one", "fact_three"]
