import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("missing", ["folders", "folders and pipeline", "zstandard"])
def test_the_rest_is_registered_without_the_corpus_operators(tmp_path, missing):
    root = Path(contract.__file__).resolve().parent
    for name in ("comarca", "entries"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *["llm"] * ("folders" in missing)))
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * (missing != "folders and pipeline"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    if missing == "zstandard":
        (tmp_path / "zstandard.py").write_text("raise ImportError('not here')")
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    own = [k for m in (contract.reports, contract.steps, contract.places) for k in m.QUERIES]
    assert found.stdout.split() == own and len(own) == len(set(own))


def test_flagship(spark):
    found = contract.entry(spark)
    assert found.columns == ["nombre_provincia", "poblacion"] and 0 < found.count() <= 15


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("key", contract.queries())
def test_query_equals_its_sql(spark, duck, key):
    assert check.compare(spark, duck, key, SF) is None


@pytest.mark.parametrize("least", [4, 8])
def test_files_of_written_folders_do_not_grow_with_the_table(spark, monkeypatch, least):
    """A file with line breaks in quotes is read by one task."""
    monkeypatch.setattr(contract.places, "_FILE_BYTES", 1 << 15, raising=False)
    folder = Path(contract.places._two_layouts(spark, SF))
    # Four of each layout whatever the size, before.
    assert len(list(folder.glob("*.csv"))) > 8
    table = spark.read.parquet(f"{SF}/orders.parquet")
    spread = contract.places._spread(table, least)
    assert spread.rdd.getNumPartitions() >= least and sorted(spread.collect()) == sorted(table.collect())
    assert contract.places._spread(table.where("false"), least).count() == 0
