import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from comarca.plans.etl import Run
from comarca.schemas import REJECTED_CELLS
from comarca.sinks import registry as sinks
from comarca.sources import catalog, delimited, registry, staged, workbook
from comarca.streaming import batched
from entries.workbooks import workbook as make_workbook
from tests.conftest import as_rows, as_set

SCHEMA = "a int, b string, c double"


def _write(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_one_file(spark, tmp_path):
    path = _write(tmp_path, one="a;b;c\n1;ñandú;2.5\n2;;\n")
    df = delimited.read_file(spark, f"{path}/one.csv", SCHEMA)
    assert as_set(df) == {(1, "ñandú", 2.5, "one.csv"), (2, None, None, "one.csv")}


def test_absent_file_is_an_empty_table_of_the_same_shape(spark, tmp_path):
    df = delimited.read_file(spark, f"{tmp_path}/absent.csv", SCHEMA)
    assert df.columns == ["a", "b", "c", "source_file"] and df.isEmpty()
    assert delimited.read_folder(spark, f"{tmp_path}/absent", SCHEMA).isEmpty()


def test_headers_are_matched_by_name(spark, tmp_path):
    path = _write(tmp_path, x="a;b\n1;one\n", y="b;a;d\ntwo;2;extra\n")
    df = delimited.read_folder(spark, path, SCHEMA)
    assert df.columns == ["a", "b", "source_file", "d"]
    assert as_set(df) == {(1, "one", "x.csv", None), (2, "two", "y.csv", "extra")}


def test_a_file_with_a_too_wide_line_adds_no_rows(spark, tmp_path):
    path = _write(tmp_path, good='a;b\n1;"x;y"\n', short="a;b\n2\n", bad="a;b\n3;x\n4;y;z\n")
    assert as_set(delimited.read_folder(spark, path, SCHEMA), "a", "b") == {(1, "x;y"), (2, None)}
    kept = delimited.read_folder(spark, path, SCHEMA, skip_bad_files=False)
    assert as_set(kept, "a") == {(1,), (2,), (3,), (4,)}


def test_odd_file_names(spark, tmp_path):
    path = _write(tmp_path, **{"La Coruña+[1] 2019": "a;b\n1;x\n", "b#2%": "b;a\ny;2\n"})
    df = delimited.read_folder(spark, path, SCHEMA)
    assert as_set(df, "a", "source_file") == {(1, "La Coruña+[1] 2019.csv"), (2, "b#2%.csv")}


def test_other_files_of_the_folder_are_left_alone(spark, tmp_path):
    path = _write(tmp_path, x="a;b\n1;one\n")
    (tmp_path / "notes.txt").write_text("a;b;c;d\n")
    assert as_set(delimited.read_folder(spark, path, SCHEMA), "a") == {(1,)}


def test_batches_of_files(spark, tmp_path):
    path = _write(tmp_path / "in", **{f"f{i}": f"a;b;c\n{i};x;0\n" for i in range(7)})
    stream = batched.stream_folder(spark, path, SCHEMA, files_per_batch=3)
    sizes = []
    batched.drain_batches(stream, lambda df, n: sizes.append(df.count()), f"{tmp_path}/cp")
    assert sizes == [3, 3, 1]
    batched.drain_to_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/cp2")
    assert as_set(spark.read.parquet(f"{tmp_path}/out"), "a", "source_file") == {(i, f"f{i}.csv") for i in range(7)}
    _write(tmp_path / "in", late="a;b;c\n9;x;0\n")
    batched.drain_to_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/cp2")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 8


def test_cells_that_do_not_parse_are_listed(spark, tmp_path):
    path = _write(tmp_path, f="b;a;c;e\none;12.5;x1;7\n;9;;\ntwo; ;2,5;z\nthree;1e3;-1.5;\n", g="c;b\nnone;n\n3;m\n")
    rows = delimited.read_folder(spark, path, SCHEMA, rejected="lost")
    assert rows.columns == ["a", "b", "c", "e", "source_file", "lost"]
    assert as_set(rows, "a", "b", "c") == {
        (None, "one", None), (9, None, None), (None, "two", None), (None, "three", -1.5), (None, "n", None), (None, "m", 3.0)
    }
    lost = delimited.rejected_cells(rows, "lost")
    assert as_set(lost) == {
        ("f.csv", "a", "12.5"), ("f.csv", "c", "x1"), ("f.csv", "c", "2,5"), ("f.csv", "a", "1e3"), ("g.csv", "c", "none")
    }
    one = delimited.read_file(spark, f"{path}/f.csv", SCHEMA, rejected="lost")
    assert delimited.rejected_cells(one, "lost").count() == 4 and one.columns == ["a", "b", "c", "e", "source_file", "lost"]
    text = delimited.read_file(spark, f"{path}/f.csv", "b string", rejected="lost")
    assert delimited.rejected_cells(text, "lost").isEmpty()
    absent = delimited.read_file(spark, f"{path}/absent.csv", SCHEMA, rejected="lost")
    assert delimited.rejected_cells(absent, "lost").isEmpty()


def test_a_run_reports_the_cells_it_lost(spark, tmp_path):
    path = _write(tmp_path / "pob", f="Periodo;Total\n2020;1.234\n2021;x\n2022;7\n")
    readers = {"p": lambda spark: delimited.read_folder(spark, path, "Periodo int, Total long", rejected=REJECTED_CELLS)}
    run = Run(spark, readers, {"file": sinks.file_loader(str(tmp_path / "out"))}, ["file"], transforms={})
    assert run.run() and REJECTED_CELLS not in run.transformed["p"].columns
    assert as_set(run.rejected_cells()) == {("p", "f.csv", "Total", "1.234"), ("p", "f.csv", "Total", "x")}


def test_wide_rows_are_seen_through_quotes_and_line_breaks(spark, tmp_path):
    good, bad = 'a;b\n1;"x;\ny;;"\n', 'a;b\n2;"x\ny";z\n'
    path = _write(tmp_path, good=good, bad=bad, blank="a;b\n3;x;\n")
    assert as_set(delimited.read_folder(spark, path, SCHEMA, multi_line=True), "a", "b") == {(1, "x;\ny;;")}
    kept = delimited.read_folder(spark, path, SCHEMA, multi_line=True, skip_bad_files=False)
    assert as_set(kept, "a") == {(1,), (2,), (3,)}


def test_one_layout_is_checked_against_the_header(spark, tmp_path):
    path = _write(tmp_path, x="a;b;c\n1;one;2\n", y="b;a;c\ntwo;2;3\n")
    with pytest.raises(Exception, match="header"):
        delimited.read_folder(spark, path, SCHEMA, same_headers=True, skip_bad_files=False).collect()


def test_batches_by_header_name_are_added_once(spark, tmp_path):
    folder = tmp_path / "in"
    path = _write(folder, a="a;b;c\n1;one;1.5\n", b="c;a\n2.5;2\n", c="b;x;a\nthree;?;3\n", d="a;b\n4;x\n5;y;z\n", e="a\nbad\n")
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/cp"
    rows = batched.drain_by_name(spark, path, SCHEMA, out, checkpoint, files_per_batch=2, rejected="lost")
    want = {(1, "one", 1.5, "a.csv"), (2, None, 2.5, "b.csv"), (3, "three", None, "c.csv"), (None, None, None, "e.csv")}
    assert rows.columns == ["a", "b", "c", "source_file", "lost"] and as_set(rows, "a", "b", "c", "source_file") == want
    assert as_set(delimited.rejected_cells(rows, "lost")) == {("e.csv", "a", "bad")}
    record = batched.Ledger(spark, out).record()
    assert record.count() == 5 and record.select("batch").distinct().count() == 3
    # New files only; a lost checkpoint brings the old ones again under other numbers.
    _write(folder, late="b;a\nlate;9\n")
    for at in (checkpoint, f"{tmp_path}/other"):
        rows = batched.drain_by_name(spark, path, SCHEMA, out, at, files_per_batch=2, rejected="lost")
        assert as_set(rows, "a", "b", "c", "source_file") == want | {(9, "late", None, "late.csv")}
        assert rows.count() == 5


def test_a_batch_replayed_after_a_failure_adds_nothing_twice(spark, tmp_path):
    path = _write(tmp_path / "in", a="a;b;c\n1;x;0\n", b="a;b;c\n2;x;0\n")
    ledger = batched.Ledger(spark, f"{tmp_path}/out")
    files = spark.createDataFrame([(f"file:{path}/a.csv",), (f"file:{path}/b.csv",)], "path string")

    def read(paths):
        return spark.createDataFrame([(p,) for p in paths], "source_file string")

    def broken(paths):
        # Rows are written, the record is not.
        read(paths).write.mode("overwrite").parquet(f"{tmp_path}/out/rows/batch=7")
        raise OSError("lost")

    with pytest.raises(OSError):
        ledger.add(7, files, broken)
    schema = read([]).schema
    assert ledger.rows(schema).isEmpty() and ledger.record().isEmpty()
    for _ in range(2):
        ledger.add(7, files, read)
        assert ledger.rows(schema).count() == 2
    ledger.add(8, files, read)
    assert ledger.rows(schema).count() == 2 and as_set(ledger.record(), "batch", "rows") == {(7, 2), (8, 0)}


@pytest.fixture
def books(tmp_path):
    (tmp_path / "Coruña 2019.xlsx").write_bytes(
        make_workbook(pd.DataFrame({"municipio": ["A & B", "C"], "pib": [1.5, None], "n": [1, 2]}))
    )
    (tmp_path / "Lugo 2019 2019.xlsx").write_bytes(make_workbook(pd.DataFrame({"pib": [3.0], "otro": ["x"]})))
    (tmp_path / "Broken 2019.xlsx").write_bytes(b"not a workbook")
    return str(tmp_path)


def test_workbooks_by_declared_columns(spark, books):
    layout = "municipio string, pib double, n long"
    df = workbook.read_folder(spark, books, layout, declared_only=True)
    wide = workbook.read_folder(spark, books, layout)
    assert wide.columns == ["municipio", "pib", "n", "otro", "source_file", "provincia", "anio"]
    assert as_set(wide.drop("otro")) == as_set(df)
    assert as_set(wide, "otro") == {(None,), ("x",)}
    assert as_set(df) == {
        ("A & B", 1.5, 1, "Coruña 2019.xlsx", "Coruña", 2019),
        ("C", None, 2, "Coruña 2019.xlsx", "Coruña", 2019),
        (None, 3.0, None, "Lugo 2019 2019.xlsx", "Lugo", 2019),
    }


def test_workbooks_by_their_own_headers(spark, books):
    df = workbook.read_folder(spark, books)
    assert as_set(df, "municipio", "pib", "otro") == {("A & B", 1.5, None), ("C", None, None), (None, 3.0, "x")}
    assert dict(df.dtypes)["n"] == "bigint" and dict(df.dtypes)["pib"] == "double"


def test_workbooks_keep_repeated_blank_and_mixed_columns(spark, tmp_path):
    wide = pd.DataFrame([["a", 1, 2, 3.5, "t"], ["b", 6, 4, None, 7]], columns=["name", "v", "v", None, "mixed"])
    (tmp_path / "A 2019.xlsx").write_bytes(make_workbook(wide))
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "B 2019.xlsx").write_bytes(make_workbook(pd.DataFrame({"name": ["c"]})))
    df = workbook.read_folder(spark, str(tmp_path))
    assert df.dtypes[:5] == [("name", "string"), ("v", "bigint"), ("v.1", "bigint"), ("Unnamed: 3", "double"), ("mixed", "string")]
    cells = {tuple(r)[:5] for r in df.collect()}
    assert cells == {("a", 1, 2, 3.5, "t"), ("b", 6, 4, None, "7")}
    assert workbook.read_folder(spark, str(tmp_path), recursive=True).count() == 3


def test_workbooks_past_column_z_and_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbook, "_BATCH", 2)
    names = [f"c{i}" for i in range(60)]
    sheet = pd.DataFrame([[i * 100 + j for j in range(60)] for i in range(5)], columns=names)
    (tmp_path / "A 2019.xlsx").write_bytes(make_workbook(sheet))
    whole = make_workbook(sheet)
    (tmp_path / "Cut 2019.xlsx").write_bytes(whole[: len(whole) // 2])
    df = workbook.read_folder(spark, str(tmp_path))
    assert as_set(df, "c0", "c26", "c59") == {(i * 100, i * 100 + 26, i * 100 + 59) for i in range(5)}


def test_workbook_with_shared_strings(spark, tmp_path):
    parts = zipfile.ZipFile(_bytes(make_workbook(pd.DataFrame({"x": [1]}))))
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "s.xlsx", "w") as book:
        for name in parts.namelist():
            if "sheet1" not in name:
                book.writestr(name, parts.read(name))
        book.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>name</t></si><si><r><t>Á</t></r><r><t>b</t></r></si></sst>")
        book.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet {main}><sheetData><row r="1"><c r="B1" t="s"><v>0</v></c></row>'
            '<row r="2"><c r="B2" t="s"><v>1</v></c></row></sheetData></worksheet>',
        )
    assert as_set(workbook.read_folder(spark, str(tmp_path)), "name") == {("Áb",)}


def _bytes(content):
    import io

    return io.BytesIO(content)


def test_provinces_come_from_file_names(spark, books):
    assert as_rows(workbook.list_provinces(spark, books)) == [("Broken",), ("Coruña",), ("Lugo",)]


def test_absent_workbook_folder(spark, tmp_path):
    df = workbook.read_folder(spark, f"{tmp_path}/none", "pib double")
    assert df.isEmpty() and df.columns == ["pib", "source_file", "provincia", "anio"]


def test_failing_source_leaves_the_others(spark, tmp_path):
    def broken(spark):
        raise OSError("gone")

    errors = {}
    data = registry.extract_all(spark, {"ok": lambda s: s.range(3), "bad": broken}, errors)
    assert as_set(registry.validation_report(data)) == {("ok", True, 3, 1), ("bad", False, 0, 1)}
    assert errors == {"bad": "gone"}
    assert registry.is_valid(data["ok"]) and not registry.is_valid(data["bad"])


def test_published_layout(spark, tmp_path):
    readers = registry.open_data_readers(str(tmp_path))
    data = registry.extract_all(spark, readers)
    assert set(data) == {"despoblamiento", "poblacion", "industria"}
    assert len(data["despoblamiento"].columns) == 46
    assert all(df.isEmpty() for df in data.values())


def test_catalog(spark):
    spark.range(5).select("id", F.lit("x").alias("t")).createOrReplaceTempView("five_rows")
    assert "five_rows" in catalog.table_names(spark)
    assert ("five_rows", 5) in as_set(catalog.list_tables(spark))
    assert as_rows(catalog.table_info(spark, "five_rows")) == [
        ("five_rows", 5, 1, "id", "bigint", None),
        ("five_rows", 5, 2, "t", "string", None),
    ]
    missing = catalog.table_info(spark, "no_such_table").first()
    assert missing.row_count is None and "no_such_table" in missing.error
    text = catalog.schema_text(spark, ["five_rows"]).first().schema_text
    assert text == "Table: five_rows\n  Columns: id (bigint), t (string)\n  Rows: 5"
    profile = catalog.profile_tables(spark, ["five_rows"]).first()
    assert profile.row_count == 5 and len(profile.sample) == 3
    assert staged.read_table(spark, "five_rows").count() == 5
