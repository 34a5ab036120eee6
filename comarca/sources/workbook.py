"""Folders of ``.xlsx`` workbooks: one file per row of a binary scan, read inside the task."""

from __future__ import annotations

import io
import itertools
import logging
import pickle
import re
import sys
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.functions.scalars import coerce_number
from comarca.sources.files import file_name, missing_path

# Tasks get this module's functions by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SURVEY_YEAR = 2019
_BATCH = 10_000
_WAITING = 16 << 20
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# What the cells of a column hold, from narrow to wide; a column of several takes the widest.
_EMPTY, _WHOLE, _NUMBER, _TEXT = range(4)


def province_of_file(file_name: Column) -> Column:
    """File name without its extension and without any ``" 2019"``."""
    stem = F.regexp_replace(file_name, r"\.xlsx$", "")
    return F.replace(stem, F.lit(f" {SURVEY_YEAR}"), F.lit(""))


def with_file_columns(df: DataFrame, file_name: str = "source_file") -> DataFrame:
    return df.withColumns({"provincia": province_of_file(F.col(file_name)), "anio": F.lit(SURVEY_YEAR)})


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets/{_MAIN}sheet")
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    target = targets[sheet.get(_RELATION)]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _cell(cell: ElementTree.Element, shared: Sequence[str]) -> tuple[str, bool] | None:
    """Text of a cell and whether it is stored as a number; None where it is empty or an error."""
    kind, value = cell.get("t", "n"), cell.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")), False
    if value is None or value.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value.text)], False
    if kind == "b":
        return "true" if value.text == "1" else "false", False
    return value.text, kind == "n"


def sheet_cells(content: bytes) -> Iterator[list[tuple[str, bool] | None]]:
    """Cells of the first sheet, row by row; rows already read don't stay in memory."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
        with book.open(_first_sheet(book)) as sheet:
            data = None
            for event, element in ElementTree.iterparse(sheet, ("start", "end")):
                if event == "start":
                    data = element if element.tag == f"{_MAIN}sheetData" else data
                elif element.tag == f"{_MAIN}row":
                    cells: list[tuple[str, bool] | None] = []
                    for cell in element:
                        at = _column_index(cell.get("r")) if cell.get("r") else len(cells)
                        cells.extend([None] * (at + 1 - len(cells)))
                        cells[at] = _cell(cell, shared)
                    yield cells
                    data.clear()


def column_names(header: Sequence[str | None]) -> list[str]:
    """A name for every column: repeated ones get ``.1``, ``.2``, blank ones ``Unnamed: <place from 0>``."""
    names: dict[str, int] = {}
    for at, text in enumerate(header):
        name = first = text or f"Unnamed: {at}"
        again = 0
        while name in names:
            again += 1
            name = f"{first}.{again}"
        names[name] = at
    return list(names)


def _kind(text: str, number: bool) -> int:
    if not number:
        return _TEXT
    return _WHOLE if re.fullmatch(r"-?\d{1,18}", text) else _NUMBER


def sheet_columns(content: bytes) -> list[tuple[int, str, int]]:
    """``(place, name, kind)`` of every column that has a header or a filled cell."""
    rows = sheet_cells(content)
    header = [cell[0] if cell else None for cell in next(rows, [])]
    kinds = [_EMPTY] * len(header)
    for row in rows:
        kinds.extend([_EMPTY] * (len(row) - len(kinds)))
        for at, cell in enumerate(row):
            if cell:
                kinds[at] = max(kinds[at], _kind(*cell))
    header.extend([None] * (len(kinds) - len(header)))
    columns = zip(itertools.count(), column_names(header), kinds)
    return [(at, name, kind) for at, name, kind in columns if header[at] or kind != _EMPTY]


def picked_cells(content: bytes, columns: Sequence[str]) -> Iterator[tuple[dict[str, list], int]]:
    """The texts of the wanted columns, a batch of rows at a time, and the batch's size."""
    rows = sheet_cells(content)
    header = [cell[0] if cell else None for cell in next(rows, [])]
    # Columns without a header are named by their place, which may be beyond the header.
    blank = [int(m.group(1)) + 1 for c in columns if (m := re.match(r"Unnamed: (\d{1,5})", c))]
    header.extend([None] * (max([len(header), *blank]) - len(header)))
    place = {name: at for at, name in enumerate(column_names(header))}
    while part := list(itertools.islice(rows, _BATCH)):
        picked = {
            name: [row[at][0] if at < len(row) and row[at] else None for row in part]
            if (at := place.get(name)) is not None
            else [None] * len(part)
            for name in columns
        }
        yield picked, len(part)


def _binary_files(spark: SparkSession, folder: str, recursive: bool) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter="*.xlsx", recursiveFileLookup=recursive)
        .load(folder)
        .withColumn("source_file", file_name())
    )


def list_provinces(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Sorted province names, from file names alone: no content is read."""
    files = _binary_files(spark, folder, recursive)
    return files.select(province_of_file(F.col("source_file")).alias("provincia")).orderBy("provincia")


def _layouts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found: list[tuple[int, str, int]] = []
        for file_name, content in zip(batch["source_file"], batch["content"]):
            try:
                found.extend(sheet_columns(content))
            except Exception as error:
                logging.getLogger("comarca").error("skipped %s: %s", file_name, error)
        yield pd.DataFrame(found, columns=["place", "name", "kind"])


def _found_columns(files: DataFrame) -> list[T.StructField]:
    """Columns of all workbooks: whole numbers, numbers, or text where any cell is text."""
    types = {_WHOLE: T.LongType(), _NUMBER: T.DoubleType()}
    layouts = files.select("source_file", "content").mapInPandas(_layouts, "place int, name string, kind int")
    # One row per column name, not per file.
    merged = layouts.groupBy("name").agg(F.min("place").alias("place"), F.max("kind").alias("kind"))
    rows = merged.orderBy("place", "name").collect()
    return [T.StructField(row["name"], types.get(row["kind"], T.StringType())) for row in rows]


def _typed(field: T.StructField) -> Column:
    cell = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType, T.NumericType):
        return coerce_number(cell, field.dataType.simpleString()).alias(field.name)
    return cell.try_cast(field.dataType).alias(field.name)


def read_folder(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType | None = None,
    declared_only: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """First sheet of every workbook, stacked by column name, plus file-name columns.

    Columns that ``schema`` does not name follow it, with the type their cells have;
    ``declared_only`` leaves them out and saves the look at the files. Repeated and
    blank headers keep their columns, see ``column_names``. A workbook that cannot be
    read to its end adds no rows: what is read of a sheet waits, beyond some megabytes in
    a file that goes with the task, until its end is reached. So each workbook is parsed
    once for its rows, and once before where column types are looked for. Subfolders are
    read only if ``recursive``.
    """
    if schema is None or isinstance(schema, T.StructType):
        declared = schema or T.StructType([])
    else:
        declared = spark.createDataFrame([], schema).schema
    files = None if missing_path(spark, folder) else _binary_files(spark, folder, recursive)
    found = [] if files is None or (declared_only and schema is not None) else _found_columns(files)
    taken = {*declared.names, "source_file"}
    struct = T.StructType([*declared, *(f for f in found if f.name not in taken)])
    if files is None:
        return with_file_columns(spark.createDataFrame([], struct.add("source_file", T.StringType())))
    columns = struct.names

    def read_sheets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file_name, content in zip(batch["source_file"], batch["content"]):
                with tempfile.SpooledTemporaryFile(_WAITING) as waiting:
                    try:
                        for part in picked_cells(content, columns):
                            pickle.dump(part, waiting)
                    except Exception as error:
                        logging.getLogger("comarca").error("skipped %s: %s", file_name, error)
                        continue
                    end = waiting.tell()
                    waiting.seek(0)
                    while waiting.tell() < end:
                        part, n = pickle.load(waiting)
                        yield pd.DataFrame({**part, "source_file": [file_name] * n}, dtype=object)

    text = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, "source_file"]])
    cells = files.select("source_file", "content").mapInPandas(read_sheets, text)
    return with_file_columns(cells.select(*[_typed(field) for field in struct], "source_file"))
