"""Delimited text files: one file, or a folder whose files may differ in header."""

from __future__ import annotations

import csv
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.operators.combine import union_by_name
from comarca.sources.files import file_name, missing_path, readable_path

SEPARATOR = ";"
log = logging.getLogger("comarca")


def _as_struct(spark: SparkSession, schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema


def with_source_file(df: DataFrame) -> DataFrame:
    """Adds the name of the file each row was read from."""
    return df.withColumn("source_file", file_name())


def csv_options(separator: str = SEPARATOR, multi_line: bool = False) -> dict:
    """Ordinary CSV with doubled quotes; ``multi_line`` allows line breaks inside quotes.

    A file with such line breaks can't be split, so it is read by one task.
    """
    return {"sep": separator, "header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "multiLine": multi_line}


def _cells(text: DataFrame, struct: T.StructType, rejected: str | None) -> DataFrame:
    """Declared columns that a table of texts has, of their types, then its others as text.

    With ``rejected`` a column of that name lists the cells that hold something but are no
    value of their column's type, as (column, text).
    """
    types = {f.name: f.dataType for f in struct}

    def value(name: str) -> Column:
        kind = types.get(name, T.StringType())
        cell = F.col(f"`{name}`")
        return (cell if isinstance(kind, T.StringType) else cell.try_cast(kind)).alias(name)

    present = [c for c in struct.names if c in text.columns]
    cells = [value(c) for c in present]
    others = [F.col(f"`{c}`") for c in text.columns if c not in types]
    if rejected:
        lost = [
            F.when(
                (F.trim(F.col(f"`{c}`")) != "") & value(c).isNull(),
                F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("text")),
            )
            for c in present if not isinstance(types[c], T.StringType)
        ]
        found = F.array_compact(F.array(*lost)) if lost else F.array().cast(_REJECTED)
        others.append(found.cast(_REJECTED).alias(rejected))
    return text.select(*cells, *others)


_REJECTED = "array<struct<column:string,text:string>>"


def rejected_cells(rows: DataFrame, rejected: str) -> DataFrame:
    """``(source_file, column, text)`` of every cell that was filled but did not parse.

    Rows that were written with their ``rejected`` column, as a run stages them, give their
    cells from that copy, so the text files are parsed once for both.
    """
    return rows.select("source_file", F.explode(rejected).alias("cell")).select("source_file", "cell.*")


def _empty(spark: SparkSession, struct: T.StructType, rejected: str | None) -> DataFrame:
    rows = spark.createDataFrame([], T.StructType([*struct, T.StructField("source_file", T.StringType())]))
    return rows.withColumn(rejected, F.array().cast(_REJECTED)) if rejected else rows


def read_file(spark: SparkSession, path: str, schema: str | T.StructType, separator: str = SEPARATOR,
              multi_line: bool = False, rejected: str | None = None) -> DataFrame:
    """One delimited file, or an empty table of the same shape where it does not exist.

    Columns are matched by their names in the header: those the file lacks are NULL,
    those ``schema`` does not name follow as text. ``rejected`` names a column for the
    cells that did not parse.
    """
    struct = _as_struct(spark, schema)
    if missing_path(spark, path):
        return _empty(spark, struct, rejected)
    # Every column is text by default, and the header is all that is read for that.
    text = spark.read.options(**csv_options(separator, multi_line)).csv(path)
    return with_columns_of(_cells(with_source_file(text), struct, rejected), struct)


def with_columns_of(rows: DataFrame, struct: T.StructType) -> DataFrame:
    """The declared columns in front, NULL where ``rows`` has none, then the others."""
    declared = [F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in struct]
    return rows.select(*declared, *[F.col(f"`{c}`") for c in rows.columns if c not in struct.names])


def file_headers(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """``(file_path, header)`` of every file: its first line, looked for in its first block only."""
    lines = spark.read.option("pathGlobFilter", pattern).text(paths)
    first_blocks = lines.select("value", "_metadata.file_path", "_metadata.file_block_start").where("file_block_start = 0")
    numbered = first_blocks.select("file_path", "value", F.monotonically_increasing_id().alias("line"))
    return numbered.groupBy("file_path").agg(F.min_by("value", "line").alias("header"))


def _split_header(header: str, separator: str) -> list[str]:
    return next(csv.reader([header.lstrip("﻿")], delimiter=separator))


def _read_group(spark: SparkSession, columns: list[str], paths: list[str], separator: str, multi_line: bool,
                extra: Sequence[str] = (), **options) -> DataFrame:
    """Files of one header as text, ``extra`` columns behind those of the header."""
    layout = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *extra]])
    reader = spark.read.schema(layout).options(**csv_options(separator, multi_line), **options)
    return reader.csv(paths)


def files_wider_than_their_header(spark: SparkSession, columns: list[str], paths: list[str], separator: str,
                                  multi_line: bool) -> set[str]:
    """Paths of files that hold a row with more fields than the header, as the parser sees rows."""
    # One column more than the header: a row of its length is short of it and so malformed, save
    # where a separator too many makes up for that; more fields than that leave it filled.
    rows = _read_group(
        spark, columns, paths, separator, multi_line, ["_beyond", "_malformed"],
        columnNameOfCorruptRecord="_malformed", columnPruning=False,
    )
    wide = rows.where("_beyond IS NOT NULL OR _malformed IS NULL").select(F.col("_metadata.file_path").alias("path")).distinct()
    return {row.path for row in wide.collect()}


def read_paths(spark: SparkSession, headers: Mapping[str, str], schema: str | T.StructType, separator: str = SEPARATOR,
               skip_bad_files: bool = True, multi_line: bool = False, rejected: str | None = None) -> DataFrame:
    """Given files, by the header line of each, stacked by column name.

    One reading per distinct header; with ``skip_bad_files`` one more that looks for rows
    too wide for it, whose files add no rows at all.
    """
    struct = _as_struct(spark, schema)
    layouts: dict[str, list[str]] = {}
    for path, header in sorted(headers.items()):
        layouts.setdefault(header, []).append(path)
    groups = []
    for header, paths in sorted(layouts.items()):
        columns, bad = _split_header(header, separator), set()
        if skip_bad_files:
            bad = files_wider_than_their_header(spark, columns, [readable_path(p) for p in paths], separator, multi_line)
            for path in sorted(bad):
                log.error("skipped %s: a row has more fields than the header", path)
        kept = [readable_path(p) for p in paths if p not in bad]
        if kept:
            groups.append(_cells(with_source_file(_read_group(spark, columns, kept, separator, multi_line)), struct, rejected))
    if not groups:
        return _empty(spark, struct, rejected)
    stacked = union_by_name(groups)
    found = [c for c in struct.names if c in stacked.columns]
    return stacked.select(*found, *[F.col(f"`{c}`") for c in stacked.columns if c not in found])


def read_folder(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    separator: str = SEPARATOR,
    pattern: str = "*.csv",
    same_headers: bool = False,
    skip_bad_files: bool = True,
    multi_line: bool = False,
    rejected: str | None = None,
) -> DataFrame:
    """All files of a folder, stacked by column name.

    Spark applies one header to all files by position, so files are first grouped
    by header line and each group is read on its own; ``same_headers`` saves that
    look at the files where the writer guarantees the columns of ``schema`` in its
    order, and a file that has others fails. Column types come from ``schema``; columns
    it does not name are read as text, and columns a file lacks are NULL. With
    ``skip_bad_files`` a file that holds a row with more fields than its header adds no
    rows at all. ``rejected`` names a column for the cells that did not parse.
    """
    struct = _as_struct(spark, schema)
    if missing_path(spark, folder):
        return _empty(spark, struct, rejected)
    if same_headers and not skip_bad_files:
        text = _read_group(spark, struct.names, [folder], separator, multi_line, pathGlobFilter=pattern, enforceSchema=False)
        return _cells(with_source_file(text), struct, rejected)
    # One row per file, as many as Spark lists on the driver for the scan itself.
    headers = {row.file_path: row.header for row in file_headers(spark, folder, pattern).collect()}
    return read_paths(spark, headers, struct, separator, skip_bad_files, multi_line, rejected)
