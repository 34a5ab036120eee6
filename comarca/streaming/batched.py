"""A folder of delimited files read a fixed number of files at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from comarca.sources.delimited import SEPARATOR, csv_options, file_headers, read_paths, with_columns_of, with_source_file
from comarca.sources.files import missing_path, readable_path

FILES_PER_BATCH = 10
_FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_folder(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    files_per_batch: int = FILES_PER_BATCH,
    separator: str = SEPARATOR,
) -> DataFrame:
    """Files of one layout; a file whose header differs from ``schema`` fails instead of swapping columns."""
    reader = spark.readStream.schema(schema).options(
        **csv_options(separator), pathGlobFilter="*.csv", maxFilesPerTrigger=files_per_batch, enforceSchema=False
    )
    return with_source_file(reader.csv(folder))


def stream_files(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH, pattern: str = "*.csv") -> DataFrame:
    """The paths of a folder's files, ``files_per_batch`` at a time; what is in them is not read."""
    files = spark.readStream.format("binaryFile").schema(_FILES)
    return files.options(pathGlobFilter=pattern, maxFilesPerTrigger=files_per_batch).load(folder).select("path", "length")


class Ledger:
    """Batches of files in a folder of Parquet: each in a folder of its own, and the record of those that are done.

    A batch that is handed in again is left out if it is on record, else what a failure left
    of it is written over; so it adds nothing twice. Files on record under another number,
    as after a lost checkpoint, are left out too. Readers see recorded batches only.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self) -> DataFrame:
        """``(batch, file, rows)`` of every file of every batch that is done; ``rows`` is the batch's number."""
        schema = "batch long, file string, rows long"
        if missing_path(self.spark, f"{self.path}/ledger"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/ledger/*")

    def add(self, batch: int, files: DataFrame, read: Callable[[list[str]], DataFrame]) -> None:
        """Writes what ``read`` makes of the batch's new files, then records them."""
        record = self.record()
        if not record.where(F.col("batch") == batch).isEmpty():
            return
        # As many as a batch may have.
        new = [row.path for row in files.join(record, F.col("path") == F.col("file"), "left_anti").select("path").collect()]
        rows = 0
        if new:
            read(new).write.mode("overwrite").parquet(self._folder(batch))
            rows = self.spark.read.parquet(self._folder(batch)).count()
        done = self.spark.createDataFrame([(batch, path, rows) for path in new or [None]], "batch long, file string, rows long")
        # One file, so that a record is there as a whole or not at all.
        done.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/batch={batch}")

    def rows(self, schema: T.StructType) -> DataFrame:
        """The rows of all batches that are done, by column name."""
        done = self.record().where("file IS NOT NULL").select("batch").distinct().collect()
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._folder(row.batch) for row in done])

    def _folder(self, batch: int) -> str:
        return f"{self.path}/rows/batch={batch}"


def drain_by_name(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    out: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
    separator: str = SEPARATOR,
    skip_bad_files: bool = True,
    multi_line: bool = False,
    rejected: str | None = None,
) -> DataFrame:
    """Reads all files present now, batch by batch, columns matched by the header of each file.

    Reordered columns are put in place and missing ones are NULL. Columns that ``schema``
    does not name have no place in one table of all batches and are left out. Run again
    with the same ``out`` and ``checkpoint`` to add new files. Returns the rows so far.
    """
    struct = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    ledger = Ledger(spark, out)
    names = [*struct.names, "source_file", *([rejected] if rejected else [])]

    def read(paths: list[str]) -> DataFrame:
        headers = {r.file_path: r.header for r in file_headers(spark, [readable_path(p) for p in paths], "*").collect()}
        rows = read_paths(spark, headers, struct, separator, skip_bad_files, multi_line, rejected)
        return with_columns_of(rows, struct).select(*names)

    files = stream_files(spark, folder, files_per_batch)
    drain_batches(files, lambda batch, number: ledger.add(number, batch.select("path"), read), checkpoint)
    return ledger.rows(read_paths(spark, {}, struct, rejected=rejected).select(*names).schema)


def drain_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes all files present now and stops; rerun with the same checkpoint to add new ones."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drain_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hands each batch to ``handle(batch, batch_id)`` until the folder is read."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
