"""File exports to any path Spark can write to.

Every export is a folder of part files, written in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame

# Ordinary CSV: quotes are doubled, an empty text is quoted and NULL is nothing, blanks stay.
CSV_OPTIONS = {
    "header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "emptyValue": '""', "nullValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
_STAMP = "%Y%m%d_%H%M%S"


def write(df: DataFrame, path: str, kind: str) -> str:
    if kind == "parquet":
        df.write.parquet(path)
    elif kind in ("json", "jsonl"):
        df.write.option("ignoreNullFields", False).json(path)
    elif kind == "csv":
        df.write.options(**CSV_OPTIONS).csv(path)
    else:
        raise ValueError(f"unsupported format: {kind}")
    return path


def export_object(df: DataFrame, base: str, table: str, kind: str = "jsonl", at: datetime | None = None) -> str:
    """``<base>/data/<table>/<stamp>.<ext>``; kinds other than jsonl and parquet are written as CSV."""
    kind = kind if kind in ("jsonl", "parquet") else "csv"
    return write(df, f"{base}/data/{table}/{(at or datetime.now()).strftime(_STAMP)}.{kind}", kind)


def export_file(df: DataFrame, base: str, table: str, kind: str = "parquet", at: datetime | None = None) -> str:
    """``<base>/<table>_<stamp>.<ext>``; JSON is written as one object per line."""
    if kind not in ("parquet", "csv", "json"):
        raise ValueError(f"unsupported format: {kind}")
    return write(df, f"{base}/{table}_{(at or datetime.now()).strftime(_STAMP)}.{kind}", kind)


def export_csv(df: DataFrame, path: str) -> str:
    """A query result as CSV with a header and no index."""
    return write(df, path, "csv")


def export_summaries(summaries: Mapping[str, DataFrame], base: str, kind: str = "csv") -> dict[str, str]:
    """Several summaries below one folder, each a dataset of its own."""
    return {name: write(df, f"{base}/{name}", kind) for name, df in summaries.items()}


def stage_parquet(df: DataFrame, path: str) -> DataFrame:
    """Writes an intermediate and hands on the written copy; its rows count from file footers."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
