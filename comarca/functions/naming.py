"""Column-name rules. Names are plan metadata, so no job runs here."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame


def plain_name(name: str) -> str:
    """Accent-free lower-case name made of letters, digits and underscores."""
    ascii_name = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode("ascii")
    return re.sub(r"[^a-z0-9_]", "", ascii_name.lower().strip().replace(" ", "_"))


def unique_names(names: list[str]) -> list[str]:
    """Numbers repeated names, because Spark cannot resolve an ambiguous column."""
    taken = set(names)
    seen: set[str] = set()
    result = []
    for name in names:
        candidate, n = name, 1
        while candidate in seen or (n > 1 and candidate in taken):
            n += 1
            candidate = f"{name}_{n}"
        seen.add(candidate)
        result.append(candidate)
    return result


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names([plain_name(c) for c in df.columns]))


def warehouse_names(df: DataFrame) -> DataFrame:
    """Upper-case names with spaces and dots turned into underscores."""
    return df.toDF(*unique_names([re.sub(r"[ .]", "_", c.upper()) for c in df.columns]))
