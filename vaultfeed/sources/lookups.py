"""Code lists that are stored as JSON text in a table cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_lookup(
    df: DataFrame,
    key: str,
    fields: str,
    key_column: str = "data_key_id",
    text_column: str = "data_val",
) -> DataFrame:
    """Rows of the code list stored under ``key``, decoded on the executors.

    ``fields`` is a DDL field list such as ``"Code string, Name string"``. The cell may hold an
    array of objects or a single object. Text that is not JSON is an error when the list is read: it
    would otherwise leave every row undecoded. A null cell holds no rows.
    """
    decoded = F.from_json(F.trim(text_column), f"array<struct<{fields}>>", {"mode": "FAILFAST"})
    return df.filter(F.col(key_column) == key).select(F.inline(decoded))


def json_number(text: Column, field: str) -> Column:
    """One whole-number field of a JSON object held as text."""
    return F.from_json(text, f"{field} bigint")[field]
