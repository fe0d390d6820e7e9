"""Compare a Spark result with the checking engine's, row by row and regardless of order."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tables that the checks can read.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, days and timestamps as text, so that both engines hand over plain values."""
    columns = []
    for f in df.schema.fields:
        kind, column = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            column = column.cast("string")  # a timestamp with its time of day
        elif kind in ("tinyint", "smallint", "int"):
            column = column.cast("bigint")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir.rstrip('/')}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        text = value.isoformat(" ")
        return text.rstrip("0").rstrip(".") if value.microsecond else text
    if isinstance(value, date):
        return value.isoformat()
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, show: int = 3) -> list[str]:
    """What differs; empty if the results are equal."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        ours, theirs = set(df.columns), set(relation.columns)
        return [f"columns only in Spark {ours - theirs}, only in SQL {theirs - ours}"]
    spark_rows = _rows(df.columns, df.collect())
    sql_rows = _rows(relation.columns, relation.fetchall())
    if spark_rows == sql_rows:
        return []
    names = sorted(df.columns)
    found = [f"{sum(spark_rows.values())} rows in Spark, {sum(sql_rows.values())} in SQL"]
    for label, extra in (("Spark", spark_rows - sql_rows), ("SQL", sql_rows - spark_rows)):
        found.append(f"only in {label}: {sum(extra.values())}")
        found += [str(dict(zip(names, r, strict=True))) for r in sorted(extra, key=str)[:show]]
    return found
