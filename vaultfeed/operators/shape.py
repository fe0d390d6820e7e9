"""Putting rows on a target schema: padding, union by name, file-safe column names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """One projection from output name to expression."""
    return df.select(*[expression.alias(name) for name, expression in columns.items()])


def pad_to_schema(df: DataFrame, target: Sequence[str], fill: str = "") -> DataFrame:
    """All target columns in order, the ones the frame lacks filled; its other columns follow."""
    have = set(df.columns)
    padded = [F.col(f"`{c}`") if c in have else F.lit(fill).alias(c) for c in target]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in set(target)]
    return df.select(*padded, *extra)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def file_name_of(column: str) -> str:
    """Drop the spaces, then turn every other run of signs into one underscore."""
    return re.sub(r"[^0-9a-zA-Z$]+", "_", column.replace(" ", ""))


def with_file_names(df: DataFrame) -> DataFrame:
    """File-safe column names; two names that become equal are an error, not a lost column."""
    names = [file_name_of(c) for c in df.columns]
    doubled = sorted({n for n in names if names.count(n) > 1})
    if doubled:
        raise ValueError(f"column names collide after cleaning: {doubled}")
    return df.toDF(*names)
