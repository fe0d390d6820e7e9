"""Long attribute tables (key, type, value) to one wide row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_TYPE = "NA"

# Up to this many cells one conditional aggregate each: a single shuffle on the key. Beyond it the
# two-step pivot, which shuffles twice but looks at each row once.
_FEW_CELLS = 48


def distinct_types(df: DataFrame, type_column: str, at_most: int = 1_000) -> list[str]:
    """Sorted distinct types, null as ``NA``. Types become columns, so too many is an error."""
    types = df.select(F.coalesce(F.col(type_column), F.lit(NULL_TYPE)).alias("t")).distinct()
    found = [row["t"] for row in types.limit(at_most + 1).collect()]
    if len(found) > at_most:
        raise ValueError(f"{type_column} has more than {at_most} types; name the ones to widen")
    return sorted(found)


def widen(
    df: DataFrame,
    keys: Sequence[str],
    type_column: str,
    measures: Mapping[str, str],
    types: Sequence[str] | None = None,
    newest: Sequence[str] = (),
) -> DataFrame:
    """One column ``<prefix> - <type>`` per measure and type, all measures in one pass.

    ``measures`` maps a prefix to its value column. A cell holds the newest value that is not
    null, by the ``newest`` columns and then by value.
    """
    if types is None:
        types = distinct_types(df, type_column)
    kind = F.coalesce(F.col(type_column), F.lit(NULL_TYPE))

    def newest_value(value: str, condition: Column) -> Column:
        order = F.struct(*newest, F.col(value).alias("_v"))
        return F.max_by(F.col(value), F.when(condition & F.col(value).isNotNull(), order))

    cells = [(prefix, value, t) for prefix, value in measures.items() for t in types]
    if len(cells) <= _FEW_CELLS:
        return df.groupBy(*keys).agg(
            *[newest_value(v, kind == t).alias(f"{prefix} - {t}") for prefix, v, t in cells]
        )
    each = [newest_value(v, F.lit(True)).alias(f"m{i}") for i, v in enumerate(measures.values())]
    wide = df.withColumn(type_column, kind).groupBy(*keys).pivot(type_column, list(types)).agg(*each)
    named = wide.toDF(*keys, *[f"{prefix} - {t}" for t in types for prefix in measures])
    return named.select(*keys, *[F.col(f"`{prefix} - {t}`") for prefix, _, t in cells])


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]
