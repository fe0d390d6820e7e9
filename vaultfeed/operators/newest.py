"""Newest row per key, first value per key, previous amounts and repeated keys.

None of these sends all rows of one key through one task: ranks are cut down before the shuffle,
first values are partial aggregates, and the walk from row to row works on slices of time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultfeed.operators.joins import ROWS_PER_TASK, Hot, hot_keys, same, spread_join

#: Sampled places for each part that a large slice is cut into.
_PLACES = 16


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``; null key members form a group of their own.

    The filter stands directly on the rank, so each task keeps one row per key before the shuffle.
    ``order`` should be total, or the choice among equal rows is open.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_then_filter(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Column
) -> DataFrame:
    """Rank first, filter after: a key whose newest row fails ``keep`` is lost."""
    return latest_per_key(df, keys, order).filter(keep)


def first_value_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    value: str,
    name: str,
    beside: Sequence[str] = (),
) -> DataFrame:
    """``value`` of the newest row of each key, null if that row holds null.

    With ``beside`` there is one row per key and distinct combination of those columns. Equal
    ``newest`` columns are settled by the larger value.
    """
    head = F.max(F.struct(*newest, F.col(value).alias("_value")))
    heads = df.groupBy(*keys, *beside).agg(head.alias("_head"))
    if beside:
        over_key = Window.partitionBy(*keys)
        heads = heads.withColumn("_head", F.max("_head").over(over_key))
    return heads.select(*keys, *beside, F.col("_head._value").alias(name))


def _cuts(df: DataFrame, group: Sequence[str], order: Column, rows_per_task: int) -> DataFrame:
    """For each group of well more than ``rows_per_task`` rows the places in ``order`` that cut it into such parts.

    The places come from one row in so many, taken by the hash of its group and order: the filter can go down to the
    scan, and a row is on the same side of them whenever it is read again. Where the cuts lie, not what comes out,
    depends on the rows taken.
    """
    apart = max(rows_per_task // _PLACES, 1)
    seen = df.select(*group, order.alias("_at")).where(F.pmod(F.xxhash64(*group, order), F.lit(apart)) == 0)
    places = seen.groupBy(*group).agg(F.sort_array(F.collect_list("_at")).alias("_all"))
    cuts = F.filter("_all", lambda _, i: i % _PLACES == _PLACES - 1)
    return places.where(F.size("_all") >= _PLACES).select(*group, cuts.alias("_cuts"))


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    value: str,
    name: str,
    slice_unit: str = "hour",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the ``value`` of the next older row of the same key.

    Rows are ordered inside one time slice of a key at a time, so a key that holds a large part
    of the table is spread over its slices; a slice of more than ``rows_per_task`` rows is cut
    further, at places in the order by ``time`` and ``tie``, even if all its rows have one time.
    The newest row of each part is a partial aggregate; only those few rows are walked across the
    whole key, to link one part to the next older one. Rows equal in time and tie, whose order is
    open, stay in one part.
    """
    order = F.struct(time, *tie)
    sliced = df.withColumn("_slice", F.date_trunc(slice_unit, F.col(time)))
    # Bounded: one place for each rows_per_task rows of the table, as good as exactly, and at most one row a place.
    cuts = F.broadcast(_cuts(sliced, [*keys, "_slice"], order, rows_per_task))
    sliced = spread_join(sliced, cuts, same(*keys, "_slice"), null_safe=True)
    newer = F.size(F.filter("_cuts", lambda place: place > order))
    sliced = sliced.withColumn("_part", F.when(F.col("_cuts").isNull(), 0).otherwise(newer)).drop("_cuts")
    group = [*keys, "_slice", "_part"]
    inside = Window.partitionBy(*group).orderBy(*newest_first(time, *tie))
    across = Window.partitionBy(*keys).orderBy(*newest_first("_slice"), F.col("_part"))
    head = F.max_by(F.struct(F.col(value).alias("v")), order)
    older = (
        sliced.groupBy(*group)
        .agg(head.alias("_head"))
        .withColumn("_older", F.lead("_head").over(across))
        .drop("_head")
    )
    linked = sliced.withColumn("_next", F.lead(F.struct(F.col(value).alias("v"))).over(inside))
    joined = spread_join(linked, older, same(*group), null_safe=True)
    found = F.coalesce(F.col("_next"), F.col("_older"))
    return joined.withColumn(name, found["v"]).drop("_slice", "_part", "_next", "_older")


def repeated_keys(
    df: DataFrame,
    keys: Sequence[str],
    count_name: str = "cnt",
    row_id: Sequence[str] = (),
    hot: Hot | None = None,
) -> DataFrame:
    """All rows whose key occurs more than once, with the count.

    Counts are partial aggregates joined back; keys that hold a large part of the rows are spread
    over several tasks by ``row_id`` (default: all columns).
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    if hot is None:
        hot = hot_keys(df, {"key": keys})["key"]
    return spread_join(
        df,
        counts.filter(F.col(count_name) > 1),
        [(k, k) for k in keys],
        how="inner",
        null_safe=True,
        hot=hot,
        row_id=row_id,
    )
