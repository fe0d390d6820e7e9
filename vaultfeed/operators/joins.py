"""Equi-joins under three null policies, with hot keys spread over several tasks.

plain       a null key matches nothing
null-safe   a null key matches a null key
blank       null and '' are the same key
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Pairs = Sequence[tuple[str, str]]


def same(*names: str) -> list[tuple[str, str]]:
    return [(n, n) for n in names]


#: Spark's own Bloom filters, built from the filtered side of a join and tried on the other before its shuffle. By default
#: they start at a scan of 10 GB and a filtered side below 10 MB; here at any scan worth it, whatever the filtered side
#: holds. A filter has 8 MB however large that side is: with three bits a key, as for 16 million keys, it lets 2 per cent of
#: the other rows pass at 7 million keys and a quarter at 22 million; with 12 bits, as for 4 million, 2 and 90 per cent.
_PRUNING = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "16000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "16000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    "spark.sql.optimizer.runtimeFilter.number.threshold": "30",
}


def prune_before_shuffles(spark: SparkSession) -> None:
    """Joins of this session leave rows that cannot match out before they shuffle them; the result is the same.

    Values that the session already has are kept.
    """
    for name, value in _PRUNING.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


_BITS, _ITEMS = (f"spark.sql.optimizer.runtime.bloomFilter.{n}" for n in ("numBits", "expectedNumItems"))
#: Bits of a filter for each key, and fewest bits.
_BITS_PER_KEY, _LEAST_BITS = 8, 1 << 20
_sizing = RLock()


@contextmanager
def filters_for(spark: SparkSession, keys: int) -> Iterator[None]:
    """What runs inside has Bloom filters of a size for so many keys, where that is less than the session's.

    Eight bits and four places a key let 2 per cent of the other rows pass. Each filter goes through the driver, which
    holds several copies, so a filter of few keys is not to have the size for many.
    """
    least = max(_LEAST_BITS, _BITS_PER_KEY * keys)
    with _sizing:
        before = {n: spark.conf.get(n, None) for n in (_BITS, _ITEMS)}
        if before[_BITS] is None or least >= int(before[_BITS]):
            yield
            return
        spark.conf.set(_BITS, str(least))
        spark.conf.set(_ITEMS, str(least * 2 // 11))  # of which Spark makes four places: bits / items * ln 2, rounded
        try:
            yield
        finally:
            for name, value in before.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Rows that may well be broadcast, whatever their number of columns.
BROADCAST_ROWS = 100_000


def not_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """A stored table, never broadcast if it has many rows: Spark judges it by its files, which hold many times their size."""
    return df if rows <= BROADCAST_ROWS else df.hint("merge")


#: Rows of one key that one task may well work on; a key with more is spread over several.
ROWS_PER_TASK = 1_000_000

#: Hash of a hot key -> over how many tasks it is spread.
Hot = Mapping[int, int]


def hot_keys(
    df: DataFrame,
    key_sets: Mapping[str, Sequence[str]],
    rows_per_task: int = ROWS_PER_TASK,
    buckets: int = 1 << 15,
) -> dict[str, dict[int, int]]:
    """The keys that hold more than ``rows_per_task`` rows, exactly, for each set of key columns.

    What counts as hot does not depend on the size of the table, and a key is spread over as many tasks as its rows ask
    for. First rows are counted per bucket of hashed keys, which a task sends at most ``buckets`` sums of. Only rows of
    buckets that are above the limit in all are then counted per key. In a table of n rows there are at most
    n / rows_per_task such buckets, and such keys, for each set; no more than these reach the driver. With 32,768 buckets
    an ordinary one stays below a million rows up to 3e10 rows of the table; above, more keys are counted exactly.
    """
    names = list(key_sets)
    found: dict[str, dict[int, int]] = {name: {} for name in names}
    if not names:
        return found
    each = [
        F.struct(F.lit(i).alias("set"), F.xxhash64(*key_sets[n]).alias("key")) for i, n in enumerate(names)
    ]
    keys = df.select(F.inline(F.array(*each))).withColumn("bucket", F.pmod("key", F.lit(buckets)))
    above = F.col("count") > rows_per_task
    full = keys.groupBy("set", "bucket").count().filter(above).select("set", "bucket").collect()
    if full:
        # Bounded, see above: 12 bytes for each rows_per_task rows of the table.
        heavy = F.broadcast(df.sparkSession.createDataFrame(full, "set int, bucket long"))
        counts = keys.join(heavy, ["set", "bucket"], "left_semi").groupBy("set", "key").count()
        for r in counts.filter(above).collect():
            found[names[r["set"]]][r["key"]] = math.ceil(r["count"] / rows_per_task)
    return found


def _salted(keys: Sequence[Column], hot: Hot, row_id: Sequence[str] | None) -> Column:
    """0 for ordinary keys; for hot ones the number of a row, or all numbers if there is no row id."""
    key = F.xxhash64(*keys)
    table = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    salts = F.element_at(table, key)
    if row_id:
        number = F.pmod(F.xxhash64(*row_id), salts).cast("int")
        return F.when(key.isin(*hot), number).otherwise(0)
    numbers = F.sequence(F.lit(0), salts - 1)
    return F.explode(F.when(key.isin(*hot), numbers).otherwise(F.array(F.lit(0))))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Pairs,
    how: str = "left",
    null_safe: bool = False,
    hot: Hot | None = None,
    row_id: Sequence[str] = (),
    keep_keys: bool = False,
    hot_on: Sequence[str] = (),
) -> DataFrame:
    """Join on pairs of columns; the result has the columns of ``left``, then the rest of ``right``.

    ``keep_keys`` also keeps the key columns of ``right``, whose names must then differ; a long
    chain of joins is analysed faster so.

    Rows of ``left`` with a hot key get a number from the hash of ``row_id`` (default: all columns),
    and only the matching rows of ``right`` are repeated per number, so a key with a third of all
    rows is worked on by many tasks. The result is the same. ``hot_on`` names the left columns
    that ``hot`` was found for, if they are not all key columns.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"only left and inner joins can be spread, got {how!r}")
    renamed = {r: r if keep_keys else f"_right_{i}" for i, (_, r) in enumerate(on)}
    if not keep_keys:
        right = right.withColumnsRenamed(renamed)
    left_keys = [F.col(l) for l, _ in on]
    right_keys = [F.col(renamed[r]) for _, r in on]
    helpers = [] if keep_keys else list(renamed.values())
    terms = [
        l.eqNullSafe(r) if null_safe else l == r for l, r in zip(left_keys, right_keys, strict=True)
    ]
    if hot:
        where = [i for i, (l, _) in enumerate(on) if not hot_on or l in hot_on]
        left = left.withColumn(
            "_salt", _salted([left_keys[i] for i in where], hot, row_id or left.columns)
        )
        right = right.withColumn("_right_salt", _salted([right_keys[i] for i in where], hot, None))
        terms.append(F.col("_salt") == F.col("_right_salt"))
        helpers += ["_salt", "_right_salt"]
    joined = left.join(right, reduce(lambda a, b: a & b, terms), how)
    return joined.drop(*helpers) if helpers else joined


def null_safe_join(left: DataFrame, right: DataFrame, on: Pairs, how: str = "left", **spread):
    return spread_join(left, right, on, how, null_safe=True, **spread)


def blank_filled(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null text becomes ''; other types keep their nulls."""
    return df.na.fill("", subset=list(columns) if columns else None)


def blank_join(left: DataFrame, right: DataFrame, on: Pairs, how: str = "left", **spread):
    """Join with '' for null on both sides; the keys come out filled."""
    return spread_join(
        blank_filled(left, [l for l, _ in on]),
        blank_filled(right, [r for _, r in on]),
        on,
        how,
        **spread,
    )


def lookup_join(
    df: DataFrame,
    codes: DataFrame,
    on: Pairs,
    how: str = "left",
    broadcast_rows: int = 100_000,
    null_safe: bool = False,
    hot: Hot | None = None,
    row_id: Sequence[str] = (),
    keep_keys: bool = False,
) -> DataFrame:
    """Decode through a code list: broadcast if the list is counted small, else a spread join."""
    small = codes.limit(broadcast_rows + 1).count() <= broadcast_rows
    if small:
        codes = F.broadcast(codes)
        hot = None
    return spread_join(df, codes, on, how, null_safe, hot, row_id, keep_keys=keep_keys)


def restrict_to(
    df: DataFrame,
    keys: DataFrame,
    on: Pairs,
    null_safe: bool = False,
    hot: Hot | None = None,
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``; never multiplies rows. Hot keys as in spread_join."""
    renamed = {r: f"_right_{i}" for i, (_, r) in enumerate(on)}
    right = keys.select(*[F.col(r).alias(n) for r, n in renamed.items()])
    terms: list[Column] = [
        F.col(l).eqNullSafe(F.col(renamed[r])) if null_safe else F.col(l) == F.col(renamed[r])
        for l, r in on
    ]
    if hot:
        df = df.withColumn("_salt", _salted([F.col(l) for l, _ in on], hot, row_id or df.columns))
        right = right.withColumn("_right_salt", _salted([F.col(c) for c in renamed.values()], hot, None))
        terms.append(F.col("_salt") == F.col("_right_salt"))
    kept = df.join(right, reduce(lambda a, b: a & b, terms), "left_semi")
    return kept.drop("_salt") if hot else kept
