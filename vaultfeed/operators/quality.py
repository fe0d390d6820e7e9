"""Checks on a finished feed: row counts against its parts, sums, and the audit of a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vaultfeed.operators.shape import union_by_name


def reconcile(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each named stage, to compare a feed with the joins it is built on."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, df in stages.items()
    ]
    return union_by_name(counts)


def run_audit(
    df: DataFrame, by: Sequence[str], amount: str, newest: str, batch_date: str | None = None
) -> DataFrame:
    """Rows, amount total and newest date of each feed, ready to append to the audit table."""
    audit = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col(amount).cast("decimal(18,2)")).alias("total_amount"),
        F.max(newest).alias("newest_date"),
    )
    return audit.withColumn("batch_date", F.lit(batch_date)) if batch_date else audit


class Watch:
    """Rows, amount total and newest date of each feed, taken while its rows are written.

    The measures are observed metrics of the write itself, so no row is read again. They are exact also when executors
    are lost: the tasks that write count once, which tasks before a shuffle would not. Only the given feeds are told
    apart; rows of any other are counted together under null.
    """

    def __init__(self, by: str, feeds: Sequence[str], amount: str, newest: str):
        self.by, self.feeds, self.amount, self.newest = by, tuple(feeds), amount, newest
        self._seen: Observation | None = None

    def over(self, df: DataFrame) -> DataFrame:
        """The same rows, to be written once."""
        self._seen = Observation()
        name, value, day = F.col(f"`{self.by}`"), F.col(f"`{self.amount}`").cast("decimal(18,2)"), F.to_date(f"`{self.newest}`")
        measures = []
        for k, feed in enumerate((*self.feeds, None)):
            own = name == feed if feed is not None else ~F.coalesce(name.isin(*self.feeds), F.lit(False))
            measures += [F.count_if(own).alias(f"rows{k}"), F.sum(F.when(own, value)).alias(f"total{k}"), F.max(F.when(own, day)).alias(f"newest{k}")]
        return df.observe(self._seen, *measures)

    def audit(self, df: DataFrame, batch_date: str) -> DataFrame:
        """One row per feed, also for one without rows, and one for rows of other feeds if there are any."""
        seen = self._seen.get
        rows = [(f, *(seen[f"{m}{k}"] for m in ("rows", "total", "newest")), batch_date) for k, f in enumerate((*self.feeds, None))]
        schema = f"`{self.by}` string, row_count long, total_amount decimal(28,2), newest_date date, batch_date string"
        return df.sparkSession.createDataFrame([r for r in rows if r[0] is not None or r[1]], schema)
