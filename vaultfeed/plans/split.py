"""Reading a warehouse once for several sources.

Each feed needs only the rows of its own policies, but most tables do not say whose policy a row
belongs to. Built one by one, six feeds scan and shuffle every large table six times. Here each
large table is joined once to the source of its policy and stored partitioned by source; every
feed then scans its own partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vaultfeed.functions.period import text_in_range
from vaultfeed.operators.joins import hot_keys, restrict_to, same, spread_join
from vaultfeed.operators.shape import union_by_name
from vaultfeed.plans.parts import Parts
from vaultfeed.plans.policy import FEEDS, Period, PolicyFeeds
from vaultfeed.sources.warehouse import Warehouse

# The key by which a table's rows are traced to their policy.
BY_POLICY = {
    name: "hash_plcy_id"
    for name in (
        "hub_plcy", "sat_plcy_dtl", "lnk_prem_tran", "lnk_plcy_cvrg", "lnk_plcy_prty_role",
        "lnk_plcy_cntct_pnt", "lnk_plcy_lob",
    )
}
BY_TRANSACTION = {name: "hash_prem_tran_id" for name in ("sat_prem", "sat_cmsn")}
BY_COVERAGE = {"sat_plcy_cvrg_dtl": "hash_plcy_cvrg_id"}

# The stored value has a letter in front, so that a code such as 0036 is not read back as a number.
_SOURCE = "owner_source"
_MARK = "s"


def _key(column: str) -> Column:
    """Null and '' together: every feed's own join decides which of the two it matches."""
    return F.coalesce(F.col(column), F.lit(""))


class SourceSplit:
    """Large tables of a warehouse stored by source below ``path``, a folder all executors share.

    With a period, only its premium is stored, and of the other tables only what belongs to policies
    that have premium in it: no feed of that period looks at anything else.
    """

    def __init__(
        self,
        spark: SparkSession,
        parts: Parts,
        path: str,
        sources: Sequence[str],
        period: Period | None = None,
    ):
        self.spark, self.parts, self.path = spark, parts, path.rstrip("/")
        self.sources, self.period = tuple(sources), period
        hub = parts["hub_plcy"].filter(F.col("rec_src_nm").isin(*self.sources))
        source = F.concat(F.lit(_MARK), "rec_src_nm").alias(_SOURCE)
        owners = hub.select(_key("hash_plcy_id").alias("_owned"), source).distinct()
        by_policy = dict(BY_POLICY)
        if period:
            link = "lnk_prem_tran"
            self._store(link, by_policy.pop(link), owners)
            paid = self._premium().select("hash_prem_tran_id")
            alive = restrict_to(self._stored(link), paid, same("hash_prem_tran_id"))
            alive = alive.select(_key("hash_plcy_id").alias("_alive")).distinct()
            owners = restrict_to(owners, alive, [("_owned", "_alive")])
        self._store_all(by_policy, owners)
        for tables, link, key in (
            (BY_TRANSACTION, "lnk_prem_tran", "hash_prem_tran_id"),
            (BY_COVERAGE, "lnk_plcy_cvrg", "hash_plcy_cvrg_id"),
        ):
            keyed = self._stored(link).select(_key(key).alias("_owned"), _SOURCE)
            self._store_all(tables, keyed.distinct())

    def _store_all(self, tables: dict[str, str], owners: DataFrame) -> None:
        with ThreadPoolExecutor(len(tables)) as pool:
            list(pool.map(lambda t: self._store(t, tables[t], owners), tables))

    def _premium(self) -> DataFrame:
        premium = self.parts["sat_prem"]
        if self.period:
            premium = premium.filter(text_in_range(F.col("acctg_yr_mo_txt"), *self.period))
        return premium

    def _store(self, name: str, key: str, owners: DataFrame) -> None:
        table = self._premium() if name == "sat_prem" else self.parts[name]
        table = table.withColumn("_key", _key(key))
        hot = hot_keys(table, {"key": ["_key"]}, self.parts.min_hot_rows)["key"]
        owned = spread_join(table, owners, [("_key", "_owned")], "inner", hot=hot).drop("_key")
        owned.write.partitionBy(_SOURCE).option("compression", "zstd").parquet(f"{self.path}/{name}")

    def _stored(self, name: str) -> DataFrame:
        # The schema is given, since a table without rows of these sources leaves no file to ask.
        schema = StructType([*self.parts[name].schema, StructField(_SOURCE, StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _of_source(self, name: str, source: str) -> DataFrame:
        if name in BY_POLICY or name in BY_TRANSACTION or name in BY_COVERAGE:
            return self._stored(name).filter(F.col(_SOURCE) == _MARK + source).drop(_SOURCE)
        return self.parts[name]

    def parts_of(self, source: str) -> Parts:
        """The side datasets of one source, over its own partition of the large tables."""
        names = tuple(self.parts.warehouse)
        own = Warehouse(lambda name: self._of_source(name, source), names)
        return self.parts.over(own)

    def feed(self, name: str, period: Period | None = None) -> DataFrame:
        """One feed, stored part by part below the path and at last whole: its shuffles end with each part."""
        path = f"{self.path}/feeds/{name}-{uuid.uuid4().hex}"
        return PolicyFeeds(self.parts_of(FEEDS[name].source), period, folder=lambda part: f"{path}/{part}").stored(name)


def combined_policies(
    spark: SparkSession,
    parts: Parts,
    path: str,
    period: Period | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """All rows of the named feeds (default: all), each large table read once."""
    names = list(names or FEEDS)
    with ThreadPoolExecutor() as pool:
        # Found before the feeds, which share them.
        found = [pool.submit(lambda: parts.types), pool.submit(parts.hot_roles)]
        for blank in {not FEEDS[n].null_safe for n in names}:
            found.append(pool.submit(parts.hot_transactions, blank))
        split = SourceSplit(spark, parts, path, [FEEDS[n].source for n in names], period)
        for each in found:
            each.result()
    # One after the other, so that the driver and the disk hold one part of one feed at a time.
    return union_by_name([split.feed(n, period) for n in names])
