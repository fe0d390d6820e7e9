"""Joins leave rows that cannot match out before they shuffle them."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import feeds
from vaultfeed.functions.period import months_between
from vaultfeed.operators import joins
from vaultfeed.plans import split
from vaultfeed.plans.claims import ClaimFeeds
from vaultfeed.plans.parts import Parts
from vaultfeed.plans.policy import FEEDS, PolicyFeeds

SCAN = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"


@pytest.fixture
def settings(spark):
    """A session without the settings, whose tables are too large to broadcast; as before afterwards."""
    names = [*joins._PRUNING, "spark.sql.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.unset(n)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def _links(spark, folder):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 100 < 3, "a").otherwise("b").alias("source"))
    rows.write.parquet(f"{folder}/links")
    rows.select("id", F.length("id").alias("amount")).write.parquet(f"{folder}/amounts")
    link = spark.read.parquet(f"{folder}/links").filter("source = 'a'")
    return joins.spread_join(link, spark.read.parquet(f"{folder}/amounts"), joins.same("id"))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_join_tries_the_keys_of_its_filtered_side_before_the_shuffle(spark, tmp_path, settings):
    joined = _links(spark, tmp_path)
    plain = sorted(tuple(r) for r in joined.collect())
    assert "might_contain" not in _plan(joined)
    spark.conf.set(SCAN, "1b")
    joins.prune_before_shuffles(spark)
    again = joined.select("*")
    assert "might_contain" in _plan(again)
    assert sorted(tuple(r) for r in again.collect()) == plain and len(plain) == 60


def test_values_of_the_session_are_kept(spark, settings):
    spark.conf.set(SCAN, "5GB")
    joins.prune_before_shuffles(spark)
    assert spark.conf.get(SCAN) == "5GB"
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits") == "67108864"


def test_the_warehouse_queries_ask_for_it(spark, sf, settings, monkeypatch):
    monkeypatch.setattr(feeds, "_parts", {})
    feeds.parts(spark, sf)
    assert spark.conf.get(SCAN) == "64MB"


def test_coverages_of_some_products_are_cut_to_the_source_before_the_shuffle(spark, tmp_path, settings):
    def kept(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    ids, feed = [*map(str, range(400)), None, None], FEEDS["majesco"]
    tables = {
        "hub_plcy": kept("hub", [(i, "109" if k % 40 < 2 or i is None else "61") for k, i in enumerate(ids)], "hash_plcy_id string, rec_src_nm string"),
        "sat_plcy_dtl": kept("detail", [(i, "BO" if k % 40 or i is None else "WC") for k, i in enumerate(ids)], "hash_plcy_id string, prod_cd string"),
    }
    link = kept("link", [(f"c{k}", i) for k, i in enumerate([*ids, "61", "1"])], "hash_plcy_cvrg_id string, hash_plcy_id string")
    spark.conf.set(SCAN, "1b")
    joins.prune_before_shuffles(spark)
    own = PolicyFeeds(Parts(tables))._of_own(link, feed)
    plan = _plan(own).split("Relation [hash_plcy_cvrg_id")[0]
    assert "might_contain" in plan and "rec_src_nm" in plan
    wanted = {*(str(k) for k in range(400) if k % 40 == 1), None}
    assert sorted(r[0] for r in own.collect()) == sorted(f"c{k}" for k, i in enumerate([*ids, "61", "1"]) if i in wanted)


def test_a_run_of_months_of_computed_years_is_tried_on_the_other_side(spark, tmp_path, settings):
    shown, year, month = F.col("id") % 3 > 0, F.lit(1990) + F.col("id") % 20, F.lit(1) + F.col("id") % 12
    rows = spark.range(2000).select("id", shown.alias("shown"), year.cast("int").alias("y"), month.cast("int").alias("m"))
    rows.write.parquet(f"{tmp_path}/details")
    rows.select("id", F.col("id").cast("string").alias("claim")).write.parquet(f"{tmp_path}/claims")
    details = spark.read.parquet(f"{tmp_path}/details").select("id", F.when(F.col("shown"), F.col("y")).alias("y"), "m")
    spark.conf.set(SCAN, "1b")
    joins.prune_before_shuffles(spark)
    wanted = details.filter(months_between(F.col("y"), F.col("m"), (1999, 12), (2000, 11)))
    joined = joins.spread_join(spark.read.parquet(f"{tmp_path}/claims"), wanted, joins.same("id"), "inner")
    assert "might_contain" in _plan(joined)

    def inside(k):
        return k % 3 > 0 and (1999, 12) <= (1990 + k % 20, 1 + k % 12) <= (2000, 11)

    assert sorted(r["id"] for r in joined.collect()) == [k for k in range(2000) if inside(k)]


def test_transactions_of_a_branch_are_cut_to_the_claims_of_its_source(spark, sf, settings):
    spark.conf.set(SCAN, "1b")
    parts = feeds.parts(spark, sf)
    joins.prune_before_shuffles(spark)
    plan = _plan(ClaimFeeds(parts, (1999, 12), (2000, 12)).build("esl_reserve"))
    keys = re.findall(r"Relation \[id#\d+,(plcy#\d+)", plan)
    filters = [line for line in plan.splitlines() if "might_contain" in line]
    assert any(f"concat(K, {k})" in f for f in filters for k in keys)


def _own_feeds(spark, sf, folder, period=None, trace=False):
    names = iter(range(9))
    feeds_of = PolicyFeeds(feeds.parts(spark, sf), period, trace=trace, folder=lambda table: f"{folder}/{table}-{next(names)}")
    spark.conf.set(SCAN, "1b")
    joins.prune_before_shuffles(spark)
    return feeds_of


@pytest.mark.parametrize("name, trace", [("arrowhead", True), ("gain", False)])
def test_tables_that_do_not_name_their_source_are_cut_to_the_rows_of_the_feed(spark, sf, tmp_path, settings, name, trace):
    feed, own = FEEDS[name], _own_feeds(spark, sf, tmp_path, trace=trace)
    premium = _plan(own.transactions(feed))
    assert re.search(r"might_contain.*xxhash64\(id#", premium)  # sat_prem, before its shuffle
    details = _plan(own.coverages(feed))
    assert re.search(r"might_contain.*xxhash64\(pc#", details)  # sat_plcy_cvrg_dtl
    hub = feeds.parts(spark, sf)["hub_plcy"].filter(F.col("rec_src_nm") == feed.source)
    link = feeds.parts(spark, sf)["lnk_prem_tran"].filter(F.col("tran_tp_cd").isin(*feed.types))
    wanted = link.join(hub, "hash_plcy_id", "left_semi").select("hash_prem_tran_id")
    stored = spark.read.parquet(f"{tmp_path}/transactions-0").select("txn_hash_prem_tran_id")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, wanted.collect()))


def test_a_feed_has_the_same_rows_with_and_without_a_folder(spark, sf, tmp_path, settings, name="majesco"):
    stored = _own_feeds(spark, sf, tmp_path, feeds.PERIOD)
    plain = PolicyFeeds(feeds.parts(spark, sf), feeds.PERIOD).build(name)
    again = stored.build(name)
    assert stored._stored and again.columns == plain.columns
    assert sorted(map(str, again.collect())) == sorted(map(str, plain.collect()))
    before = len(stored._stored)
    stored.build(name)
    assert len(stored._stored) == before  # stored once


def test_a_source_without_rows_can_be_stored(spark, sf, tmp_path, settings):
    feed = replace(FEEDS["arrowhead"], source="none")
    assert _own_feeds(spark, sf, tmp_path).transactions(feed).count() == 0


@pytest.mark.parametrize("name, trace", [("esl", False), ("prwins", True), ("majesco", True)])
def test_the_queries_of_a_feed_hold_few_filters_each(spark, sf, tmp_path, settings, monkeypatch, name, trace):
    feed, seen, kept = FEEDS[name], {}, PolicyFeeds._kept

    def counted(self, part, feed, df, tried=True, of=""):
        seen[part] = _plan(df).count("might_contain")
        return kept(self, part, feed, df, tried, of)

    monkeypatch.setattr(PolicyFeeds, "_kept", counted)
    own = replace(_own_feeds(spark, sf, tmp_path, feeds.PERIOD, trace), folder=lambda part: f"{tmp_path}/{part}")
    seen["feed"] = _plan(own.assemble(feed)).count("might_contain")
    assert seen["feed"] == 0 and seen["measured"] and seen["covered"]
    assert max(seen.values()) <= 12, seen  # each passes through the driver, 8 MB in several copies


@pytest.mark.parametrize("name", ["arrowhead", "majesco"])
def test_the_core_has_the_same_rows_with_and_without_a_folder(spark, sf, tmp_path, settings, name):
    stored = _own_feeds(spark, sf, tmp_path, feeds.PERIOD)
    core = stored.core(FEEDS[name])
    plain = PolicyFeeds(feeds.parts(spark, sf), feeds.PERIOD).core(FEEDS[name]).select(*core.columns)
    assert sorted(map(str, core.collect())) == sorted(map(str, plain.collect()))
    assert "might_contain" not in _plan(core)


def test_a_stored_part_may_have_columns_of_any_name_and_is_not_broadcast_if_long(spark, tmp_path, settings, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 50)
    names = iter(range(9))
    hub = spark.createDataFrame([("1", "61")], "hash_plcy_id string, rec_src_nm string")
    own = PolicyFeeds(Parts({"hub_plcy": hub}), folder=lambda table: f"{tmp_path}/{table}-{next(names)}")
    wide = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("a - ,;{}()=\t.b/c"))
    part = own._kept("wide", FEEDS["esl"], wide, tried=False)
    assert part.columns == wide.columns and sorted(part.collect()) == sorted(wide.collect())
    left = spark.range(100).select(F.col("id").cast("string").alias("k"))
    few = own._kept("few", FEEDS["esl"], wide.limit(50), tried=False)

    def broadcasts(right):
        joined = left.join(right, "k", "left")
        return "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()

    assert broadcasts(few) and not broadcasts(part)


def test_filters_have_the_size_for_their_keys(spark, settings):
    joins.prune_before_shuffles(spark)
    bits, items = joins._BITS, joins._ITEMS
    before = spark.conf.get(bits), spark.conf.get(items)
    with joins.filters_for(spark, 1_000_000):
        assert spark.conf.get(bits) == "8000000" and round(8e6 / int(spark.conf.get(items)) * 0.6931) == 4
    with joins.filters_for(spark, 10**9):
        assert (spark.conf.get(bits), spark.conf.get(items)) == before
    assert (spark.conf.get(bits), spark.conf.get(items)) == before


def test_a_part_is_stored_with_filters_for_its_keys(spark, sf, tmp_path, settings, monkeypatch):
    asked, filters_for = [], joins.filters_for
    monkeypatch.setattr(joins, "filters_for", lambda s, keys: asked.append(keys) or filters_for(s, keys))
    own, feed = _own_feeds(spark, sf, tmp_path, feeds.PERIOD), FEEDS["esl"]
    policies = feeds.parts(spark, sf)["hub_plcy"].filter(F.col("rec_src_nm") == feed.source).count()
    links = own._kept("measured", feed, own.transactions(feed), False, "transactions")
    wanted = own.transactions(feed).select("txn_hash_prem_tran_id").count()
    assert asked == [policies, spark.read.parquet(f"{tmp_path}/transactions-0").count()]
    assert links.count() == wanted


def test_united_feeds_are_joined_one_by_one_before_they_meet(spark, sf, tmp_path, settings):
    united = split.combined_policies(spark, feeds.parts(spark, sf), f"{tmp_path}/by-source", feeds.PERIOD, ["esl", "prwins"])
    plan = _plan(united)
    assert "Join" not in plan and "Aggregate" not in plan and "Union" in plan
    plain = PolicyFeeds(feeds.parts(spark, sf), feeds.PERIOD).union(["esl", "prwins"])
    assert united.columns == plain.columns
    assert sorted(map(str, united.collect())) == sorted(map(str, plain.collect()))
