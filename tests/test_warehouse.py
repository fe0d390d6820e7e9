"""The derived warehouse builds what a query opens and stores only rows that were joined or grouped."""

from datetime import datetime

from checks import warehouse as derived
from vaultfeed.plans.parts import Parts

DAY = datetime(2000, 5, 1)


def _tables(spark, folder, orders=3):
    rows = {
        "customer": ([(1, "c1", 7, 10.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": (
            [(k, 1, "F", 300000.0 + k, DAY, "1-URGENT") for k in range(orders)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(k, 5, 6, n, 12.0, 100.0, 0.05, 0.01, "R", "O", DAY) for k in range(orders) for n in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_a_query_stores_only_joined_or_grouped_tables_that_it_opens(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derived, "_stored", {})
    folder = _tables(spark, tmp_path)
    tables = derived.warehouse(spark, folder)
    assert not derived._stored
    assert tables["sat_clm_tran_dtl"].count() == 6 and tables["lnk_clm_tran"].count() == 6
    assert {name for _, _, name in derived._stored} == {"base_plcy", "base_tran"}
    assert tables["lnk_plcy_cvrg"].count() == 6
    assert {name for _, _, name in derived._stored} == {"base_plcy", "base_tran", "base_cvrg"}


def test_a_small_given_table_is_dealt_to_all_cores(spark, tmp_path):
    orders = derived.given(spark, _tables(spark, tmp_path), "orders")
    spread = derived._spread(orders)
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert derived._spread(spread) is spread
    assert sorted(spread.collect()) == sorted(orders.collect())


def test_a_family_of_columns_reads_its_own_tables_only(spark):
    rows = {
        "lnk_plcy_lob": spark.createDataFrame([("pl", "p", "l")], "hash_plcy_lob_id string, hash_plcy_id string, hash_lob_id string"),
        "sat_plcy_lob_expsr": spark.createDataFrame(
            [("pl", "A", 1, "b", DAY), ("pl", None, 2, "c", DAY)],
            "hash_plcy_lob_id string, expsr_tp_cd string, expsr_amt int, expsr_base string, btch_dt timestamp",
        ),
    }
    parts = Parts(rows)
    wide = parts.lob_exposures()
    prefixes = "Line of Business Exposure Amount", "Line of Business Exposure Base"
    assert wide.columns == ["hash_plcy_id", "hash_lob_id", *(f"{p} - {t}" for p in prefixes for t in ("A", "NA"))]
    assert [tuple(r) for r in wide.collect()] == [("p", "l", 1, 2, "b", "c")]


def test_coverages_of_a_large_table_are_grouped_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derived, "_stored", {})
    monkeypatch.setattr(derived, "_is_large", lambda *_: True)
    folder = _tables(spark, tmp_path, orders=40)
    plain = sorted(map(tuple, derived.given(spark, folder, "lineitem").select("l_orderkey", "l_linenumber").collect()))
    assert derived.warehouse(spark, folder)["lnk_prem_tran"].count() == len(plain)
    grouped = derived._derived(spark, folder, "base_cvrg")
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    found = sorted((int(r["plcy"]), int(r["st"])) for r in derived.warehouse(spark, folder)["lnk_plcy_cvrg"].selectExpr("hash_plcy_id AS plcy", "st_prvnc_cd AS st").collect())
    assert found == plain
    # A query reads the files, not the buckets: its own joins and groups stay its own work.
    own = derived.warehouse(spark, folder)["lnk_prem_tran"].groupBy("hash_plcy_id").count()
    assert "Exchange" in own._jdf.queryExecution().executedPlan().toString()
