"""Properties of whole feeds that do not need a second engine."""

import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks import feeds
from checks.warehouse import warehouse
from vaultfeed import __main__ as job
from vaultfeed.operators.quality import Watch, run_audit
from vaultfeed.plans import columns, extract
from vaultfeed.plans.claims import BRANCHES, ClaimFeeds, claim_slice
from vaultfeed.plans.parts import FAMILIES, Parts
from vaultfeed.plans.policy import FEEDS, PolicyFeeds
from vaultfeed.plans.split import SourceSplit
from vaultfeed.sources import Warehouse, read_csv, scratch_path


@pytest.fixture(scope="module")
def parts(spark, sf):
    return feeds.parts(spark, sf)


def salted(df):
    return "_salt" in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["gain", "arrowhead"])
def test_spread_feed_is_the_same_feed(spark, sf, parts, name):
    spread = PolicyFeeds(Parts(warehouse(spark, sf), min_hot_rows=1)).build(name)
    plain = PolicyFeeds(parts).build(name)
    assert (salted(spread), salted(plain)) == (True, False)
    assert rows(spread) == rows(plain)


def test_schema_starts_with_the_business_columns(parts):
    built = PolicyFeeds(parts).build("xm")
    assert tuple(built.columns[:67]) == columns.POLICY_COLUMNS
    assert built.columns[67] == "Risk State Code"
    assert ClaimFeeds(parts, (1999, 12), (2000, 12)).build("juris").columns == list(
        columns.CLAIM_COLUMNS
    )


@pytest.mark.parametrize("name", ["gain", "majesco"])
def test_side_datasets_do_not_change_the_premium_total(parts, name):
    """Holds where every side dataset has one row per key; insurer names may have several."""
    policy_feeds = PolicyFeeds(parts)
    total = lambda df, c: df.agg(F.sum(F.col(f"`{c}`"))).first()[0]
    core = policy_feeds.core(FEEDS[name])
    feed = policy_feeds.build(name)
    assert total(core, "prm_chgd_prem_amt") == total(feed, "Changed Premium Amount") > 0


def test_one_row_per_policy_and_reference(parts):
    feed = FEEDS["xm"]
    rows_ = PolicyFeeds(parts).assemble(feed).select("txn_hash_plcy_id", "txn_ref_id")
    assert rows_.count() == rows_.distinct().count() > 0


def test_named_types_need_no_look_at_the_data(spark, sf):
    named = dict.fromkeys(FAMILIES, ["Aggregate"])
    built = PolicyFeeds(Parts(warehouse(spark, sf), types=named)).build("prwins")
    assert [c for c in built.columns if c.startswith(columns.POLICY_LIMIT)] == [
        "Policy Limit Amount - Aggregate"
    ]


def test_flags_only_on_request(parts):
    build = PolicyFeeds(parts).build
    assert "EPLI" not in build("gain").columns
    assert "EPLI" in build("gain", flags=True).columns


def test_claim_slices_are_parts_of_the_whole(parts):
    claims = ClaimFeeds(parts, (1999, 12), (2000, 12)).union(["center", "juris"])
    whole = claims.count()
    kept = claim_slice(claims, (1999, 12), (2000, 11)).count()
    assert 0 < kept < whole
    assert claim_slice(claims, (1999, 12), (2000, 12)).count() == whole


def test_branch_tag_tells_reserves_from_claims(parts):
    union = ClaimFeeds(parts, (1999, 12), (2000, 12)).union(branch_column="Branch")
    counts = {r["Branch"]: r["count"] for r in union.groupBy("Branch").count().collect()}
    assert set(counts) == set(BRANCHES)


def test_run_writes_every_output_once(spark, parts):
    out = scratch_path(spark, "run")
    written = extract.run(
        spark, parts, out, months=36, batch_date="20010101", source="Majesco",
        formats=("csv", "json", "envelope"),
    )
    assert list(written) == ["policies"]
    stored = spark.read.parquet(f"{written['policies']}/parquet")
    count = stored.count()
    assert count == PolicyFeeds(parts, feeds.PERIOD).build("majesco").count() > 0
    assert read_csv(spark, f"{written['policies']}/csv").count() == count
    assert spark.read.json(f"{written['policies']}/json").count() == count
    documents = spark.read.text(f"{written['policies']}/envelope").collect()
    assert sum(len(json.loads(d["value"])["ISO"]) for d in documents) == count
    audit = spark.read.parquet(f"{out}/audit/policies").collect()
    assert [(r["SourceSystemCode"], r["row_count"]) for r in audit] == [("109", count)]
    claims = extract.run(spark, parts, out, 13, "20010101", "DYESL Claim")
    assert list(claims) == ["claims", "claims_center", "claims_last_year", "claims_without_last_month"]


def test_a_repeated_run_replaces_its_output_and_audit(spark, parts):
    out = scratch_path(spark, "run")
    for _ in range(2):
        written = extract.run(spark, parts, out, 3, "20010101", "Arrowhead", formats=("csv",))
    count = spark.read.parquet(f"{written['policies']}/parquet").count()
    audit = spark.read.parquet(f"{out}/audit/policies").collect()
    assert [(r["row_count"], r["status"]) for r in audit] == [(count, "written" if count else "empty")]


def test_empty_and_failed_runs_are_audited(spark, parts, monkeypatch):
    out = scratch_path(spark, "run")
    extract.run(spark, parts, out, 3, "19010101", "Arrowhead", formats=())
    assert [r["status"] for r in spark.read.parquet(f"{out}/audit/policies").collect()] == ["empty"]

    def broken(*_):
        raise RuntimeError("no such table")

    monkeypatch.setattr(extract, "export", broken)
    with pytest.raises(RuntimeError):
        extract.run(spark, parts, out, 3, "20010101", "Juris")
    failed = spark.read.parquet(f"{out}/audit/claims").first()
    assert (failed["status"], failed["message"]) == ("failed", "no such table")


def test_a_failed_rerun_leaves_the_earlier_extract_whole(spark, parts, monkeypatch):
    out = scratch_path(spark, "run")
    again = lambda: extract.run(spark, parts, out, 36, "20010101", "Majesco", formats=("csv", "json"))
    written = again()
    before = rows(spark.read.json(f"{written['policies']}/json"))

    def full(*_, **__):
        raise OSError("no space left")

    with monkeypatch.context() as patch:
        patch.setattr(extract, "write_json_lines", full)
        with pytest.raises(OSError, match="no space"):
            again()
    assert rows(spark.read.json(f"{written['policies']}/json")) == before != []
    assert [r["status"] for r in spark.read.parquet(f"{out}/audit/policies").collect()] == ["failed"]
    assert sorted(os.listdir(out)) == ["Majesco_20010101_36", "audit"]
    # A run that died between its two moves is mended by the next one.
    folder = written["policies"].removesuffix("/policies")
    os.rename(folder, f"{folder}.previous")
    again()
    assert rows(spark.read.json(f"{written['policies']}/json")) == before
    assert sorted(os.listdir(out)) == ["Majesco_20010101_36", "audit"]


def test_a_watched_write_equals_the_audit_query(spark, parts):
    feed = PolicyFeeds(parts, feeds.PERIOD).union(["majesco", "prwins"])
    named = "Changed Premium Amount", "Transaction Date"
    watch = Watch("Source System Code", ["109", "217", "none"], *named)
    stored = extract.export(feed, scratch_path(spark, "watched"), (), None)
    watch.over(feed).write.format("noop").mode("overwrite").save()
    found = {r[0]: (r[1], r[2], str(r[3])) for r in watch.audit(feed, "d").collect()}
    query = run_audit(stored, ["SourceSystemCode"], "ChangedPremiumAmount", "TransactionDate", "d")
    assert found.pop("none") == (0, None, "None")
    assert found == {r[0]: (r[1], r[2], str(r[3])) for r in query.collect()} and len(found) == 2
    watch = Watch("Source System Code", ["109"], *named)
    watch.over(feed).write.format("noop").mode("overwrite").save()
    assert {r[0] for r in watch.audit(feed, "d").collect()} == {"109", None}


def test_planted_repeats_name_their_join(spark, parts):
    """Rows that are written twice into a side table are found as the culprit of each transaction they multiply."""
    feed, before = FEEDS["prwins"], PolicyFeeds(parts).accounts(FEEDS["prwins"])
    clean = {r[0] for r in before.filter("feed_rows = 1").collect()}
    tables = {name: parts[name] for name in parts.warehouse}
    for table, tag in (("sat_ins_obj_prop", "prop"), ("sat_cvrg_dtl", "cvg"), ("sat_plcy_dtl", "pol"), ("sat_prem", "prm")):
        planted = parts.over(Warehouse.frames({**tables, table: tables[table].union(tables[table])}))
        found = PolicyFeeds(planted).accounts(feed).filter("feed_rows > 1").collect()
        named = {r["culprits"] for r in found if r[0] in clean}
        assert named == {tag}, table
        assert all(r["base_rows"] == (2 if tag == "prm" else 1) and r["feed_rows"] == 2 for r in found if r[0] in clean)


def test_the_job(spark, parts, capsys):
    root, out = scratch_path(spark, "lake"), scratch_path(spark, "run")
    for name in parts.warehouse:
        parts[name].write.parquet(f"{root}/ADV_DB/{name}")
    written = job.main(["--root", root, "--out", out, "--months", "36", "--batch-date", "20010101", "--source", "XM", "--formats", "csv"])
    assert capsys.readouterr().out == f"policies\t{written['policies']}\n"
    count = spark.read.parquet(f"{written['policies']}/parquet").count()
    assert count == PolicyFeeds(parts, feeds.PERIOD).build("xm").count() > 0
    with pytest.raises(SystemExit):
        job.arguments(["--root", root])


def test_run_rejects_unknown_source_and_date(spark, parts):
    for source, batch in (("Nobody", "20010101"), ("Gain", "2001")):
        with pytest.raises(ValueError):
            extract.run(spark, parts, scratch_path(spark, "run"), 3, batch, source)


def test_split_keeps_codes_and_rows(spark, parts):
    hub = spark.createDataFrame(
        [("a", "007"), ("b", "7"), (None, "7")], "hash_plcy_id string, rec_src_nm string"
    )
    link = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("x", 5)], "k string, i int")
    tables = {name: parts[name] for name in parts.warehouse}
    tables["hub_plcy"] = hub
    tables["lnk_plcy_lob"] = link.select(
        F.col("k").alias("hash_plcy_id"), F.col("i").alias("hash_plcy_lob_id")
    )
    small = parts.over(Warehouse.frames(tables))
    split = SourceSplit(spark, small, scratch_path(spark, "split"), ["007", "7"])
    own = lambda s: sorted(r[1] for r in split.parts_of(s)["lnk_plcy_lob"].collect())
    assert (own("007"), own("7")) == ([1], [2, 3, 4])
