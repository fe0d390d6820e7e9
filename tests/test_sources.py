import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vaultfeed.sources import (
    TABLES,
    Warehouse,
    append_audit,
    current_rows,
    json_lookup,
    read_csv,
    scratch_path,
    write_csv,
    write_envelopes,
    write_json_lines,
)


def test_current_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "2020-01-01")], "i int, LD_END_DT string")
    assert [r["i"] for r in current_rows(df).collect()] == [1]
    assert current_rows(df.drop("LD_END_DT")).count() == 2


def test_warehouse_from_files_and_catalog(spark):
    root = scratch_path(spark, "warehouse")
    df = spark.createDataFrame([("p1", None), ("p2", "x")], "XX_HASH_PLCY_ID string, LD_END_DT string")
    df.write.parquet(f"{root}/ADV_DB/hub_plcy")
    stored = Warehouse.load(spark, root, "adv_db", prefix="XX_")
    assert len(stored) == len(TABLES) == 36
    assert rows(stored["HUB_PLCY"].select("hash_plcy_id")) == [("p1",)]
    assert "PushedFilters: [IsNull(LD_END_DT)]" in (
        stored["hub_plcy"]._jdf.queryExecution().executedPlan().toString()
    )
    stored.register_views(("hub_plcy",))
    assert spark.sql("select count(*) from HUB_PLCY").first()[0] == 1
    with pytest.raises(KeyError):
        stored["no_such_table"]
    given = Warehouse.frames({"HUB_PLCY": df}, prefix="xx_")
    assert given["hub_plcy"].columns == ["hash_plcy_id", "ld_end_dt"]


def test_prefix_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "XX_A int, A int")
    with pytest.raises(ValueError, match="collide"):
        Warehouse.frames({"T": df}, prefix="XX_")["t"]


def test_json_lookup(spark):
    cells = [
        ("k", '[{"code":"a","name":"A b"},{"code":"b"}]'), ("one", ' {"code":"c","name":"C"} '),
        ("bad", "not json"), ("none", None),
    ]
    df = spark.createDataFrame(cells, "data_key_id string, data_val string")
    look = lambda key: rows(json_lookup(df, key, "code string, name string"))
    assert look("k") == [("a", "A b"), ("b", None)]
    assert look("one") == [("c", "C")]
    assert look("none") == look("absent") == []
    with pytest.raises(Exception, match="(?i)malformed|unrecognized token"):  # not an empty list
        look("bad")


ROWS = [(1, 'quote " and, comma'), (2, "line\nbreak"), (3, None), (4, "")]


def test_csv(spark):
    df = spark.createDataFrame(ROWS, "i int, t string")
    path = scratch_path(spark, "csv")
    write_csv(df, path)
    assert rows(read_csv(spark, path, "i int, t string")) == [
        (1, 'quote " and, comma'), (2, "line\nbreak"), (3, None), (4, None),
    ]
    assert dict(read_csv(spark, path).dtypes) == {"i": "string", "t": "string"}


def test_json_lines_keep_nulls(spark):
    path = scratch_path(spark, "json")
    write_json_lines(spark.createDataFrame(ROWS, "i int, t string"), path)
    records = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert sorted((r["i"], r["t"]) for r in records if r["t"]) == [ROWS[0], ROWS[1]]
    assert {"i": 3, "t": None} in records


def test_envelopes_hold_each_record_once(spark):
    stored, path = scratch_path(spark, "stored"), scratch_path(spark, "envelopes")
    df = spark.range(95, numPartitions=3).select("id", F.lit("a b").alias("t"))
    df.write.parquet(stored)
    write_envelopes(spark.read.parquet(stored), path, rows_per_document=10)
    documents = [json.loads(r["value"])["ISO"] for r in spark.read.text(path).collect()]
    assert max(map(len, documents)) <= 10
    assert sorted(r["id"] for d in documents for r in d) == list(range(95))
    assert documents[0][0]["t"] == "a b"


def test_audit_appends(spark):
    path = scratch_path(spark, "audit")
    for _ in range(2):
        append_audit(spark.createDataFrame([(1,)], "row_count int"), path)
    assert spark.read.parquet(path).count() == 2
