"""One query per operator over the given tables, each beside the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feeds
from checks.compare import TABLES
from checks.warehouse import given, with_tables
from vaultfeed.functions import codes
from vaultfeed.functions.measures import commission_amount, commission_problem, money
from vaultfeed.functions.period import (
    accounting_range,
    months_between,
    text_in_range,
    with_period,
)
from vaultfeed.operators.joins import (
    blank_join,
    lookup_join,
    null_safe_join,
    restrict_to,
    same,
    spread_join,
)
from vaultfeed.operators.newest import (
    first_value_per_key,
    latest_per_key,
    latest_then_filter,
    newest_first,
    previous_value,
    repeated_keys,
)
from vaultfeed.operators.quality import reconcile
from vaultfeed.operators.shape import pad_to_schema, project, union_by_name
from vaultfeed.operators.widen import widen
from vaultfeed.sources import (
    Warehouse,
    current_rows,
    json_lookup,
    json_number,
    read_csv,
    scratch_path,
    write_csv,
    write_envelopes,
    write_json_lines,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str) -> Callable[[Query], Query]:
    """Register a query under its own name together with its SQL."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return register


# Sources and sinks.


@check(
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS stage, count(*) AS row_count FROM {t}" for t in TABLES
    )
)
def scan_table(spark, sf):
    return reconcile({t: given(spark, sf, t) for t in TABLES})


@check(
    """SELECT 'load' AS stage, n_nationkey AS k, n_name AS v FROM nation
UNION ALL SELECT 'catalog', r_regionkey, r_name FROM region
UNION ALL SELECT 'views', c_custkey, c_name FROM customer WHERE c_acctbal IS NOT NULL"""
)
def warehouse_sources(spark, sf):
    """A table from a stored schema, one from a catalog database and one through its SQL view."""
    root = scratch_path(spark, "lake")
    given(spark, sf, "nation").write.parquet(f"{root}/ADV_DB/nation")
    stored = Warehouse.load(spark, root, names=("nation",))["nation"]
    given(spark, sf, "region").createOrReplaceGlobalTempView("region")
    listed = Warehouse.catalog(spark, "global_temp", names=("region",))["region"]
    Warehouse.frames({"known_customer": given(spark, sf, "customer")}).register_views()
    viewed = spark.sql("SELECT c_custkey, c_name FROM known_customer WHERE c_acctbal IS NOT NULL")
    parts = (("load", stored, "n_nationkey", "n_name"), ("catalog", listed, "r_regionkey", "r_name"), ("views", viewed, "c_custkey", "c_name"))
    return union_by_name([d.select(F.lit(s).alias("stage"), F.col(k).alias("k"), F.col(v).alias("v")) for s, d, k, v in parts])


@check(
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE CASE WHEN o_orderstatus = 'F' THEN o_orderdate END IS NULL"""
)
def current_snapshot(spark, sf):
    ended = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    orders = given(spark, sf, "orders").withColumn("ld_end_dt", ended)
    return current_rows(orders).select("o_orderkey", "o_custkey", "o_orderstatus")


@check(
    """SELECT c_custkey, n_name AS description FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey + 5"""
)
def json_lookup_inline(spark, sf):
    listed = given(spark, sf, "nation")
    code = (F.col("n_nationkey") + 5).cast("string")  # moved, so that some customers find none
    entry = F.struct(code.alias("code"), F.col("n_name").alias("description"))
    cell = listed.agg(F.to_json(F.collect_list(entry)).alias("data_val"))
    stored = cell.withColumn("data_key_id", F.lit("NATIONS"))
    lookup = json_lookup(stored, "NATIONS", "code string, description string")
    customers = given(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("c_nation")
    )
    return lookup_join(customers, lookup, [("c_nation", "code")]).drop("c_nation")


@check(
    r"""SELECT CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
  count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY 1"""
)
def json_scalar_field(spark, sf):
    events = given(spark, sf, "events").select(
        json_number(F.col("props"), "k").alias("k"), money(F.col("value")).alias("value")
    )
    return events.groupBy("k").agg(
        F.count(F.lit(1)).alias("events"), F.sum("value").alias("total")
    )


@check(
    """SELECT count(*) AS documents, count(o_orderkey) AS records,
  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS missing,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders"""
)
def json_lines_roundtrip(spark, sf):
    orders = given(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("Priority Text"),
        money(F.col("o_totalprice")).alias("Total Price"),
    )
    path = scratch_path(spark, "json-lines")
    write_json_lines(orders, path)
    lines = spark.read.text(path)
    schema = "o_orderkey bigint, `Priority Text` string, `Total Price` decimal(18,2)"
    record = F.from_json("value", schema)
    null_written = F.col("value").contains('"Priority Text":null')
    return lines.select(record.alias("r"), null_written.cast("int").alias("null_written")).agg(
        F.count(F.lit(1)).alias("documents"),
        F.count("r.o_orderkey").alias("records"),
        F.sum("null_written").alias("missing"),
        F.sum("r.`Total Price`").alias("total"),
    )


@check(
    """SELECT o_orderkey, o_orderstatus AS "Order Status", nullif(o_orderpriority, '1-URGENT')
  AS "Priority Text", CAST(o_totalprice AS DOUBLE) AS "Total Price" FROM orders"""
)
def json_envelope(spark, sf):
    orders = given(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("Order Status"),
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("Priority Text"),
        money(F.col("o_totalprice")).alias("Total Price"),
    )
    stored, path = scratch_path(spark, "extract"), scratch_path(spark, "envelope")
    orders.write.parquet(stored)
    write_envelopes(spark.read.parquet(stored), path, rows_per_document=1_000)
    record = (
        "o_orderkey bigint, `Order Status` string, `Priority Text` string,"
        " `Total Price` decimal(18,2)"
    )
    document = F.from_json("value", f"ISO array<struct<{record}>>")
    return spark.read.text(path).select(F.inline(document["ISO"]))


@check(
    """SELECT o_orderstatus, count(*) AS row_count, count(nullif(o_orderpriority, '5-LOW'))
  AS with_priority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  CAST(max(o_orderdate) AS DATE)::VARCHAR AS newest
FROM orders GROUP BY o_orderstatus"""
)
def csv_roundtrip(spark, sf):
    orders = given(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .otherwise(F.concat(F.lit('"a", '), "o_orderpriority", F.lit("\n")))
        .alias("priority"),
        money(F.col("o_totalprice")).alias("total"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    path = scratch_path(spark, "csv")
    write_csv(orders, path)
    schema = "o_orderkey bigint, o_orderstatus string, priority string, total decimal(18,2), day date"
    back = read_csv(spark, path, schema)
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("priority").alias("with_priority"),
        F.sum("total").alias("total"),
        F.max("day").alias("newest"),
    )


# Projections and filters.


@check(
    """SELECT o_orderkey AS "Policy Number", c_name AS "Insured Name",
  c_mktsegment AS "Product Code", CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
  AS "Policy Effective Date", year(o_orderdate) AS "Underwriting Year"
FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def feed_projection(spark, sf):
    joined = spread_join(
        given(spark, sf, "orders"), given(spark, sf, "customer"), [("o_custkey", "c_custkey")],
        "inner",
    )
    return project(
        joined,
        {
            "Policy Number": F.col("o_orderkey"),
            "Insured Name": F.col("c_name"),
            "Product Code": F.col("c_mktsegment"),
            "Policy Effective Date": F.col("o_orderdate").cast("date"),
            "Underwriting Year": F.year("o_orderdate"),
        },
    )


@check(
    """SELECT c_name AS name, c_mktsegment AS segment, '' AS region, 'customer' AS kind FROM customer
UNION ALL
SELECT s_name, '', '', 'supplier' FROM supplier"""
)
def pad_to_target_schema(spark, sf):
    target = ("name", "segment", "region", "kind")
    customers = given(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("name"),
    )
    suppliers = given(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.lit("supplier").alias("kind")
    )
    return union_by_name([pad_to_schema(df, target) for df in (customers, suppliers)])


@check("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def filter_source(spark, sf):
    orders = given(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return orders.select("o_orderkey", "o_custkey")


@check("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'N')")
def filter_in_list(spark, sf):
    lines = given(spark, sf, "lineitem").filter(F.col("l_returnflag").isin("A", "N"))
    return lines.select("l_orderkey", "l_linenumber", "l_returnflag")


@check(
    """SELECT l_orderkey, l_partkey FROM lineitem
WHERE coalesce(nullif(l_returnflag, 'R'), 'N') = 'N'"""
)
def filter_default_flag(spark, sf):
    flag = F.nullif(F.col("l_returnflag"), F.lit("R"))
    lines = given(spark, sf, "lineitem").filter(F.coalesce(flag, F.lit("N")) == "N")
    return lines.select("l_orderkey", "l_partkey")


@check("SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = 'building'")
def filter_case_insensitive(spark, sf):
    customers = given(spark, sf, "customer").filter(F.lower("c_mktsegment") == "building")
    return customers.select("c_custkey", "c_mktsegment")


# Joins.


@check("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner_using(spark, sf):
    customers = given(spark, sf, "customer").select("c_custkey", "c_name")
    orders = given(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return spread_join(orders, customers, [("o_custkey", "c_custkey")], "inner").drop("o_custkey")


@check(
    """SELECT o_orderkey, l_linenumber, l_extendedprice
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"""
)
def join_left_using(spark, sf):
    lines = given(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = given(spark, sf, "orders").select("o_orderkey")
    return spread_join(orders, lines, [("o_orderkey", "l_orderkey")])


@check(
    """SELECT c_custkey, n_name FROM customer
JOIN nation ON nullif(c_nationkey, 3) IS NOT DISTINCT FROM nullif(n_nationkey, 3)"""
)
def join_null_safe_inner(spark, sf):
    nullable = lambda c: F.nullif(F.col(c), F.lit(3)).alias(c)
    customers = given(spark, sf, "customer").select("c_custkey", nullable("c_nationkey"))
    nations = given(spark, sf, "nation").select("n_name", nullable("n_nationkey"))
    pairs = [("c_nationkey", "n_nationkey")]
    return null_safe_join(customers, nations, pairs, "inner").drop("c_nationkey")


@check(
    """SELECT c_custkey, r.rich FROM customer LEFT JOIN (
  SELECT nullif(c_mktsegment, 'BUILDING') AS seg, nullif(c_nationkey, 0) + 3 AS nat, count(*) AS rich
  FROM customer GROUP BY 1, 2) r
ON nullif(c_mktsegment, 'BUILDING') IS NOT DISTINCT FROM r.seg
  AND nullif(c_nationkey, 0) IS NOT DISTINCT FROM r.nat"""
)
def join_null_safe_left(spark, sf):
    customers = given(spark, sf, "customer").select(
        "c_custkey", "c_acctbal",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("seg"),
        F.nullif(F.col("c_nationkey"), F.lit(0)).alias("nat"),
    )
    moved = customers.withColumn("nat", F.col("nat") + 3)
    rich = moved.groupBy("seg", "nat").agg(F.count(F.lit(1)).alias("rich"))
    return null_safe_join(customers, rich, same("seg", "nat")).select("c_custkey", "rich")


@check(
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(t.total AS DOUBLE) AS total
FROM lineitem l LEFT JOIN (
  SELECT l_orderkey, l_linenumber + 1 AS l_linenumber, nullif(l_returnflag, 'R') AS flag,
    sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total
  FROM lineitem GROUP BY 1, 2, 3) t
ON l.l_orderkey IS NOT DISTINCT FROM t.l_orderkey
  AND l.l_linenumber IS NOT DISTINCT FROM t.l_linenumber
  AND nullif(l.l_returnflag, 'R') IS NOT DISTINCT FROM t.flag"""
)
def join_null_safe_composite(spark, sf):
    lines = given(spark, sf, "lineitem").withColumn(
        "flag", F.nullif(F.col("l_returnflag"), F.lit("R"))
    )
    keys = ["l_orderkey", "l_linenumber", "flag"]
    moved = lines.withColumn("l_linenumber", F.col("l_linenumber") + 1)
    totals = moved.groupBy(*keys).agg(
        F.sum(money(F.col("l_extendedprice"))).alias("total")
    )
    detail = lines.select(*keys, "l_partkey")
    return null_safe_join(detail, totals, same(*keys)).drop("flag")


@check(
    """SELECT p.p_partkey, p.k, q.quantity FROM (
  SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN '' WHEN 'Brand#2' THEN '' ELSE p_brand END AS k
  FROM part) p
LEFT JOIN (SELECT CASE p_brand WHEN 'Brand#3' THEN '' WHEN 'Brand#4' THEN '' ELSE p_brand END AS k,
    sum(CAST(l_quantity AS BIGINT)) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) q ON p.k = q.k"""
)
def blank_fill_join(spark, sf):
    brand = F.col("p_brand")
    part = given(spark, sf, "part")
    left = part.select(
        "p_partkey", F.when(brand == "Brand#2", "").when(brand != "Brand#1", brand).alias("k")
    )
    per_part = given(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    coded = part.select(
        "p_partkey", F.when(brand == "Brand#4", "").when(brand != "Brand#3", brand).alias("k")
    )
    summed = spread_join(per_part, coded, [("l_partkey", "p_partkey")], "inner")
    right = F.coalesce("k", F.lit("")).alias("k")
    right = summed.groupBy(right).agg(F.sum("quantity").alias("quantity"))
    return blank_join(left, right, same("k"))


@check(
    """SELECT c_custkey, n_name, r_name FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey + 5
LEFT JOIN region ON n_regionkey = r_regionkey"""
)
def lookup_joins(spark, sf):
    customers = given(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = given(spark, sf, "nation").withColumn("n_nationkey", F.col("n_nationkey") + 5)
    named = lookup_join(customers, nations, [("c_nationkey", "n_nationkey")])
    named = lookup_join(named, given(spark, sf, "region"), [("n_regionkey", "r_regionkey")])
    return named.select("c_custkey", "n_name", "r_name")


@check(
    """SELECT p_brand, p_type, max(p_partkey) AS newest, count(*) AS parts FROM part
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey + 100 = p_partkey)
GROUP BY p_brand, p_type"""
)
def filter_by_link(spark, sf):
    linked = given(spark, sf, "lineitem").withColumn("l_partkey", F.col("l_partkey") + 100)
    parts = restrict_to(given(spark, sf, "part"), linked, [("p_partkey", "l_partkey")])
    return parts.groupBy("p_brand", "p_type").agg(
        F.max("p_partkey").alias("newest"), F.count(F.lit(1)).alias("parts")
    )


@check(
    """SELECT o_orderkey, l_partkey, l_returnflag FROM orders
LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'"""
)
def left_join_right_filter(spark, sf):
    lines = given(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    lines = lines.select("l_orderkey", "l_partkey", "l_returnflag")
    orders = given(spark, sf, "orders").select("o_orderkey")
    return spread_join(orders, lines, [("o_orderkey", "l_orderkey")], "inner")


@check(
    """SELECT c_name, o_orderkey FROM (
  SELECT c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(substring(c_name, 10) AS BIGINT) END
    AS k FROM customer)
LEFT JOIN orders ON o_custkey = k"""
)
def join_cast_key(spark, sf):
    padded = F.concat(F.lit(" "), F.substring("c_name", 10, 20))
    text = F.when(F.col("c_mktsegment") == "BUILDING", "A12").otherwise(padded)
    customers = given(spark, sf, "customer").select("c_name", codes.join_number(text).alias("k"))
    orders = given(spark, sf, "orders").select(F.col("o_custkey").cast("int"), "o_orderkey")
    return spread_join(customers, orders, [("k", "o_custkey")]).drop("k")


@check(
    """SELECT r_name, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
  AS total
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"""
)
def join_chain_4hop(spark, sf):
    per_supplier = given(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(money(F.col("l_extendedprice"))).alias("total")
    )
    chain = spread_join(per_supplier, given(spark, sf, "supplier"), [("l_suppkey", "s_suppkey")])
    chain = spread_join(chain, given(spark, sf, "nation"), [("s_nationkey", "n_nationkey")])
    chain = spread_join(chain, given(spark, sf, "region"), [("n_regionkey", "r_regionkey")])
    return chain.groupBy("r_name").agg(
        F.sum("lines").alias("lines"), F.sum("total").alias("total")
    )


# Aggregation and widening.


@check("SELECT DISTINCT event_type FROM events")
def pivot_values(spark, sf):
    return given(spark, sf, "events").select("event_type").distinct()


_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@check(
    "SELECT user_id, "
    + ", ".join(
        f"""arg_max(value, event_id) FILTER (WHERE event_type = '{t}' AND value > 5)
  AS "Value - {t}\""""
        for t in _EVENT_TYPES
    )
    + " FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS n FROM events)"
    + " GROUP BY user_id"
)
def pivot_first_nonnull(spark, sf):
    events = given(spark, sf, "events").withColumn(
        "value", F.when(F.col("value") > 5, F.col("value"))
    )
    measures = {"Value": "value"}
    return widen(events, ["user_id"], "event_type", measures, _EVENT_TYPES, ["ts", "event_id"])


_FLAGS = ("A", "N", "R")


def _newest_line(value: str, condition: str) -> str:
    order = "{'a': l_shipdate, 'b': l_partkey, 'c': l_suppkey, 'd': l_linenumber, 'v': " + value + "}"
    return f"(max({order}) FILTER (WHERE {condition})).v"


@check(
    "SELECT l_orderkey, "
    + ", ".join(
        f"""{_newest_line(v, f"l_returnflag = '{t}'")} AS "{p} - {t}\""""
        for p, v in (("Quantity", "l_quantity"), ("Price", "l_extendedprice"))
        for t in _FLAGS
    )
    + " FROM lineitem GROUP BY l_orderkey"
)
def pivot_two_measures_join(spark, sf):
    return widen(
        given(spark, sf, "lineitem"),
        ["l_orderkey"],
        "l_returnflag",
        {"Quantity": "l_quantity", "Price": "l_extendedprice"},
        newest=["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"],
    )


@check(
    "SELECT l_orderkey, "
    + ", ".join(
        f"""{_newest_line("l_discount", f"coalesce(nullif(l_returnflag, 'R'), 'NA') = '{t}'")}
  AS "Rate - {t}\""""
        for t in ("A", "N", "NA")
    )
    + " FROM lineitem GROUP BY l_orderkey"
)
def pivot_null_bucket(spark, sf):
    lines = given(spark, sf, "lineitem").withColumn(
        "type", F.nullif(F.col("l_returnflag"), F.lit("R"))
    )
    newest = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"]
    return widen(lines, ["l_orderkey"], "type", {"Rate": "l_discount"}, newest=newest)


@check(
    f"""SELECT o_orderkey, o_custkey, m.* EXCLUDE (l_orderkey) FROM orders LEFT JOIN (
  SELECT l_orderkey, {", ".join(
        f'''{_newest_line("l_discount", f"l_returnflag = '{t}'")} AS "Modifier - {t}"'''
        for t in _FLAGS
    )} FROM lineitem GROUP BY l_orderkey) m ON o_orderkey = l_orderkey"""
)
def schedule_modifier_attach(spark, sf):
    newest = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = given(spark, sf, "lineitem")
    wide = widen(lines, ["l_orderkey"], "l_returnflag", {"Modifier": "l_discount"}, newest=newest)
    orders = given(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return spread_join(orders, wide, [("o_orderkey", "l_orderkey")])


@check("SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf):
    return given(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct()


@check(
    with_tables(
        """SELECT hash_plcy_id, rf, CAST(rev AS BIGINT) AS endrsmt_revsn_nbr, acctg_yr_mo_txt,
  CAST(cmsn_pct AS DOUBLE) AS cmsn_pct, CAST(cmsn_amt AS DOUBLE) AS net_cmsn_amt FROM """
        + feeds.NET_COMMISSION
    )
)
def commission_net_sum(spark, sf):
    return feeds.parts(spark, sf).net_commission("109")


@check(
    with_tables(
        """SELECT hash_plcy_id, rf, CAST(rev AS BIGINT) AS endrsmt_revsn_nbr, acctg_yr_mo_txt,
  CAST(pct AS DOUBLE) AS cmsn_pct_calculated FROM """
        + feeds.COMMISSION_PERCENT
    )
)
def ratio_two_stage(spark, sf):
    return feeds.parts(spark, sf).commission_percent("109")


# Newest rows and windows.


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
_LINE_COLUMNS = _LINE.split(", ")
_LINE_SQL = _LINE.replace("l_shipdate", "CAST(l_shipdate AS VARCHAR) AS l_shipdate")


@check(
    f"""SELECT {_LINE_SQL} FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1"""
)
def dedupe_on_subset(spark, sf):
    lines = given(spark, sf, "lineitem").select(*_LINE_COLUMNS)
    order = newest_first("l_shipdate", "l_partkey", "l_suppkey")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], order)


@check(
    """SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1"""
)
def latest_per_customer(spark, sf):
    latest = latest_per_key(
        given(spark, sf, "orders"), ["o_custkey"], newest_first("o_orderdate", "o_orderkey")
    )
    return latest.select("o_custkey", "o_orderkey", "o_orderstatus")


@check(
    """SELECT l_suppkey, nullif(l_linestatus, 'F') AS lob, l_orderkey, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, nullif(l_linestatus, 'F')
  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1"""
)
def latest_composite_key(spark, sf):
    lines = given(spark, sf, "lineitem").withColumn(
        "lob", F.nullif(F.col("l_linestatus"), F.lit("F"))
    )
    order = newest_first("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    latest = latest_per_key(lines, ["l_suppkey", "lob"], order)
    return latest.select("l_suppkey", "lob", "l_orderkey", "l_partkey")


@check(
    """SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'O' QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def filter_then_latest(spark, sf):
    own = given(spark, sf, "orders").filter("o_orderstatus = 'O'")
    latest = latest_per_key(own, ["o_custkey"], newest_first("o_orderdate", "o_orderkey"))
    return latest.select("o_custkey", "o_orderkey")


@check(
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1 AND o_orderstatus = 'O'"""
)
def latest_then_filtered(spark, sf):
    order = newest_first("o_orderdate", "o_orderkey")
    own = F.col("o_orderstatus") == "O"
    latest = latest_then_filter(given(spark, sf, "orders"), ["o_custkey"], order, own)
    return latest.select("o_custkey", "o_orderkey")


@check(
    """SELECT DISTINCT o_custkey, first_value(nullif(o_orderpriority, '5-LOW')) OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS priority FROM orders"""
)
def first_value_distinct(spark, sf):
    orders = given(spark, sf, "orders").withColumn(
        "p", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    )
    return first_value_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "p", "priority")


@check(
    """SELECT event_id, user_id, event_type, CAST(amount AS DOUBLE) AS amount,
  CAST(previous AS DOUBLE) AS previous, CAST(amount - previous AS DOUBLE) AS change
FROM (SELECT *, lead(amount) OVER (PARTITION BY user_id, event_type
    ORDER BY ts DESC, event_id DESC) AS previous
  FROM (SELECT *, CASE WHEN value > 1 THEN CAST(value AS DECIMAL(18,2)) END AS amount FROM events))"""
)
def lead_previous_amount(spark, sf):
    amount = F.when(F.col("value") > 1, money(F.col("value")))
    events = given(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "ts", amount.alias("amount")
    )
    keys = ["user_id", "event_type"]
    linked = previous_value(events, keys, "ts", ["event_id"], "amount", "previous")
    return linked.withColumn("change", money(F.col("amount") - F.col("previous"))).drop("ts")


@check(
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS cnt FROM lineitem) WHERE cnt > 1"""
)
def duplicate_keys(spark, sf):
    lines = given(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return repeated_keys(lines, ["l_orderkey", "l_linenumber"])


# Periods, codes, money.


def _period_text() -> F.Column:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    year, month = F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string")
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", F.concat_ws("_", year, month))
        .when(priority == "2-HIGH", F.left(day, F.lit(7)))
        .when(priority == "3-MEDIUM", F.replace(F.left(day, F.lit(7)), F.lit("-"), F.lit("")))
        .when(priority == "5-LOW", F.concat(day, F.lit(" 00:00:00")))
        .otherwise(F.concat(year, F.lit("_13")))
    )


_PARSED = """SELECT o_orderkey, o_orderpriority,
  CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL
    WHEN '5-LOW' THEN CAST(o_orderdate AS DATE)
    ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS acctg_dt, o_orderdate
FROM orders"""


@check(
    f"""SELECT o_orderkey, year(o_orderdate) AS acctg_yr,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '13'
    ELSE strftime(o_orderdate, '%m') END AS acctg_mo,
  CAST(CASE WHEN acctg_dt IS NOT NULL THEN CAST(date_trunc('month', o_orderdate) AS DATE) END
    AS VARCHAR) AS acctg_mo_first_day,
  CAST(acctg_dt AS VARCHAR) AS acctg_dt FROM ({_PARSED})"""
)
def accounting_period_parse(spark, sf):
    orders = given(spark, sf, "orders").select("o_orderkey", _period_text().alias("t"))
    return with_period(orders, "t").drop("t")


@check(
    f"""SELECT o_orderkey FROM ({_PARSED})
WHERE acctg_dt BETWEEN DATE '2000-03-01' AND DATE '2001-02-28'"""
)
def accounting_range_filter(spark, sf):
    orders = given(spark, sf, "orders").select("o_orderkey", _period_text().alias("t"))
    start, end = accounting_range("20010317", 12)
    return orders.filter(text_in_range(F.col("t"), start, end)).select("o_orderkey")


@check(
    """SELECT o_orderstatus, year(o_orderdate) AS underwriting_year, count(*) AS orders
FROM orders GROUP BY 1, 2"""
)
def derive_year(spark, sf):
    orders = given(spark, sf, "orders")
    year = F.year(F.col("o_orderdate").cast("date")).alias("underwriting_year")
    return orders.groupBy("o_orderstatus", year).agg(F.count(F.lit(1)).alias("orders"))


@check(
    """SELECT p_partkey, substring(CASE WHEN p_partkey < 100
  THEN lpad(CAST(p_partkey AS VARCHAR), 3, '0') ELSE CAST(p_partkey AS VARCHAR) END, 1, 3) AS code
FROM part"""
)
def normalise_code(spark, sf):
    text = F.concat(F.lit("  "), F.col("p_partkey").cast("string"), F.lit(" "))
    return given(spark, sf, "part").select("p_partkey", codes.normalise_code(text).alias("code"))


@check(
    """SELECT l_orderkey, l_partkey, lpad(CAST(l_orderkey AS VARCHAR), 15, '0') AS root,
  coalesce(nullif(l_linenumber, 4), CASE WHEN l_returnflag <> 'A' THEN l_linenumber END) AS revision
FROM lineitem"""
)
def reference_split(spark, sf):
    line = F.col("l_linenumber")
    held = F.when(F.col("l_returnflag") == "A", "x1y").otherwise(F.lpad(line.cast("string"), 3, "0"))
    reference = F.concat(F.lpad(F.col("l_orderkey").cast("string"), 15, "0"), held)
    return given(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", codes.reference_root(reference).alias("root"),
        F.coalesce(F.nullif(line, F.lit(4)), codes.reference_revision(reference)).alias("revision"),
    )


@check(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END
  AS number_text FROM orders"""
)
def int_text_normalise(spark, sf):
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    text = (
        F.when(status == "P", F.concat(F.lit("A"), key))
        .when(status == "O", F.concat(key, F.lit(".0")))
        .otherwise(F.lpad(key, 9, "0"))
    )
    orders = given(spark, sf, "orders")
    return orders.select("o_orderkey", codes.int_text(text).alias("number_text"))


_RATE = """CASE l_linenumber % 3 WHEN 0 THEN 0.123456 WHEN 1 THEN 1234567.5 ELSE 7.25 END"""


@check(
    f"""SELECT l_orderkey, l_partkey, l_linenumber,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(20,2)) * CAST({_RATE} AS DECIMAL(16,6)) AS DECIMAL(18,2)) AS DOUBLE) AS factor,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(20,2)) * CAST({_RATE} AS DECIMAL(16,6)) * 0.01 AS DECIMAL(18,2)) AS DOUBLE)
    AS percent FROM lineitem"""
)
def commission_exact(spark, sf):
    """Plain factors of six places and rates above a million."""
    lines, rate = given(spark, sf, "lineitem"), F.expr(f"CAST({_RATE} AS DECIMAL(14,6))")
    price = F.col("l_extendedprice")
    return lines.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        commission_amount(price, rate, per_hundred=False).alias("factor"),
        commission_amount(price, rate).alias("percent"),
    )


_PLACES = """CASE l_linenumber % 4 WHEN 0 THEN 0.12345678 WHEN 1 THEN 4.9999996 WHEN 2 THEN 0.00000001 ELSE 12345678.12345678 END"""
_UNITS = """CASE l_linenumber % 4 WHEN 0 THEN 12345678 WHEN 1 THEN 499999960 WHEN 2 THEN 1 ELSE 1234567812345678 END"""


@check(
    f"""SELECT l_orderkey, l_partkey, l_linenumber,
  CAST(sign(cents) * ((abs(cents) * rate + 50000000) // 100000000) / 100.0 AS DOUBLE) AS factor,
  CAST(sign(cents) * ((abs(cents) * rate + 5000000000) // 10000000000) / 100.0 AS DOUBLE) AS percent,
  abs(cents) * 100000 * rate >= 100000000 * 1000000000000000000::HUGEINT AS beyond
FROM (SELECT l_orderkey, l_partkey, l_linenumber,
  CAST(round((l_extendedprice - 20000) * 100) AS HUGEINT) AS cents, CAST({_UNITS} AS HUGEINT) AS rate FROM lineitem)"""
)
def commission_of_eight_places(spark, sf):
    """Factors of eight places, on amounts of both signs; and which hundred thousandfold amounts are beyond money."""
    lines, rate = given(spark, sf, "lineitem"), F.expr(f"CAST({_PLACES} AS DECIMAL(16,8))")
    price = F.round(F.col("l_extendedprice") - 20000, 2).cast("decimal(18,2)")
    return lines.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        commission_amount(price, rate, per_hundred=False).alias("factor"),
        commission_amount(price, rate).alias("percent"),
        commission_problem((price * 100000).cast("decimal(18,2)"), rate, per_hundred=False).isNotNull().alias("beyond"),
    )


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@check(
    f"""SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '' WHEN c IN ({_sql_list(codes.MAJOR_PERILS)}) THEN 'InList'
  ELSE 'NotInList' END AS peril, CASE WHEN p_partkey % 7 = 0 THEN '' WHEN c IN ({_sql_list(codes.SUBLINES)})
  THEN 'InList' ELSE 'NotInList' END AS subline
FROM (SELECT p_partkey, lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') AS c FROM part)"""
)
def whole_code_lists(spark, sf):
    """All three-digit codes against both long lists."""
    code = F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")
    code = F.when(F.col("p_partkey") % 7 != 0, code)
    return given(spark, sf, "part").select(
        "p_partkey",
        codes.list_flag(code, codes.MAJOR_PERILS).alias("peril"),
        codes.list_flag(code, codes.SUBLINES).alias("subline"),
    )


@check(
    """SELECT l_orderkey, l_partkey, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2))
  * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DOUBLE) AS commission FROM lineitem"""
)
def commission_amounts(spark, sf):
    percent = F.col("l_discount").cast("decimal(4,2)") * 100
    amount = commission_amount(F.col("l_extendedprice"), percent)
    return given(spark, sf, "lineitem").select("l_orderkey", "l_partkey", amount.alias("commission"))


@check(
    """SELECT p_partkey, CASE WHEN p_brand = 'Brand#3' THEN ''
  WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'InList' ELSE 'NotInList' END AS flag,
  CASE WHEN p_brand = 'Brand#3' THEN 'NotInList'
  WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'InList' ELSE 'NotInList' END AS strict_flag,
  CASE WHEN p_brand IN ('Brand#3', 'Brand#4', 'Brand#5') THEN '' ELSE 'NotInList' END AS reinsurer
FROM part"""
)
def flag_in_list_3way(spark, sf):
    brand = F.col("p_brand")
    code = F.when(brand == "Brand#4", "").when(brand != "Brand#3", brand)
    members = ("Brand#1", "Brand#2")
    reinsurer = F.when(code == "Brand#5", codes.OWN_REINSURER).otherwise(code)
    return given(spark, sf, "part").select(
        "p_partkey", codes.list_flag(code, members).alias("flag"),
        codes.list_flag(code, members, missing="NotInList").alias("strict_flag"),
        codes.reinsurer_status(reinsurer).alias("reinsurer"),
    )


@check(
    """SELECT l_orderkey, l_partkey, CASE WHEN p_size < 10
    OR (l_linenumber > 1 AND ((l_returnflag IN ('A', 'N') AND l_linestatus = 'F' AND p_size < 20)
      OR (l_returnflag = 'R' AND l_linestatus = 'O' AND p_size >= 30)))
  THEN 'E' ELSE '' END AS epli
FROM lineitem JOIN part ON l_partkey = p_partkey"""
)
def rule_case_flag(spark, sf):
    size, flag = F.col("p_size"), F.col("l_returnflag")
    code = F.when(size < 10, "172").when(size < 20, " 560").when(size < 30, "1").otherwise("662 ")
    line = F.when(flag == "A", "GL").when(flag == "N", "CPP").otherwise("BOP")
    bureau = F.when(F.col("l_linestatus") == "F", "GL").otherwise("BC")
    channel = F.lpad(F.col("l_linenumber").cast("string"), 2, "0")
    sizes = given(spark, sf, "part").select("p_partkey", "p_size")
    lines = spread_join(given(spark, sf, "lineitem"), sizes, [("l_partkey", "p_partkey")], "inner")
    rule = codes.employment_liability(channel, line, bureau, code)
    return lines.select("l_orderkey", "l_partkey", rule.alias("epli"))


@check(
    """SELECT l_orderkey, l_partkey FROM lineitem
WHERE (year(l_shipdate) = 2000 AND l_returnflag <> 'R' AND month(l_shipdate) = 12)
  OR year(l_shipdate) = 2001"""
)
def claims_period_slice(spark, sf):
    month = F.when(F.col("l_returnflag") != "R", F.month("l_shipdate"))
    inside = months_between(F.year("l_shipdate"), month, (2000, 12), (2001, 12))
    return given(spark, sf, "lineitem").filter(inside).select("l_orderkey", "l_partkey")


# Keys under which the blueprint lists functions that share their name with the library.
for _name, _key in (
    ("lookup_joins", "lookup_join"),
    ("latest_per_customer", "latest_per_key"),
    ("latest_then_filtered", "latest_then_filter"),
    ("commission_amounts", "commission_amount"),
):
    QUERIES[_key], ORACLES[_key] = QUERIES.pop(_name), ORACLES.pop(_name)
