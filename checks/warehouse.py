"""A warehouse of hubs, links and satellites derived from the given tables.

Each table is one SQL text that both Spark and the checking engine read. A table whose text joins or
groups is written on first use to the session's shared folder, the others are views of such tables;
the checking engine inlines the same texts as common table expressions.

policy = order, premium transaction = line item, party = customer, agency = supplier,
claim = order, claim transaction = line item.
"""

from __future__ import annotations

import re
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from vaultfeed.sources import Warehouse, scratch_path

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_HIGH = "o_orderpriority IN ('1-URGENT', '2-HIGH')"

# Staging: line items with the source of their order, and orders with their customer.
STAGING = {
    "base_plcy": f"""
SELECT CAST(o_orderkey AS STRING) AS plcy,
  CASE o_orderstatus WHEN 'F' THEN CASE WHEN {_HIGH} THEN '92' ELSE 'Arrowhead' END
    WHEN 'O' THEN CASE WHEN {_HIGH} THEN '217' ELSE '61' END
    ELSE CASE WHEN {_HIGH} THEN '220' ELSE '109' END END AS source,
  CASE o_orderstatus WHEN 'F' THEN '45' WHEN 'O' THEN '61' ELSE '105' END AS claim_source,
  o_orderstatus AS status, o_orderpriority AS prio, CAST(o_orderdate AS DATE) AS odate,
  CAST(o_totalprice AS DECIMAL(18,2)) AS total, CAST(c_custkey AS STRING) AS cust,
  c_name AS cname, c_mktsegment AS seg, lpad(CAST(c_nationkey AS STRING), 2, '0') AS nat
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "base_tran": """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-'
    || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS id,
  plcy, source, claim_source, odate, l_linenumber AS ln, l_returnflag AS rf, l_linestatus AS ls,
  CAST(l_quantity AS INT) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax,
  CAST(l_shipdate AS DATE) AS ship, CAST(l_partkey AS STRING) AS part,
  CAST(l_suppkey AS STRING) AS supp,
  nullif(l_linestatus, 'F') AS lob,
  CASE WHEN l_tax > 0
    THEN CASE WHEN source = '220' THEN 'X' ELSE '' END || CAST(l_linenumber AS STRING) END AS obj,
  'V' || CAST(CAST(floor(l_quantity / 10) AS INT) AS STRING) AS cvrg,
  CASE WHEN l_quantity > 25 THEN 'J' END AS job,
  CASE WHEN l_discount <= 0.02 THEN NULL WHEN l_discount <= 0.05 THEN '' ELSE 'K' END AS cntct,
  lpad(CAST(l_linenumber AS STRING), 2, '0') AS st,
  lpad(plcy, 15, '0') || lpad(CAST(l_linenumber AS STRING), 3, '0') AS ref,
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN
      CASE WHEN l_linenumber <= 2 THEN 'Manual_Rated_Coverage_Premium'
        WHEN l_linenumber <= 4 THEN 'Coverage_Level_Contract_Premium'
        ELSE 'Endorsment_Level_Premium' END
    WHEN l_returnflag <> 'R' THEN 'Coverage_Level_Premium'
    WHEN l_linestatus = 'F' THEN 'Policy_Level_Commission'
    WHEN l_linenumber <= 3 THEN 'Coverage_Level_Commission'
    ELSE 'Endorsement_Level_Commission' END AS tran_tp,
  CASE WHEN l_linenumber <= 2
      THEN CAST(year(odate) AS STRING) || '_' || CAST(month(odate) AS STRING)
    WHEN l_linenumber = 3 THEN substring(CAST(odate AS STRING), 1, 7)
    WHEN l_linenumber = 4 THEN replace(substring(CAST(odate AS STRING), 1, 7), '-', '')
    WHEN l_linenumber <= 6 THEN CAST(odate AS STRING)
    ELSE 'bad' END AS period
FROM lineitem JOIN base_plcy ON CAST(l_orderkey AS STRING) = plcy""",
    # One row per coverage of a policy; transactions taxed at 8 percent have none.
    "base_cvrg": """
SELECT 'C' || md5(plcy || '|' || ref || '|' || cvrg || '|' || coalesce(lob, '~') || '|'
    || coalesce(obj, '~') || '|' || coalesce(job, '~') || '|' || coalesce(cntct, '~')) AS pc,
  plcy, source, lob, obj, cvrg, job, cntct, st, ref,
  max(ship) AS ship, max(price) AS price, max(disc) AS disc, min(rf) AS rf, max(qty) AS qty
FROM base_tran WHERE tax < 0.08
GROUP BY plcy, source, lob, obj, cvrg, job, cntct, st, ref""",
}

TABLES = {
    "xfrmtn": """
SELECT 'DM_GAIN_UW_COMP' AS data_key_id, '[' || {r_list} || ']' AS data_val FROM region
UNION ALL
SELECT 'DIM_STATE_CODE_WINS', '[' || {n_list} || ']' FROM nation
UNION ALL
SELECT 'ISO_STATE_CODE', '[' || {c_list} || ']' FROM nation""",
    "ref_lkup": """
SELECT DISTINCT 'IT Application' AS cd_lst, source AS cd_val, 'System ' || source AS cd_shrt_desc
FROM base_plcy
UNION ALL
SELECT DISTINCT 'IT Application', claim_source, 'System ' || claim_source FROM base_plcy
WHERE claim_source <> '61'
UNION ALL
SELECT DISTINCT 'Other', source, 'Other ' || source FROM base_plcy""",
    "hub_plcy": "SELECT plcy AS hash_plcy_id, source AS rec_src_nm FROM base_plcy",
    "sat_plcy_dtl": """
SELECT plcy AS hash_plcy_id, v.ld_end_dt, source AS rec_src_nm, odate AS eff_dt,
  CASE seg WHEN 'BUILDING' THEN 'CU' WHEN 'MACHINERY' THEN NULL WHEN 'HOUSEHOLD' THEN ''
    ELSE 'ZZ' END AS plcy_sym_cd,
  'P' || plcy AS plcy_nbr, 'O' || plcy AS orgnl_plcy_nbr,
  CAST(odate + INTERVAL '1' YEAR AS DATE) AS exprn_dt, substring(nat, 1, 1) AS co_nbr,
  CASE status WHEN 'F' THEN 'Y' ELSE 'N' END AS clm_made_flg,
  CASE prio WHEN '1-URGENT' THEN '0060' WHEN '2-HIGH' THEN '' WHEN '3-MEDIUM' THEN NULL
    ELSE '0099' END AS reins_co_nbr,
  CASE seg WHEN 'BUILDING' THEN 'M' WHEN 'AUTOMOBILE' THEN NULL ELSE 'N' END AS plcy_kind_cd,
  CASE WHEN total > 300000 THEN odate END AS retro_dt,
  CAST(odate + INTERVAL '2' YEAR AS DATE) AS tail_dt,
  CASE WHEN total > 200000 THEN 2 ELSE 1 END AS rnwl_cnt,
  CASE WHEN total < 50000 THEN 'Not taken up' END AS canctn_descr,
  '00' || substring(prio, 1, 1) AS revsn_nbr, substring(seg, 1, 3) AS pgm_cd,
  substring(seg, 4, 2) AS sub_pgm_cd, substring(prio, 3, 3) AS bus_tp_cd,
  CASE seg WHEN 'BUILDING' THEN 'BO' WHEN 'AUTOMOBILE' THEN 'MP' WHEN 'HOUSEHOLD' THEN 'MP'
    ELSE 'WC' END AS prod_cd,
  substring(prio, 1, 1) AS plcy_tp_cd, seg AS mkt_sgmt_cd, 'S' || status AS plcy_strc_cd,
  nat || '0' AS extndd_rpt_dt_nbr, total AS excs_attchmt_pnt_amt, nat AS cntrl_st_cd,
  nat AS prodr_nbr
FROM base_plcy
CROSS JOIN_VERSIONS""",
    "lnk_prem_tran": """
SELECT id AS hash_prem_tran_id, ref AS ref_id, plcy AS hash_plcy_id, lob AS hash_lob_id,
  obj AS hash_insd_obj_id, cvrg AS hash_cvrg_id, job AS hash_job_cls_cd_id, st AS st_prvnc_cd,
  cntct AS hash_cntct_pnt_id, supp AS hash_trty_id, tran_tp AS tran_tp_cd, source AS rec_src_nm,
  ship AS btch_dt
FROM base_tran""",
    "sat_prem": """
SELECT id AS hash_prem_tran_id, price AS chgd_prem_amt,
  CAST(price * (1 - disc) AS DECIMAL(18,2)) AS wrtn_prem_amt,
  CAST(CAST(ship AS STRING) || ' ' || lpad(CAST(ln AS STRING), 2, '0') || ':30:15' AS TIMESTAMP) AS tran_dt,
  odate AS tran_eff_dt, CAST(odate + INTERVAL '1' YEAR AS DATE) AS tran_exprn_dt, ls AS tran_cd,
  'Flag ' || rf AS tran_descr, period AS acctg_yr_mo_txt, 'E' || rf AS plcy_evnt_tp_cd,
  nullif(ln, 7) AS endrsmt_revsn_nbr, ref AS ref_id,
  CASE WHEN tax <= 0.02 THEN NULL WHEN tax >= 0.07 THEN 'Y' ELSE 'N' END AS bndr_flg
FROM base_tran""",
    "sat_cmsn": """
SELECT id AS hash_prem_tran_id, CASE WHEN source = '220' THEN CAST(disc * 1.2345 AS DECIMAL(14,6))
    ELSE CAST(disc * 100 AS DECIMAL(14,6)) END AS cmsn_pct,
  CAST(price * disc AS DECIMAL(18,2)) AS cmsn_amt,
  CAST(price * disc AS DECIMAL(18,2)) AS net_cmsn_amt, nullif(ln, 2) AS endrsmt_revsn_nbr,
  ref AS ref_id, ship AS src_eff_dt, period AS acctg_yr_mo_txt
FROM base_tran""",
    "lnk_plcy_cvrg": """
SELECT pc AS hash_plcy_cvrg_id, plcy AS hash_plcy_id, lob AS hash_lob_id,
  obj AS hash_insd_obj_id, cvrg AS hash_cvrg_id, job AS hash_job_cls_cd_id, st AS st_prvnc_cd,
  ref AS ref_id, cntct AS hash_cntct_pnt_id, ship AS btch_dt
FROM base_cvrg
UNION ALL
SELECT pc || 'old', plcy, lob, obj, cvrg, job, st, ref, cntct, CAST(ship - INTERVAL '30' DAY AS DATE)
FROM base_cvrg WHERE source = '220'""",
    "sat_plcy_cvrg_dtl": """
SELECT pc AS hash_plcy_cvrg_id, 'cell' || lob AS cell_cd, 'seg' || st AS sgmt_cd,
  'fin' || cvrg AS fincl_ln_of_bus_cd, job || rf AS cls_cd, CAST(qty AS STRING) AS coins_val,
  price AS expsr_amt, 'per ' || rf AS expsr_base, CASE rf WHEN 'A' THEN 'Y' END AS clm_made_flg,
  ship AS btch_dt
FROM base_cvrg
UNION ALL
SELECT pc, 'old', 'old', 'old', 'old', 'old', price, 'old', 'N',
  CAST(ship - INTERVAL '30' DAY AS DATE)
FROM base_cvrg WHERE source = '220'""",
    "sat_plcy_cvrg_sar_dtl": """
SELECT pc AS hash_plcy_cvrg_id, CASE WHEN rf = 'A' THEN 'GL' ELSE 'BC' END AS tp_bur_cd
FROM base_cvrg""",
    "sat_cvrg_dtl": """
SELECT 'V' || CAST(CAST(floor(p_size / 10.0) AS INT) AS STRING) AS hash_cvrg_id,
  substring(min(p_brand), 7, 2) AS aslob_cd, min(p_type) AS cvrg_tp_cd,
  CASE CAST(floor(p_size / 10.0) AS INT) WHEN 0 THEN ' 088 ' WHEN 1 THEN '560' WHEN 2 THEN '172'
    WHEN 3 THEN '' WHEN 4 THEN NULL ELSE '999' END AS cvrg_cd,
  CASE CAST(floor(p_size / 10.0) AS INT) WHEN 0 THEN '10' WHEN 1 THEN NULL WHEN 2 THEN '3344'
    ELSE '5' END AS subline_cd,
  max(p_name) AS cvrg_descr, 'L' || CAST(min(p_size) AS STRING) AS lob_cd,
  'T' || CAST(max(p_size) AS STRING) AS cvrg_part_cd
FROM part GROUP BY CAST(floor(p_size / 10.0) AS INT)""",
    # Insurers repeat under two spellings of the role, insured parties over two batches.
    "lnk_plcy_prty_role": """
SELECT 'I' || plcy AS hash_plcy_prty_role_id, plcy AS hash_plcy_id,
  source || '-' || nat AS hash_prty_id, 'Insurer' AS prty_role_tp_cd, source AS rec_src_nm,
  odate AS btch_dt
FROM base_plcy
UNION ALL
SELECT 'J' || plcy, plcy, source || '-' || lpad(substring(prio, 1, 1), 2, '0'),
  CASE WHEN seg = 'BUILDING' THEN 'INSURER' ELSE 'Insurer' END, source,
  CAST(odate + INTERVAL '1' DAY AS DATE)
FROM base_plcy WHERE total > 250000
UNION ALL
SELECT 'K' || plcy, plcy, cust, 'INSURED', source, odate FROM base_plcy
UNION ALL
SELECT 'L' || plcy, plcy, source || '-' || nat, 'insured', source, odate
FROM base_plcy WHERE total > 350000
UNION ALL
SELECT 'M' || plcy, plcy, cust, 'Selling_Agency', source, odate FROM base_plcy
UNION ALL
SELECT 'N' || plcy, plcy, cust, 'Selling_Agency', source, CAST(odate - INTERVAL '1' DAY AS DATE)
FROM base_plcy WHERE total > 250000""",
    "sat_org": """
SELECT DISTINCT source || '-' || nat AS hash_prty_id,
  CASE WHEN nat < '05' THEN NULL ELSE 'Insurer ' || source || nat END AS org_nm,
  'org' || nat AS org_cd, source AS rec_src_nm, '6' || nat AS sic_cd,
  CAST(NULL AS INT) AS nbr_of_emp_cnt, 'own' || nat AS ownrsp_tp_cd
FROM base_plcy
UNION ALL
SELECT CAST(c_custkey AS STRING), c_name, 'cust', 'party',
  substring(c_mktsegment, 1, 4), CAST(floor(c_acctbal) AS INT), NULL
FROM customer""",
    "sat_sell_agcy": """
SELECT 'M' || plcy AS hash_plcy_prty_role_id, 'A' || nat AS prodr_nbr, source AS rec_src_nm
FROM base_plcy
UNION ALL
SELECT 'N' || plcy, 'B' || nat, source FROM base_plcy WHERE total > 250000""",
    "sat_trty_dtl": """
SELECT CAST(s_suppkey AS STRING) AS hash_trty_id, 'T' || s_name AS ref_id FROM supplier""",
    "lnk_plcy_cntct_pnt": """
SELECT plcy AS hash_plcy_id, nat AS hash_cntct_pnt_id, 'Primary_Address' AS cntct_pnt_tp_cd,
  odate AS btch_dt
FROM base_plcy
UNION ALL
SELECT plcy, '00', 'Primary_Address', odate FROM base_plcy WHERE total > 400000
UNION ALL
SELECT plcy, '01', 'Mail_Address', CAST(odate + INTERVAL '9' DAY AS DATE) FROM base_plcy""",
    "sat_phys_addr": """
SELECT lpad(CAST(n_nationkey AS STRING), 2, '0') AS hash_cntct_pnt_id,
  '9' || CAST(n_nationkey AS STRING) AS pstl_cd, n_name AS city_nm, r_name AS cnty_nm
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20""",
    "sat_ins_obj_prop": """
SELECT CAST(s_suppkey AS STRING) AS hash_insd_obj_id, 'Loc ' || s_name AS prpty_loc_nbr
FROM supplier
UNION ALL
SELECT 'X' || CAST(s_suppkey AS STRING), 'Loc ' || s_name FROM supplier
UNION ALL
SELECT 'X' || CAST(s_suppkey AS STRING), 'Annex ' || s_name FROM supplier WHERE s_suppkey % 5 < 3""",
    "sat_plcy_lmt": """
SELECT plcy AS hash_plcy_id, CASE rf WHEN 'A' THEN 'Aggregate' WHEN 'R' THEN 'Per Event' END
  AS lmt_tp_cd, CASE WHEN qty > 5 THEN price END AS lmt_amt, source AS rec_src_nm, ship AS btch_dt
FROM base_tran""",
    "sat_plcy_cvrg_ded": """
SELECT pc AS hash_plcy_cvrg_id, CASE rf WHEN 'A' THEN 'Flat' ELSE 'Percent' END AS ded_tp_cd,
  price AS ded_amt, source AS rec_src_nm, ship AS btch_dt
FROM base_cvrg""",
    "sat_plcy_cvrg_lmt": """
SELECT pc AS hash_plcy_cvrg_id, CASE WHEN qty > 40 THEN 'Building' WHEN qty > 20 THEN 'Contents' END
  AS lmt_tp_cd, price AS lmt_amt, source AS rec_src_nm, ship AS btch_dt
FROM base_cvrg""",
    "lnk_plcy_lob": """
SELECT DISTINCT plcy || coalesce(lob, '~') AS hash_plcy_lob_id, plcy AS hash_plcy_id,
  lob AS hash_lob_id
FROM base_tran""",
    "sat_plcy_lob_dtl": """
SELECT plcy || coalesce(lob, '~') AS hash_plcy_lob_id, 'ISO' || CAST(max(ln) AS STRING) AS iso_cd
FROM base_tran GROUP BY plcy, lob""",
    "sat_plcy_lob_expsr": """
SELECT plcy || coalesce(lob, '~') AS hash_plcy_lob_id,
  CASE rf WHEN 'A' THEN 'EmpCountTotal' WHEN 'N' THEN 'Locations' END AS expsr_tp_cd,
  price AS expsr_amt, 'base ' || st AS expsr_base, ship AS btch_dt
FROM base_tran""",
    "sat_sched_mdfr": """
SELECT ref AS ref_id, id AS hash_prem_tran_id,
  CASE WHEN qty > 30 THEN 'Safety' WHEN qty > 10 THEN 'Location' END AS sched_mdfr_tp_cd,
  CAST(disc * 10 AS DECIMAL(18,2)) AS sched_mdfr_rt_pct, source AS rec_src_nm, ship AS btch_dt
FROM base_tran""",
    "sat_lob_dtl": """
SELECT DISTINCT l_linestatus AS hash_lob_id, 'GL' AS lob_cd FROM lineitem""",
    "sat_agcy_acct_dtl": """
SELECT 'A' || CAST(s_suppkey AS STRING) AS hash_agcy_acct_id,
  CASE WHEN s_acctbal < 0 THEN 'A' || CAST(s_suppkey AS STRING)
    ELSE ' ' || lpad(CAST(s_suppkey AS STRING), 6, '0') || ' ' END AS acct_nbr,
  '0' || CAST(50 + s_nationkey AS STRING) || s_name AS mstr_acct_nbr, '0036' AS rec_src_nm,
  DATE '2020-01-01' AS btch_dt
FROM supplier
UNION ALL
SELECT 'B' || CAST(s_suppkey AS STRING), CAST(s_suppkey AS STRING), '099', '0036',
  DATE '2019-01-01'
FROM supplier
UNION ALL
SELECT 'C' || CAST(s_suppkey AS STRING), CAST(s_suppkey AS STRING), '098', '9999',
  DATE '2021-01-01'
FROM supplier""",
    "lnk_agcy_acct_lgl_agcy": """
SELECT 'A' || CAST(s_suppkey AS STRING) AS hash_agcy_acct_id,
  'G' || CAST(s_nationkey AS STRING) AS hash_lgl_agcy_id,
  'X' || CAST(s_suppkey AS STRING) AS hash_agcy_acct_lgl_agcy_id, '0036' AS rec_src_nm
FROM supplier""",
    "sat_lgl_agcy_dtl": """
SELECT 'G' || CAST(n_nationkey AS STRING) AS hash_lgl_agcy_id,
  lpad(CAST(n_regionkey AS STRING), 2, '0') AS dstn_chnnl_cd, n_name AS dest_grp_cd,
  CASE WHEN n_nationkey = 3 THEN '9999' ELSE '0036' END AS rec_src_nm
FROM nation""",
    "sat_agcy_acct_lgl_agcy_dtl": """
SELECT 'X' || CAST(s_suppkey AS STRING) AS hash_agcy_acct_lgl_agcy_id,
  CASE WHEN s_acctbal > 5000 THEN '70' WHEN s_acctbal > 0 THEN '71' END AS serv_ofc_cd,
  '0036' AS rec_src_nm
FROM supplier""",
    "sat_clm_dtl": """
SELECT 'K' || plcy AS hash_clm_id, claim_source AS rec_src_nm, odate AS loss_dt,
  'UW ' || source AS src_sys_rec_nm, 'Company ' || nat AS wrtg_co_nm, nat AS wrtg_co_cd,
  'N' || plcy AS clm_nbr, 'pub:' || plcy AS clm_pub_id, 'P' || plcy AS plcy_nbr,
  odate AS plcy_eff_dt, CASE WHEN total > 250000 THEN 'Open' ELSE 'Closed' END AS clm_sts_descr,
  CASE WHEN total > 250000 THEN 'O' ELSE 'C' END AS clm_sts_cd, 'State ' || nat AS loss_loc_st_nm,
  nat AS loss_loc_st_cd, 'c' || nat AS cell_cd, 's' || seg AS sgmt_cd,
  'f' || prio AS fincl_ln_of_bus_cd
FROM base_plcy""",
    # Of some claims the newest link comes from another source, some have two links.
    "lnk_clm_plcy": """
SELECT 'K' || plcy AS hash_clm_id, plcy AS hash_plcy_id, claim_source AS rec_src_nm,
  odate AS btch_dt
FROM base_plcy
UNION ALL
SELECT 'K' || plcy, plcy, '99', CAST(odate + INTERVAL '1' DAY AS DATE)
FROM base_plcy WHERE total > 400000""",
    "lnk_clm_tran": """
SELECT 'K' || plcy AS hash_clm_id, 'F' || id AS hash_clm_fincl_tran_id, part AS hash_expsr_id
FROM base_tran""",
    "sat_clm_tran_dtl": """
SELECT 'F' || id AS hash_clm_fincl_tran_id,
  CASE WHEN tax > 0 THEN year(ship) END AS acctg_yr_nbr,
  CASE WHEN disc > 0 THEN month(ship) END AS acctg_mo_nbr, ship AS tran_dt,
  'Type ' || rf AS tran_tp_descr,
  CASE rf WHEN 'R' THEN 'Reserve' WHEN 'A' THEN 'Payment' ELSE 'Recovery' END AS tran_tp_cd,
  'cost ' || ls AS cost_tp_descr, rf AS cost_ctgry_cd, 'category ' || rf AS cost_ctgry_descr,
  ls AS erd_rsrv_flg, price AS tran_amt, CAST(ln AS STRING) AS rsrv_ln_id, ship AS btch_dt,
  'status ' || ls AS tran_sts_descr, CASE WHEN qty > 45 THEN 'Y' END AS retrd_flg
FROM base_tran""",
    "sat_expsr_dtl": """
SELECT CAST(p_partkey AS STRING) AS hash_expsr_id, p_brand AS cell_cd, p_type AS sgmt_cd,
  p_name AS fincl_ln_of_bus_cd
FROM part""",
}

# A policy has an open row and, if it is large, a closed one that must not be read.
TABLES["sat_plcy_dtl"] = "\nUNION ALL\n".join(
    TABLES["sat_plcy_dtl"]
    .replace("v.ld_end_dt", f"CAST({end} AS DATE) AS ld_end_dt")
    .replace("CROSS JOIN_VERSIONS", where)
    for end, where in (("NULL", ""), ("odate", "WHERE total > 100000"))
)

# JSON text of a small table: the one place where the engines name a function differently.
_JSON_LISTS = {
    "r_list": """'{{"Company_Code":"' || CAST(r_regionkey AS STRING) || '","Company_Name":"' || r_name || '"}}'""",
    "n_list": """'{{"CDKEY3":"' || lpad(CAST(n_nationkey AS STRING), 2, '0') || '","CDDESC":"' || n_name || '"}}'""",
    "c_list": """'{{"Code":"' || lpad(CAST(n_nationkey AS STRING), 2, '0') || '"}}'""",
}


def _with_json(text: str, joined: str) -> str:
    lists = {k: joined.format(v.replace("{{", "{").replace("}}", "}")) for k, v in _JSON_LISTS.items()}
    for name, sql in lists.items():
        text = text.replace("{" + name + "}", sql)
    return text


def _inputs(text: str) -> list[str]:
    """Tables that a text reads."""
    return re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text)


def with_tables(select: str, *names: str) -> str:
    """The select for the checking engine, with the warehouse tables it needs in front."""
    wanted: dict[str, str] = {}

    def need(name: str) -> None:
        text = STAGING.get(name) or TABLES.get(name)
        if text is None or name in wanted:
            return
        for inner in _inputs(text):
            need(inner)
        wanted[name] = _with_json(text, "string_agg({}, ',')")
        if name == "sat_plcy_dtl":
            wanted[name] = f"SELECT * FROM ({wanted[name]}) WHERE ld_end_dt IS NULL"

    for name in names or _inputs(select):
        need(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({text})" for name, text in wanted.items())
    return f"WITH {ctes}\n{select}" if wanted else select


# Paths of stored tables, per application, data folder and table.
_stored: dict[tuple[str, str, str], str] = {}
_storing = RLock()

# What is worth storing: rows that were joined, grouped or made distinct. A text that only computes, filters or unites
# is read through, so that it costs a scan of the columns a query asks for and no table of its own.
_GATHERS = re.compile(r"\b(JOIN|GROUP BY|DISTINCT|collect_list)\b")


# Stored in buckets of this column, if large, for the texts that group by it: these then shuffle nothing. A query reads
# the files without the buckets.
_BUCKETS = {"base_tran": "plcy"}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(name: str) -> str:
    return _with_json(STAGING.get(name) or TABLES[name], "concat_ws(',', collect_list({}))")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, stored before if its text gathers rows; nothing is built that no query opens."""
    if name in GIVEN:
        return given(spark, sf_dir, name)
    if not _GATHERS.search(_text(name)):
        return _derived(spark, sf_dir, name)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _storing:
        if key not in _stored:
            path = scratch_path(spark, name)
            writer = _derived(spark, sf_dir, name).write.option("compression", "zstd")
            if name in _BUCKETS and _is_large(spark, sf_dir, name):
                # As many as the join before has parts, so that each of its tasks has buckets of its own.
                writer = writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), _BUCKETS[name])
                writer.option("path", path).saveAsTable(_table(path))
            else:
                writer.parquet(path)
            _stored[key] = path
    return spark.read.parquet(_stored[key])


def _table(path: str) -> str:
    return re.sub(r"\W", "_", path.rsplit("/", 1)[-1])


def _is_large(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether a given table that the text reads keeps all cores busy, see ``_spread``."""
    cores = spark.sparkContext.defaultParallelism
    return any(given(spark, sf_dir, t).rdd.getNumPartitions() >= cores for t in _inputs(_text(name)) if t in GIVEN)


def _bucketed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df, table = _read(spark, sf_dir, name), _table(_stored[spark.sparkContext.applicationId, sf_dir, name])
    return spark.table(table) if spark.catalog.tableExists(table) else df


def _derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = _text(name)
    stored = _GATHERS.search(text)
    frames = {t: (_bucketed if stored and t in _BUCKETS else _read)(spark, sf_dir, t) for t in _inputs(text)}
    if name in STAGING:
        frames = {t: _spread(df) if t in GIVEN else df for t, df in frames.items()}
    text = text.replace("{", "{{").replace("}", "}}")
    return spark.sql(re.sub(r"\b(FROM|JOIN)\s+(\w+)", r"\1 {\2}", text), **frames)


def _spread(df: DataFrame) -> DataFrame:
    """A given table of few megabytes, read by fewer tasks than there are cores, is dealt to all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The derived warehouse; a table is built when it is first opened."""
    return Warehouse(lambda name: _read(spark, sf_dir, name), names=tuple(TABLES))
