"""Policy and claim feeds over the derived warehouse, and the SQL they are checked against.

The SQL joins everything to the transactions one table after another, so it shares neither the
join order nor the grain of the Spark plans.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.compare import comparable
from checks.warehouse import warehouse, with_tables
from vaultfeed.functions import codes
from vaultfeed.functions.period import accounting_range
from vaultfeed.operators.joins import prune_before_shuffles
from vaultfeed.operators.newest import repeated_keys
from vaultfeed.operators.quality import reconcile, run_audit
from vaultfeed.operators.shape import union_by_name
from vaultfeed.plans import split
from vaultfeed.plans.claims import ClaimFeeds, claim_slice
from vaultfeed.plans.extract import claim_outputs, formatted
from vaultfeed.plans.parts import Parts
from vaultfeed.plans.policy import FEEDS, PolicyFeeds
from vaultfeed.sources import scratch_path

BATCH_DATE, MONTHS = "20010101", 36
PERIOD = accounting_range(BATCH_DATE, MONTHS)
CLAIM_START, CLAIM_END = (1999, 12), (2000, 12)
WITH_PERIOD = ("gain", "majesco")


_parts: dict[tuple[str, str], Parts] = {}


def parts(spark: SparkSession, sf_dir: str) -> Parts:
    """The side datasets, with attribute types and hot keys found once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _parts:
        prune_before_shuffles(spark)
        _parts[key] = Parts(warehouse(spark, sf_dir))
    return _parts[key]


def policy_feeds(spark: SparkSession, sf_dir: str, period=None) -> PolicyFeeds:
    return PolicyFeeds(parts(spark, sf_dir), period, folder=partial(scratch_path, spark))


def claim_feeds(spark: SparkSession, sf_dir: str) -> ClaimFeeds:
    return ClaimFeeds(parts(spark, sf_dir), CLAIM_START, CLAIM_END)


def policy_feed(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = policy_feeds(spark, sf_dir, PERIOD if name in WITH_PERIOD else None)
    return comparable(feeds.build(name, flags=True))


def combined_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_combined(spark, sf_dir))


def _combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "by-source")
    return split.combined_policies(spark, parts(spark, sf_dir), path, PERIOD)


def claim_feed(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(claim_feeds(spark, sf_dir).build(name))


def combined_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(claim_feeds(spark, sf_dir).union(branch_column="Branch"))


def claim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(claim_feeds(spark, sf_dir).changes())


def sliced_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = claim_feeds(spark, sf_dir).union()
    return comparable(claim_slice(claims, CLAIM_START, (2000, 11)))


def claims_of_a_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last year's slice of a run, with the rows that have no year."""
    claims = claim_feeds(spark, sf_dir).union(branch_column="Branch")
    return comparable(claim_outputs(claims, CLAIM_START, CLAIM_END)["claims_last_year"])


def formatted_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(formatted(policy_feeds(spark, sf_dir, PERIOD).build("majesco")))


def reconciled_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed rows, core-join rows and base transactions of two feeds."""
    stages = {}
    for name in ("majesco", "prwins"):
        feeds = policy_feeds(spark, sf_dir, PERIOD)
        feed = FEEDS[name]
        stages[f"{name} feed"] = feeds.build(name)
        stages[f"{name} core"] = feeds.core(feed)
        stages[f"{name} base"] = feeds.transactions(feed)
    return comparable(reconcile(stages))


def reconciled(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and premium of one finished feed, of its core joins and of its transactions, and what is repeated.

    Core rows above base rows come from repeated coverages, feed rows above core rows from repeated
    side datasets; repeated transactions are those with more than one row in the finished feed. All are counted in
    one execution of the feed.
    """
    accounts = policy_feeds(spark, sf_dir, PERIOD).accounts(FEEDS[name])
    again, nothing = F.col("feed_rows") > 1, F.lit(0).cast("bigint")
    stages = ("feed", "core", "base")
    sums = [F.sum(f"{s}_{m}").alias(f"{s}_{m}") for s in stages for m in ("rows", "premium")]
    totals = accounts.agg(
        *sums, F.count_if(again).alias("repeated_rows"), F.sum(F.when(again, F.col("feed_premium"))).alias("repeated_premium")
    )
    rows = [
        F.struct(
            F.lit(s).alias("stage"),
            F.coalesce(f"{s}_rows", nothing).alias("row_count"),
            F.col(f"{s}_premium").cast("double").alias("premium"),
        )
        for s in (*stages, "repeated")
    ]
    return comparable(totals.select(F.inline(F.array(*rows))))


def fan_out(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with several rows in a finished feed, and the side datasets that multiplied them."""
    accounts = policy_feeds(spark, sf_dir, PERIOD).accounts(FEEDS[name])
    rows = accounts.filter("feed_rows > 1")
    return comparable(rows.select("txn_hash_prem_tran_id", F.col("feed_rows").alias("row_count"), "culprits"))


def repeated_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that the core joins multiply."""
    core = policy_feeds(spark, sf_dir).core(FEEDS["arrowhead"])
    rows = core.select("txn_hash_prem_tran_id", "lnk_hash_plcy_cvrg_id")
    return repeated_keys(rows, ["txn_hash_prem_tran_id"])


def feed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = ["Source System Code"], "Changed Premium Amount", "Transaction Date"
    return comparable(run_audit(_combined(spark, sf_dir), *named, BATCH_DATE))


def feed_spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow look at one product's rows of a finished feed, by display name."""
    feed = policy_feeds(spark, sf_dir, PERIOD).build("majesco")
    return comparable(
        feed.where("`Product Code` in ('BO')").select(
            "Original Policy Number", "Risk State", "Changed Premium Amount",
            "Accounting Year Month", "Line of Business",
            "Line of Business Exposure Amount - EmpCountTotal",
        )
    )


# SQL side.

_START, _END = (f"DATE '{d.isoformat()}'" for d in PERIOD)
_PERIOD_DATE = """CASE WHEN length(p.acctg_yr_mo_txt) >= 10
    THEN TRY_CAST(substring(p.acctg_yr_mo_txt, 1, 10) AS DATE)
  ELSE TRY_CAST(regexp_extract(p.acctg_yr_mo_txt, '^([0-9]{4})[-_]*([0-9]{1,2})[-_]*$', 1) || '-'
    || lpad(regexp_extract(p.acctg_yr_mo_txt, '^([0-9]{4})[-_]*([0-9]{1,2})[-_]*$', 2), 2, '0')
    || '-01' AS DATE) END"""
_IN_PERIOD = f"{_PERIOD_DATE} BETWEEN {_START} AND {_END}"

_KEYS = ["hash_plcy_id", "hash_cvrg_id", "hash_insd_obj_id", "hash_lob_id", "hash_job_cls_cd_id",
         "hash_cntct_pnt_id"]
_BLANK = ", ".join(
    f"coalesce({c}, '') AS {c}"
    for c in (*_KEYS, "ref_id", "st_prvnc_cd")
)
_BLANK_TRAN = f"(SELECT * REPLACE ({_BLANK}) FROM lnk_prem_tran)"
_BLANK_CVRG = f"(SELECT * REPLACE ({_BLANK}) FROM lnk_plcy_cvrg)"


def _wide(key: str, table: str, kind: str, where: str, measures: dict[str, str], types) -> str:
    cells = [
        f"""(max({{'b': btch_dt, 'v': {value}}})
          FILTER (WHERE coalesce({kind}, 'NA') = '{t}' AND {value} IS NOT NULL)).v
          AS "{prefix} - {t}\""""
        for prefix, value in measures.items()
        for t in types
    ]
    return f"(SELECT {key}, {', '.join(cells)} FROM {table} {where} GROUP BY {key})"


_LINKED = """WHERE rec_src_nm = '109' AND hash_plcy_cvrg_id IN
  (SELECT hash_plcy_cvrg_id FROM lnk_plcy_cvrg WHERE hash_plcy_id IS NOT NULL)"""
_FAMILIES = {
    "Policy Limit Amount": ("lim", ["Aggregate", "NA", "Per Event"]),
    "Coverage Deductible Amount": ("ded", ["Flat", "Percent"]),
    "Coverage Limit Amount": ("clm", ["Building", "Contents", "NA"]),
    "Line of Business Exposure Amount": ("ex", ["EmpCountTotal", "Locations", "NA"]),
    "Line of Business Exposure Base": ("ex", ["EmpCountTotal", "Locations", "NA"]),
    "Coverage Level Schedule Modifier Rate Percent": ("mod", ["Location", "NA", "Safety"]),
}
_LIMITS = _wide("hash_plcy_id", "sat_plcy_lmt", "lmt_tp_cd", "WHERE rec_src_nm = '109'",
                {"Policy Limit Amount": "lmt_amt"}, _FAMILIES["Policy Limit Amount"][1])
_DEDUCTIBLES = _wide("hash_plcy_cvrg_id", "sat_plcy_cvrg_ded", "ded_tp_cd", _LINKED,
                     {"Coverage Deductible Amount": "ded_amt"},
                     _FAMILIES["Coverage Deductible Amount"][1])
_COVERAGE_LIMITS = _wide("hash_plcy_cvrg_id", "sat_plcy_cvrg_lmt", "lmt_tp_cd", _LINKED,
                         {"Coverage Limit Amount": "lmt_amt"},
                         _FAMILIES["Coverage Limit Amount"][1])
_EXPOSURES = _wide("hash_plcy_lob_id", "sat_plcy_lob_expsr", "expsr_tp_cd", "",
                   {"Line of Business Exposure Amount": "expsr_amt",
                    "Line of Business Exposure Base": "expsr_base"},
                   _FAMILIES["Line of Business Exposure Amount"][1])
_MODIFIERS = _wide("ref_id", "sat_sched_mdfr", "sched_mdfr_tp_cd", "WHERE rec_src_nm = '109'",
                   {"Coverage Level Schedule Modifier Rate Percent": "sched_mdfr_rt_pct"},
                   _FAMILIES["Coverage Level Schedule Modifier Rate Percent"][1])

_INSURED = """(SELECT r.hash_plcy_id, o.sic_cd, o.nbr_of_emp_cnt
  FROM lnk_plcy_prty_role r LEFT JOIN sat_org o ON r.hash_prty_id = o.hash_prty_id
  WHERE lower(r.prty_role_tp_cd) = 'insured'
  QUALIFY row_number() OVER (PARTITION BY r.hash_plcy_id
    ORDER BY r.btch_dt DESC, r.hash_plcy_prty_role_id DESC) = 1)"""
_ADDRESS = """(SELECT l.hash_plcy_id, a.pstl_cd, a.city_nm, a.cnty_nm FROM
  (SELECT * FROM lnk_plcy_cntct_pnt WHERE cntct_pnt_tp_cd = 'Primary_Address'
   QUALIFY row_number() OVER (PARTITION BY hash_plcy_id
     ORDER BY btch_dt DESC, hash_cntct_pnt_id) = 1) l
  LEFT JOIN sat_phys_addr a ON l.hash_cntct_pnt_id = a.hash_cntct_pnt_id)"""


def _insurer_rows(source: str) -> str:
    return f"""lnk_plcy_prty_role r JOIN sat_org o ON r.hash_prty_id = o.hash_prty_id
  WHERE r.rec_src_nm = '{source}' AND o.rec_src_nm = '{source}'
    AND lower(r.prty_role_tp_cd) = 'insurer'"""


def _insurer_names(source: str, extra: str = "") -> str:
    return f"""(SELECT DISTINCT r.hash_plcy_id, {extra} first_value(o.org_nm) OVER (
    PARTITION BY r.hash_plcy_id, r.prty_role_tp_cd
    ORDER BY r.btch_dt DESC, o.org_nm DESC NULLS LAST) AS org_nm
  FROM {_insurer_rows(source)})"""


def _insurer_latest(source: str) -> str:
    return f"""(SELECT r.hash_plcy_id, o.org_nm, o.sic_cd, o.ownrsp_tp_cd
  FROM {_insurer_rows(source)}
  QUALIFY row_number() OVER (PARTITION BY r.hash_plcy_id
    ORDER BY r.btch_dt DESC, r.hash_plcy_prty_role_id DESC) = 1)"""


_AGENCY = """(SELECT a.n, a.mstr_acct_nbr, g.dstn_chnnl_cd, g.dest_grp_cd, f.serv_ofc_cd FROM
  (SELECT TRY_CAST(trim(acct_nbr) AS INT) AS n, * FROM sat_agcy_acct_dtl WHERE rec_src_nm = '0036'
   QUALIFY row_number() OVER (PARTITION BY TRY_CAST(trim(acct_nbr) AS INT)
     ORDER BY btch_dt DESC, hash_agcy_acct_id) = 1) a
  LEFT JOIN (SELECT * FROM lnk_agcy_acct_lgl_agcy WHERE rec_src_nm = '0036') l
    ON a.hash_agcy_acct_id = l.hash_agcy_acct_id
  LEFT JOIN (SELECT * FROM sat_lgl_agcy_dtl WHERE rec_src_nm = '0036') g
    ON l.hash_lgl_agcy_id = g.hash_lgl_agcy_id
  LEFT JOIN (SELECT * FROM sat_agcy_acct_lgl_agcy_dtl WHERE rec_src_nm = '0036') f
    ON l.hash_agcy_acct_lgl_agcy_id = f.hash_agcy_acct_lgl_agcy_id)"""
_STATES = "(SELECT lpad(CAST(n_nationkey AS STRING), 2, '0') AS cd, n_name AS nm FROM nation)"
_COMPANIES = "(SELECT CAST(r_regionkey AS STRING) AS cd, r_name AS nm FROM region)"
_NAMES = "(SELECT * FROM ref_lkup WHERE cd_lst = 'IT Application')"
_PRODUCERS = """(SELECT r.hash_plcy_id, s.prodr_nbr
  FROM lnk_plcy_prty_role r JOIN sat_sell_agcy s USING (hash_plcy_prty_role_id)
  WHERE r.prty_role_tp_cd = 'Selling_Agency' AND r.rec_src_nm = '217' AND s.rec_src_nm = '217'
  QUALIFY row_number() OVER (PARTITION BY r.hash_plcy_id
    ORDER BY r.btch_dt DESC, s.prodr_nbr DESC) = 1)"""

_COMMISSION_ROWS = """lnk_prem_tran l LEFT JOIN sat_cmsn s USING (hash_prem_tran_id)
  WHERE l.rec_src_nm = '{source}' AND l.tran_tp_cd IN ({types})"""
_PRWINS_COMMISSION = f"""(SELECT DISTINCT l.hash_plcy_id, s.endrsmt_revsn_nbr, s.cmsn_pct, s.cmsn_amt
  FROM {_COMMISSION_ROWS.format(source='217', types="'Policy_Level_Commission'")})"""
_XM_TYPES = "'Coverage_Level_Commission', 'Endorsement_Level_Commission'"
_XM_COMMISSION = f"""(SELECT DISTINCT l.hash_plcy_id, l.hash_lob_id, l.hash_cvrg_id, l.ref_id,
    s.cmsn_pct, s.cmsn_amt
  FROM {_COMMISSION_ROWS.format(source='220', types=_XM_TYPES)})"""
NET_COMMISSION = f"""(SELECT hash_plcy_id, rf, rev, acctg_yr_mo_txt, max(cmsn_pct) AS cmsn_pct,
    CAST(sum(net_cmsn_amt) AS DECIMAL(18,2)) AS cmsn_amt
  FROM (SELECT l.hash_plcy_id, substring(s.ref_id, 1, 15) AS rf,
      coalesce(s.endrsmt_revsn_nbr, TRY_CAST(substring(s.ref_id, 16, 3) AS INT)) AS rev,
      s.acctg_yr_mo_txt, s.cmsn_pct, s.net_cmsn_amt
    FROM {_COMMISSION_ROWS.format(source='109', types="'Policy_Level_Commission'")}
    QUALIFY row_number() OVER (PARTITION BY l.hash_plcy_id, substring(s.ref_id, 1, 15),
        coalesce(s.endrsmt_revsn_nbr, TRY_CAST(substring(s.ref_id, 16, 3) AS INT))
      ORDER BY l.btch_dt DESC, s.src_eff_dt DESC, l.ref_id DESC, l.hash_prem_tran_id DESC) = 1)
  GROUP BY hash_plcy_id, rf, rev, acctg_yr_mo_txt)"""


def percent_sql(part: str, whole: str) -> str:
    """Percentage rounded half up to two places, in whole numbers; amounts are not negative."""
    n, d = (f"CAST({x} * 100 AS HUGEINT)" for x in (part, whole))
    return f"""coalesce(CASE WHEN {whole} = 0 THEN NULL ELSE
      CAST(((2 * {n} * 10000 + {d}) // (2 * {d})) / 100.0 AS DECIMAL(18,2)) END, 0)"""


COMMISSION_PERCENT = f"""(SELECT c.hash_plcy_id, c.rf, c.rev, c.acctg_yr_mo_txt,
    {percent_sql('n.cmsn_amt', 'c.charged')} AS pct
  FROM (SELECT l.hash_plcy_id, substring(p.ref_id, 1, 15) AS rf, p.endrsmt_revsn_nbr AS rev,
      p.acctg_yr_mo_txt, CAST(sum(p.chgd_prem_amt) AS DECIMAL(18,2)) AS charged
    FROM lnk_prem_tran l JOIN sat_prem p USING (hash_prem_tran_id) WHERE l.rec_src_nm = '109'
    GROUP BY ALL) c
  LEFT JOIN {NET_COMMISSION} n ON c.hash_plcy_id = n.hash_plcy_id AND c.rf = n.rf
    AND c.rev = n.rev AND c.acctg_yr_mo_txt = n.acctg_yr_mo_txt)"""

# Output name to SQL: h hub, d policy, t transaction, p premium, m commission, c coverage link,
# v coverage of the policy, g coverage, i insurer, s insured, a address, o property.
_DATE, _NUMBER = "CAST({} AS STRING)", "CAST({} AS DOUBLE)"
_SHARED = {
    "Source System Name": "n.cd_shrt_desc", "Source System Code": "h.rec_src_nm",
    "Writing Company": "i.org_nm", "Policy Symbol": "d.plcy_sym_cd", "Policy Number": "d.plcy_nbr",
    "Original Policy Number": "d.orgnl_plcy_nbr", "Product Code": "''",
    "Transaction Date": _DATE.format("p.tran_dt"),
    "Transaction Effective Date": _DATE.format("p.tran_eff_dt"),
    "Transaction Type": "t.tran_tp_cd", "Transaction Code": "p.tran_cd",
    "Transaction Desc": "p.tran_descr", "Policy Effective Date": _DATE.format("d.eff_dt"),
    "Policy Expiration Date": _DATE.format("d.exprn_dt"), "Underwriting Year": "year(d.eff_dt)",
    "Accounting Year Month": "p.acctg_yr_mo_txt", "Risk State": "t.st_prvnc_cd",
    "Risk State Code": "t.st_prvnc_cd", "Cell": "v.cell_cd", "Segment Code": "v.sgmt_cd",
    "Financial Line of Business Code": "v.fincl_ln_of_bus_cd",
    "Changed Premium Amount": _NUMBER.format("p.chgd_prem_amt"),
    "Written Premium Amount": _NUMBER.format("p.wrtn_prem_amt"),
    "Commission Percentage": _NUMBER.format("m.cmsn_pct"),
    "Commission Amount": _NUMBER.format("m.cmsn_amt"),
    "Commission Amount (Calculated)": _NUMBER.format(
        "CAST(p.chgd_prem_amt * m.cmsn_pct * 0.01 AS DECIMAL(18,2))"
    ),
    "Transaction Expiration Date": _DATE.format("p.tran_exprn_dt"),
    "Primary Address Zip Code": "a.pstl_cd", "Primary Address City": "a.city_nm",
    "Primary Address County": "a.cnty_nm", "Class Code": "v.cls_cd",
    "Retroactive Date": _DATE.format("d.retro_dt"), "Tail Date": _DATE.format("d.tail_dt"),
    "Coinsurance Value": "v.coins_val", "Policy Event Type Code": "p.plcy_evnt_tp_cd",
    "Renewal Count": "d.rnwl_cnt", "Cancellation Description": "d.canctn_descr",
    "Exposure Amount": _NUMBER.format("v.expsr_amt"), "Exposure Base": "v.expsr_base",
    "Insured SIC Code": "s.sic_cd", "Revision Number": "d.revsn_nbr",
    "Insured Property Location Number": "o.prpty_loc_nbr",
}
_PADDED = [
    "Company Number", "Annual Statement Line of Business", "Coverage Code", "Coverage TP Code",
    "Subline Code", "Claim_Made Indicator", "Reinsurance Code", "Line of Business", "Bureau Type",
    "Distribution Channel", "Group Destination Code", "Service Office", "Master Account Number",
    "Agency Number", "Policy Kind Code", "Program Code", "Organization Code", "Sub Program Code",
    "Business Type Code", "Policy Type Code", "Coverage Part Code", "Market Segment Code",
    "Policy Structure", "Insurer SIC Code", "Ownership Type Code", "Treaty Code",
]


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_SYMBOLS = ["CU", "CCU", "UCU", "VCU", "WCU", "XCU", "YCU", "ZCU"]
_RULES = [("GL", "GL", "560"), ("CPP", "GL", "560"), ("BOP", "BC", "385"), ("BOP", "BC", "662"),
          ("ML", "BC", "362")]
_FLAGS = {
    "Policy Symbol Status": f"""CASE WHEN d.plcy_sym_cd IS NULL THEN ''
      WHEN d.plcy_sym_cd IN ({_in(_SYMBOLS)}) THEN 'InList' ELSE 'NotInList' END""",
    "Major Peril Status": """CASE WHEN g.cvrg_cd IS NULL THEN ''
      WHEN trim(g.cvrg_cd) IN (_PERILS) THEN 'InList' ELSE 'NotInList' END""".replace("_PERILS", _in(codes.MAJOR_PERILS)),
    "Subline Code Status": """CASE WHEN g.subline_cd IS NULL THEN ''
      WHEN substring(lpad(g.subline_cd, CAST(greatest(3, length(g.subline_cd)) AS INT), '0'), 1, 3)
        IN (_SUBLINES) THEN 'InList' ELSE 'NotInList' END""".replace("_SUBLINES", _in(codes.SUBLINES)),
    "EPLI": "CASE WHEN trim(g.cvrg_cd) = '172' OR (y.dstn_chnnl_cd > '01' AND ("
    + " OR ".join(
        f"(b.lob_cd = '{lob}' AND u.tp_bur_cd = '{bur}' AND trim(g.cvrg_cd) = '{code}')"
        for lob, bur, code in _RULES
    )
    + ")) THEN 'E' ELSE '' END",
    "Reinsurance Company Code Status": """CASE WHEN d.reins_co_nbr IS NULL
      OR d.reins_co_nbr IN ('', '0060') THEN '' ELSE 'NotInList' END""",
    "Reins Flag": """CASE WHEN d.reins_co_nbr IS NULL OR d.reins_co_nbr IN ('', '0060')
      THEN '' ELSE 'FALSE' END""",
    "Service Office Status": "CASE WHEN y.serv_ofc_cd = '70' THEN 'InList' ELSE 'NotInList' END",
    "Agency State Status": """CASE
      WHEN TRY_CAST(substring(y.mstr_acct_nbr, 1, 3) AS INT) IS NULL THEN ''
      WHEN TRY_CAST(substring(y.mstr_acct_nbr, 1, 3) AS INT) IN (57, 66) THEN 'InList'
      ELSE 'NotInList' END""",
    "Kind Code Status": """CASE WHEN d.plcy_kind_cd IS NULL THEN '' WHEN d.plcy_kind_cd = 'M'
      THEN 'InList' ELSE 'NotInList' END""",
}

_COVERAGE_TEXT = {"Annual Statement Line of Business": "g.aslob_cd"}
_OWN_COLUMNS = {
    "gain": {
        **_COVERAGE_TEXT, **_FLAGS, "Writing Company": "k.nm", "Risk State": "st.nm",
        "Company Number": "d.co_nbr", "Coverage Code": "g.cvrg_cd",
        "Coverage TP Code": "g.cvrg_tp_cd", "Subline Code": "g.subline_cd",
        "Claim_Made Indicator": "d.clm_made_flg", "Reinsurance Code": "d.reins_co_nbr",
        "Line of Business": "b.lob_cd", "Bureau Type": "u.tp_bur_cd",
        "Distribution Channel": "y.dstn_chnnl_cd", "Group Destination Code": "y.dest_grp_cd",
        "Service Office": "y.serv_ofc_cd", "Master Account Number": "y.mstr_acct_nbr",
        "Agency Number": "CAST(TRY_CAST(trim(d.prodr_nbr) AS INT) AS STRING)",
        "Policy Kind Code": "d.plcy_kind_cd",
    },
    "arrowhead": {
        **_COVERAGE_TEXT, "Source System Name": "'Arrowhead'", "Program Code": "d.pgm_cd",
        "Organization Code": "i.org_cd",
    },
    "prwins": {
        **_COVERAGE_TEXT, "Risk State": "st.nm", "Subline Code": "g.subline_cd",
        "Agency Number": "r.prodr_nbr", "Program Code": "d.pgm_cd",
        "Sub Program Code": "d.sub_pgm_cd", "Business Type Code": "d.bus_tp_cd",
    },
    "esl": {
        **_COVERAGE_TEXT, "Risk State": "d.cntrl_st_cd", "Risk State Code": "d.cntrl_st_cd",
        "Treaty Code": "y.ref_id",
    },
    "majesco": {
        **_COVERAGE_TEXT, "Product Code": "d.prod_cd",
        "Commission Amount (Calculated)": _NUMBER.format(
            "CAST(p.chgd_prem_amt * CAST(q.pct AS DECIMAL(16,2)) * 0.01 AS DECIMAL(18,2))"
        ),
        "Coverage Code": "g.cvrg_cd", "Coverage TP Code": "g.cvrg_tp_cd",
        "Coverage Code Description": "g.cvrg_descr", "Subline Code": "g.subline_cd",
        "Claim_Made Indicator": "v.clm_made_flg", "Line of Business": "g.lob_cd",
        "Program Code": "d.pgm_cd", "Policy Type Code": "d.plcy_tp_cd",
        "Coverage Part Code": "g.cvrg_part_cd", "Market Segment Code": "d.mkt_sgmt_cd",
        "Policy Structure": "d.plcy_strc_cd", "Insurer SIC Code": "i.sic_cd",
        "Ownership Type Code": "i.ownrsp_tp_cd", "Extended RPT Number": "d.extndd_rpt_dt_nbr",
        "Extended Attachment PNT Number": _NUMBER.format("d.excs_attchmt_pnt_amt"),
        "Number Of Employee Count": "s.nbr_of_emp_cnt", "ISO Code": "e.iso_cd",
    },
    "xm": {
        "Commission Amount (Calculated)": _NUMBER.format(
            "CAST(p.chgd_prem_amt * m.cmsn_pct AS DECIMAL(18,2))"
        ),
    },
}
_MAJESCO_FAMILIES = list(_FAMILIES)
_OTHER_FAMILIES = ["Policy Limit Amount", "Coverage Deductible Amount"]


def _same(left: str, right: str, names, null_safe: bool) -> str:
    sign = "IS NOT DISTINCT FROM" if null_safe else "="
    return " AND ".join(f"{left}.{n} {sign} {right}.{n}" for n in names)


_FEED_FROM = "\nFROM (SELECT * FROM hub_plcy WHERE"


def _from(name: str) -> str:
    feed, safe = FEEDS[name], name in ("gain", "prwins", "majesco")
    keys = {"gain": [*_KEYS, "ref_id", "st_prvnc_cd"], "prwins": [*_KEYS, "ref_id"],
            "majesco": [*_KEYS, "ref_id"], "xm": [*_KEYS, "ref_id"]}.get(name, _KEYS)
    links = "lnk_plcy_cvrg" if safe else _BLANK_CVRG
    details = "sat_plcy_cvrg_dtl"
    if name == "xm":
        links = f"""(SELECT * FROM {_BLANK_CVRG} QUALIFY row_number() OVER (
          PARTITION BY {', '.join(keys)} ORDER BY btch_dt DESC, hash_plcy_cvrg_id DESC) = 1)"""
        details = """(SELECT * FROM sat_plcy_cvrg_dtl QUALIFY row_number() OVER (
          PARTITION BY hash_plcy_cvrg_id ORDER BY btch_dt DESC) = 1)"""
    insurer = {
        "gain": f"LEFT JOIN {_COMPANIES} k ON d.co_nbr = k.cd",
        "arrowhead": f"LEFT JOIN {_insurer_names('Arrowhead', 'o.org_cd,')} i USING (hash_plcy_id)",
        "prwins": f"LEFT JOIN {_insurer_names('217')} i USING (hash_plcy_id)",
        "esl": f"LEFT JOIN {_insurer_names('61')} i USING (hash_plcy_id)",
        "majesco": f"LEFT JOIN {_insurer_latest('109')} i USING (hash_plcy_id)",
        "xm": f"LEFT JOIN {_insurer_latest('220')} i USING (hash_plcy_id)",
    }[name].replace("USING (hash_plcy_id)", "ON h.hash_plcy_id = i.hash_plcy_id")
    rf = "substring(p.ref_id, 1, 15)"
    net_on = f"""h.hash_plcy_id = {{0}}.hash_plcy_id AND p.endrsmt_revsn_nbr = {{0}}.rev
      AND {rf} = {{0}}.rf AND p.acctg_yr_mo_txt = {{0}}.acctg_yr_mo_txt"""
    commission = {
        "prwins": f"""LEFT JOIN {_PRWINS_COMMISSION} m ON
          {_same('t', 'm', ['hash_plcy_id'], True)}
          AND p.endrsmt_revsn_nbr IS NOT DISTINCT FROM m.endrsmt_revsn_nbr""",
        "majesco": f"""LEFT JOIN {NET_COMMISSION} m ON {net_on.format('m')}
          LEFT JOIN {COMMISSION_PERCENT} q ON {net_on.format('q')}""",
        "xm": f"""LEFT JOIN {_XM_COMMISSION} m ON
          {_same('t', 'm', ['hash_plcy_id', 'hash_lob_id', 'hash_cvrg_id', 'ref_id'], False)}""",
    }.get(name, "LEFT JOIN sat_cmsn m ON t.hash_prem_tran_id = m.hash_prem_tran_id")
    extra = {
        "gain": f"""LEFT JOIN {_STATES} st ON t.st_prvnc_cd = st.cd
          LEFT JOIN sat_lob_dtl b ON t.hash_lob_id = b.hash_lob_id
          LEFT JOIN sat_plcy_cvrg_sar_dtl u ON c.hash_plcy_cvrg_id = u.hash_plcy_cvrg_id
          LEFT JOIN {_AGENCY} y ON TRY_CAST(trim(d.prodr_nbr) AS INT) = y.n""",
        "prwins": f"""LEFT JOIN {_STATES} st ON t.st_prvnc_cd = st.cd
          LEFT JOIN {_PRODUCERS} r ON h.hash_plcy_id = r.hash_plcy_id""",
        "esl": "LEFT JOIN sat_trty_dtl y ON t.hash_trty_id = y.hash_trty_id",
        "majesco": f"""LEFT JOIN {_COVERAGE_LIMITS} clm ON
            c.hash_plcy_cvrg_id = clm.hash_plcy_cvrg_id
          LEFT JOIN (SELECT l.hash_plcy_id, l.hash_lob_id, x.iso_cd FROM lnk_plcy_lob l
            LEFT JOIN sat_plcy_lob_dtl x USING (hash_plcy_lob_id)) e
            ON {_same('t', 'e', ['hash_plcy_id', 'hash_lob_id'], True)}
          LEFT JOIN (SELECT l.hash_plcy_id, l.hash_lob_id, x.* EXCLUDE (hash_plcy_lob_id)
            FROM lnk_plcy_lob l LEFT JOIN {_EXPOSURES} x USING (hash_plcy_lob_id)) ex
            ON {_same('t', 'ex', ['hash_plcy_id', 'hash_lob_id'], True)}
          LEFT JOIN {_MODIFIERS} mod ON t.ref_id = mod.ref_id""",
    }.get(name, "")
    trans = f"(SELECT * FROM {'lnk_prem_tran' if safe else _BLANK_TRAN} WHERE tran_tp_cd IN ({_in(feed.types)}))"
    return f"""FROM (SELECT * FROM hub_plcy WHERE rec_src_nm = '{feed.source}') h
  JOIN sat_plcy_dtl d ON {_same('h', 'd', ['hash_plcy_id'], safe)}
  JOIN {trans} t
    ON {_same('h', 't', ['hash_plcy_id'], safe)}
  LEFT JOIN {links} c ON {_same('c', 't', keys, safe)}
  {'JOIN' if name == 'majesco' else 'LEFT JOIN'} {details} v
    ON c.hash_plcy_cvrg_id = v.hash_plcy_cvrg_id
  LEFT JOIN sat_prem p ON t.hash_prem_tran_id = p.hash_prem_tran_id
  {commission}
  {insurer}
  LEFT JOIN {_INSURED} s ON h.hash_plcy_id = s.hash_plcy_id
  LEFT JOIN {_NAMES} n ON h.rec_src_nm = n.cd_val
  LEFT JOIN sat_cvrg_dtl g ON t.hash_cvrg_id = g.hash_cvrg_id
  LEFT JOIN {_ADDRESS} a ON h.hash_plcy_id = a.hash_plcy_id
  LEFT JOIN {_LIMITS} lim ON h.hash_plcy_id = lim.hash_plcy_id
  LEFT JOIN {_DEDUCTIBLES} ded ON c.hash_plcy_cvrg_id = ded.hash_plcy_cvrg_id
  LEFT JOIN sat_ins_obj_prop o ON t.hash_insd_obj_id = o.hash_insd_obj_id
  {extra}
  WHERE h.rec_src_nm = '{feed.source}' AND t.tran_tp_cd IN ({_in(feed.types)})"""


def _policy_select(name: str, period: bool, flags: bool = False, rename=str) -> str:
    columns = {**_SHARED, **dict.fromkeys(_PADDED, "''"), **_OWN_COLUMNS[name]}
    if not flags:
        columns = {k: v for k, v in columns.items() if k not in _FLAGS}
    for family in _MAJESCO_FAMILIES if name == "majesco" else _OTHER_FAMILIES:
        alias, types = _FAMILIES[family]
        for t in types:
            cell = f'{alias}."{family} - {t}"'
            text = family.endswith("Base")
            columns[f"{family} - {t}"] = cell if text else _NUMBER.format(cell)
    items = ",\n  ".join(f'{sql} AS "{rename(n)}"' for n, sql in columns.items())
    sql = f"SELECT {items}\n{_from(name)}"
    if period:
        sql += f"\n  AND {_IN_PERIOD}"
    if name == "majesco":
        sql += "\n  AND coalesce(p.bndr_flg, 'N') = 'N' AND d.prod_cd IN ('BO', 'MP')"
    if name == "xm":
        sql += """\n  QUALIFY row_number() OVER (PARTITION BY h.hash_plcy_id, t.ref_id ORDER BY
      t.btch_dt DESC, t.hash_prem_tran_id DESC, c.btch_dt DESC NULLS LAST,
      c.hash_plcy_cvrg_id DESC NULLS LAST, m.cmsn_pct DESC NULLS LAST,
      m.cmsn_amt DESC NULLS LAST, o.prpty_loc_nbr DESC NULLS LAST) = 1"""
    return sql


def _tables_of(sql: str) -> str:
    return with_tables(sql)


def policy_sql(name: str) -> str:
    return _tables_of(_policy_select(name, name in WITH_PERIOD, flags=name == "gain"))


def combined_policies_sql(select: str = "SELECT * FROM feeds") -> str:
    parts = [f"SELECT * FROM ({_policy_select(n, True)})" for n in FEEDS]
    union = "\nUNION ALL BY NAME\n".join(parts)
    return _tables_of(select.replace("FROM feeds", f"FROM ({union})"))


def _file_name(column: str) -> str:
    text = "".join(c if c.isalnum() else "_" for c in column.replace(" ", ""))
    while "__" in text:
        text = text.replace("__", "_")
    return text


def formatted_sql() -> str:
    feed = _policy_select("majesco", True, rename=_file_name)
    return _tables_of(f"""SELECT * REPLACE (CAST(CAST("TransactionDate" AS DATE) AS STRING) AS "TransactionDate")
FROM ({feed})""")


def spot_check_sql() -> str:
    feed = _policy_select("majesco", True)
    return _tables_of(f"""SELECT "Original Policy Number", "Risk State", "Changed Premium Amount",
  "Accounting Year Month", "Line of Business", "Line of Business Exposure Amount - EmpCountTotal"
FROM ({feed}) WHERE "Product Code" = 'BO'""")


def reconcile_sql() -> str:
    counts = []
    for name in ("majesco", "prwins"):
        safe = "IS NOT DISTINCT FROM"
        keys = _same("c", "t", [*_KEYS, "ref_id"], True)
        more = ""
        own = f"SELECT hash_plcy_id FROM hub_plcy WHERE rec_src_nm = '{FEEDS[name].source}'"
        if name == "majesco":
            more = "AND coalesce(p.bndr_flg, 'N') = 'N'"
            own += """ AND hash_plcy_id IN
              (SELECT hash_plcy_id FROM sat_plcy_dtl WHERE prod_cd IN ('BO', 'MP'))"""
        base = f"""FROM ({own}) h JOIN lnk_prem_tran t ON h.hash_plcy_id {safe} t.hash_plcy_id
          JOIN sat_prem p ON t.hash_prem_tran_id = p.hash_prem_tran_id CORE
          WHERE t.tran_tp_cd IN ({_in(FEEDS[name].types)}) AND {_IN_PERIOD} {more}"""
        core = f"{'JOIN' if name == 'majesco' else 'LEFT JOIN'} lnk_plcy_cvrg c ON {keys}"
        if name == "majesco":
            core += " JOIN sat_plcy_cvrg_dtl v ON c.hash_plcy_cvrg_id = v.hash_plcy_cvrg_id"
        counts += [
            f"SELECT '{name} feed' AS stage, count(*) AS row_count "
            f"FROM ({_policy_select(name, True)})",
            f"SELECT '{name} core', count(*) {base.replace('CORE', core)}",
            f"SELECT '{name} base', count(*) {base.replace('CORE', '')}",
        ]
    return _tables_of("\nUNION ALL\n".join(counts))


def reconciled_sql(name: str) -> str:
    feed, safe = FEEDS[name], name in ("gain", "prwins", "majesco")
    keys = {"gain": [*_KEYS, "ref_id", "st_prvnc_cd"], "prwins": [*_KEYS, "ref_id"],
            "majesco": [*_KEYS, "ref_id"], "xm": [*_KEYS, "ref_id"]}.get(name, _KEYS)
    trans, links = ("lnk_prem_tran", "lnk_plcy_cvrg") if safe else (_BLANK_TRAN, _BLANK_CVRG)
    own = f"SELECT hash_plcy_id FROM hub_plcy WHERE rec_src_nm = '{feed.source}'"
    more = last = ""
    join, detail = "LEFT JOIN", ""
    if name == "majesco":
        own += " AND hash_plcy_id IN (SELECT hash_plcy_id FROM sat_plcy_dtl WHERE prod_cd IN ('BO', 'MP'))"
        more, join = "AND coalesce(p.bndr_flg, 'N') = 'N'", "JOIN"
        detail = "JOIN sat_plcy_cvrg_dtl v ON c.hash_plcy_cvrg_id = v.hash_plcy_cvrg_id"
    if name == "xm":
        last = """QUALIFY row_number() OVER (PARTITION BY t.hash_plcy_id, t.ref_id
          ORDER BY t.btch_dt DESC, t.hash_prem_tran_id DESC) = 1"""
    base = f"""SELECT t.*, p.chgd_prem_amt FROM ({own}) h
      JOIN {trans} t ON {_same('h', 't', ['hash_plcy_id'], safe)}
      JOIN sat_prem p ON t.hash_prem_tran_id = p.hash_prem_tran_id
      WHERE t.tran_tp_cd IN ({_in(feed.types)}) AND {_IN_PERIOD} {more} {last}"""
    finished = _policy_select(name, True)
    rows = f"SELECT t.hash_prem_tran_id AS id, p.chgd_prem_amt AS amount {finished[finished.index(_FEED_FROM) :]}"
    total = "count(*) AS row_count, CAST(sum(amount) AS DOUBLE) AS premium"
    return _tables_of(f"""SELECT 'feed' AS stage, {total} FROM ({rows})
UNION ALL SELECT 'core', count(*), CAST(sum(t.chgd_prem_amt) AS DOUBLE)
  FROM ({base}) t {join} {links} c ON {_same('c', 't', keys, safe)} {detail}
UNION ALL SELECT 'base', count(*), CAST(sum(t.chgd_prem_amt) AS DOUBLE) FROM ({base}) t
UNION ALL SELECT 'repeated', {total}
  FROM (SELECT id, sum(amount) AS amount FROM ({rows}) GROUP BY id HAVING count(*) > 1)""")


#: Alias in the SQL to the tag of the side dataset, and the aliases that its join hangs on besides the transaction.
_SIDES = {
    "t": ("txn", ""), "p": ("prm", ""), "h": ("hub", "t"), "d": ("pol", "th"), "c": ("lnk", "t"), "v": ("cov", "tc"),
    "ded": ("ded", "tc"), "u": ("bur", "tc"), "clm": ("clm", "tc"), "m": ("cms", "tp"), "q": ("pct", "tp"),
    "i": ("insr", "th"), "k": ("comp", "thd"), "s": ("insd", "th"), "n": ("src", "th"), "a": ("adr", "th"),
    "lim": ("lim", "th"), "r": ("prod", "th"), "g": ("cvg", "t"), "o": ("prop", "t"), "st": ("st", "t"),
    "b": ("lob", "t"), "e": ("iso", "t"), "ex": ("exp", "t"), "mod": ("mod", "t"),
}


def _with_row_numbers(source: str) -> tuple[str, list[str]]:
    """A FROM clause whose sources, at its own level, have a number per row in `rid`; and their aliases."""
    out, aliases, at, depth = [], [], 0, 0
    word = re.compile(r"\(|\)|(?<!DISTINCT )\b(?:FROM|JOIN)\s+")
    while m := word.search(source, at):
        out.append(source[at : m.end()])
        at = m.end()
        if m[0] in "()":
            depth += 1 if m[0] == "(" else -1
        elif depth == 0:
            end, inner = at, 0
            while inner or not source[end].isspace():
                inner += {"(": 1, ")": -1}.get(source[end], 0)
                end += 1
            alias = re.compile(r"\s+(\w+)").match(source, end)
            out.append(f"(SELECT *, row_number() OVER () AS rid FROM {source[at:end]})")
            aliases.append(alias[1])
            at = end
    return "".join([*out, source[at:]]), aliases


def fan_out_sql(name: str) -> str:
    """A side is a culprit if a transaction's rows hold several of its rows below one row of what it hangs on."""
    finished = _policy_select(name, True)
    rest = finished[finished.index(_FEED_FROM) :]
    rest, aliases = _with_row_numbers(rest)
    tags = {a: ("trty", "t") if (name, a) == ("esl", "y") else ("agy", "thd") if a == "y" else _SIDES[a] for a in aliases}
    held = ", ".join(f"{a}.rid AS {a}" for a in aliases)
    culprits = "\nUNION ALL ".join(
        f"SELECT DISTINCT id, '{tag}' AS tag FROM held GROUP BY {', '.join(['id', *above])} HAVING count(DISTINCT {a}) > 1"
        for a, (tag, above) in tags.items()
    )
    return _tables_of(f"""SELECT id AS txn_hash_prem_tran_id, row_count, coalesce(culprits, '') AS culprits FROM
  (WITH held AS MATERIALIZED (SELECT t.hash_prem_tran_id AS id, {held} {rest})
   SELECT n.id, n.row_count, c.culprits FROM (SELECT id, count(*) AS row_count FROM held GROUP BY id HAVING count(*) > 1) n
   LEFT JOIN (SELECT id, string_agg(tag, ',' ORDER BY tag) AS culprits FROM ({culprits}) GROUP BY id) c
     ON n.id IS NOT DISTINCT FROM c.id)""")


def repeated_sql() -> str:
    return _tables_of(f"""SELECT t.hash_prem_tran_id AS txn_hash_prem_tran_id,
  c.hash_plcy_cvrg_id AS lnk_hash_plcy_cvrg_id,
  count(*) OVER (PARTITION BY t.hash_prem_tran_id) AS cnt
FROM (SELECT * FROM hub_plcy WHERE rec_src_nm = 'Arrowhead') h
JOIN {_BLANK_TRAN} t ON h.hash_plcy_id = t.hash_plcy_id
LEFT JOIN {_BLANK_CVRG} c ON {_same('c', 't', _KEYS, False)}
WHERE t.tran_tp_cd = 'Coverage_Level_Premium'
QUALIFY cnt > 1""")


def audit_sql() -> str:
    return combined_policies_sql(f"""SELECT "Source System Code", count(*) AS row_count,
  CAST(sum(CAST("Changed Premium Amount" AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  max("Transaction Date") AS newest_date, '{BATCH_DATE}' AS batch_date
FROM feeds GROUP BY "Source System Code\"""")


# Claims.

_CLAIM = {
    "Claim Source Name": "n.cd_shrt_desc", "Claim Source Code": "c.rec_src_nm",
    "UW Source Name": "c.src_sys_rec_nm", "Accounting Year": "CAST(x.acctg_yr_nbr AS STRING)",
    "Accounting Month": "CAST(x.acctg_mo_nbr AS STRING)", "Writing Company": "i.org_nm",
    "Claim Number": "c.clm_nbr", "Claim Public Id": "c.clm_pub_id", "Policy Number": "c.plcy_nbr",
    "Policy Effective Date": _DATE.format("c.plcy_eff_dt"),
    "Transaction Date": _DATE.format("x.tran_dt"), "Transaction Type": "x.tran_tp_descr",
    "Cost Type": "x.cost_tp_descr", "Cost Category Code": "x.cost_ctgry_cd",
    "Cost Category Type": "x.cost_ctgry_descr", "Claim Status": "c.clm_sts_descr",
    "Date of Loss": _DATE.format("c.loss_dt"), "Accident Year": "CAST(year(c.loss_dt) AS STRING)",
    "Loss State": "c.loss_loc_st_cd", "Erode Reserve Flag": "x.erd_rsrv_flg", "Cell": "c.cell_cd",
    "Segment Code": "c.sgmt_cd", "Financial Line of Business": "c.fincl_ln_of_bus_cd",
    "Transaction Amount": _NUMBER.format("x.tran_amt"), "Reserve Line Public Id": "x.rsrv_ln_id",
    "Batch Date": _DATE.format("x.btch_dt"), "Transaction Status": "x.tran_sts_descr",
    "Retired Flag": "x.retrd_flg",
}
_ESL_CLAIM = {"Claim Source Code": "d.rec_src_nm", "Transaction Type": "x.tran_tp_cd",
              "Policy Effective Date": _DATE.format("d.eff_dt")}
_CLAIM_OWN = {
    "center": {"Writing Company": "c.wrtg_co_nm", "Loss State": "c.loss_loc_st_nm",
               "Cell": "z.cell_cd", "Segment Code": "z.sgmt_cd",
               "Financial Line of Business": "z.fincl_ln_of_bus_cd"},
    "esl": _ESL_CLAIM,
    "esl_reserve": _ESL_CLAIM,
    "juris": {"Writing Company": "c.wrtg_co_cd", "Claim Status": "c.clm_sts_cd"},
}
_CLAIM_SOURCE = {"center": "45", "esl": "61", "esl_reserve": "61", "juris": "105"}


def _claim_select(name: str) -> str:
    columns = {**_CLAIM, **_CLAIM_OWN[name]}
    links = "lnk_clm_plcy"
    if name == "center":
        links = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hash_clm_id
          ORDER BY btch_dt DESC, hash_plcy_id DESC) AS rn FROM lnk_clm_plcy)
          WHERE rn = 1 AND rec_src_nm = '45')"""
    where = "(x.acctg_yr_nbr = 1999 AND x.acctg_mo_nbr = 12) OR x.acctg_yr_nbr = 2000"
    if name == "esl_reserve":
        where = "x.tran_tp_cd = 'Reserve'"
    items = ",\n  ".join(f'{sql} AS "{n}"' for n, sql in columns.items())
    insurer = f"LEFT JOIN {_insurer_names('61')} i ON l.hash_plcy_id = i.hash_plcy_id"
    exposure = "LEFT JOIN sat_expsr_dtl z ON k.hash_expsr_id = z.hash_expsr_id"
    return f"""SELECT {items}
FROM sat_clm_dtl c
  LEFT JOIN {links} l ON c.hash_clm_id = l.hash_clm_id
  LEFT JOIN sat_plcy_dtl d ON l.hash_plcy_id = d.hash_plcy_id
  {insurer if name.startswith('esl') else ''}
  LEFT JOIN lnk_clm_tran k ON c.hash_clm_id = k.hash_clm_id
  LEFT JOIN sat_clm_tran_dtl x ON k.hash_clm_fincl_tran_id = x.hash_clm_fincl_tran_id
  {exposure if name == 'center' else ''}
  LEFT JOIN {_NAMES} n ON c.rec_src_nm = n.cd_val
WHERE c.rec_src_nm = '{_CLAIM_SOURCE[name]}' AND ({where})"""


def claim_sql(name: str) -> str:
    return _tables_of(_claim_select(name))


def combined_claims_sql() -> str:
    return _tables_of("\nUNION ALL BY NAME\n".join(
        f"SELECT *, '{n}' AS \"Branch\" FROM ({_claim_select(n)})" for n in _CLAIM_SOURCE
    ))


def sliced_claims_sql() -> str:
    union = "\nUNION ALL BY NAME\n".join(f"SELECT * FROM ({_claim_select(n)})" for n in _CLAIM_SOURCE)
    return _tables_of(f"""SELECT * FROM ({union}) WHERE "Accounting Year" IS NULL
  OR ("Accounting Year" = '1999' AND "Accounting Month" = '12')
  OR ("Accounting Year" = '2000' AND CAST("Accounting Month" AS INT) < 12)""")


def claim_changes_sql() -> str:
    before = """(SELECT hash_clm_fincl_tran_id, lead(tran_amt) OVER (
    PARTITION BY k.hash_clm_id, cost_ctgry_cd, cost_tp_descr, rsrv_ln_id, tran_tp_cd
    ORDER BY tran_dt DESC, hash_clm_fincl_tran_id DESC) AS amount
  FROM lnk_clm_tran k JOIN sat_clm_tran_dtl USING (hash_clm_fincl_tran_id))"""
    more = """, CAST(b.amount AS DOUBLE) AS "Previous Amount",
  CAST(x.tran_amt - b.amount AS DOUBLE) AS "Change In Amount"
FROM sat_clm_dtl c"""
    where = f"""
  LEFT JOIN {before} b ON k.hash_clm_fincl_tran_id = b.hash_clm_fincl_tran_id
WHERE c.rec_src_nm"""
    sql = _claim_select("juris").replace("\nFROM sat_clm_dtl c", more)
    return _tables_of(sql.replace("\nWHERE c.rec_src_nm", where))


def claims_of_a_year_sql() -> str:
    union = "\nUNION ALL BY NAME\n".join(
        f"SELECT *, '{n}' AS \"Branch\" FROM ({_claim_select(n)})" for n in _CLAIM_SOURCE
    )
    return _tables_of(f"""SELECT * FROM ({union})
WHERE "Accounting Year" IS NULL OR "Accounting Year" = '2000'""")


# Side datasets: each as a query of its own.


def _part(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(build(parts(spark, sf_dir)))


def _money_cells(alias: str, family: str) -> str:
    cells = [f'{alias}."{family} - {t}"' for t in _FAMILIES[family][1]]
    return ", ".join(f"{_NUMBER.format(c)} AS {c.partition('.')[2]}" for c in cells)


def _exposure_sql() -> str:
    amounts = _money_cells("x", "Line of Business Exposure Amount")
    bases = ", ".join(
        f'x."Line of Business Exposure Base - {t}"'
        for t in _FAMILIES["Line of Business Exposure Base"][1]
    )
    return f"""SELECT l.hash_plcy_id, l.hash_lob_id, {amounts}, {bases}
FROM lnk_plcy_lob l LEFT JOIN {_EXPOSURES} x USING (hash_plcy_lob_id)"""


_PARTS = {
    "primary_address": (lambda p: p.primary_address(), f"SELECT * FROM {_ADDRESS}"),
    "insured_party": (lambda p: p.insured(), f"SELECT * FROM {_INSURED}"),
    "insurer_latest": (
        lambda p: p.insurer_latest("109"),
        f"SELECT * FROM {_insurer_latest('109')}",
    ),
    "insurer_names": (
        lambda p: p.insurer_names("Arrowhead", with_code=True),
        f"SELECT * FROM {_insurer_names('Arrowhead', 'o.org_cd,')}",
    ),
    "producer_numbers": (lambda p: p.producers("217"), f"SELECT * FROM {_PRODUCERS}"),
    "agency_chain": (
        lambda p: p.agencies(),
        f"SELECT n AS acct_number, * EXCLUDE (n) FROM {_AGENCY}",
    ),
    "company_list": (
        lambda p: p.companies(),
        f'SELECT cd AS "Company_Code", nm AS "Company_Name" FROM {_COMPANIES}',
    ),
    "state_list": (lambda p: p.states(), f'SELECT cd AS "Code" FROM {_STATES}'),
    "policy_revision_commission": (
        lambda p: p.policy_revision_commission("217"),
        f"""SELECT hash_plcy_id, CAST(endrsmt_revsn_nbr AS BIGINT) AS endrsmt_revsn_nbr,
  CAST(cmsn_pct AS DOUBLE) AS cmsn_pct, CAST(cmsn_amt AS DOUBLE) AS cmsn_amt
FROM {_PRWINS_COMMISSION}""",
    ),
    "coverage_commission": (
        lambda p: p.coverage_commission("220"),
        f"""SELECT * REPLACE (CAST(cmsn_pct AS DOUBLE) AS cmsn_pct,
  CAST(cmsn_amt AS DOUBLE) AS cmsn_amt) FROM {_XM_COMMISSION}""",
    ),
    "policy_limits": (
        lambda p: p.policy_limits(),
        f"SELECT hash_plcy_id, {_money_cells('w', 'Policy Limit Amount')} FROM {_LIMITS} w",
    ),
    "coverage_deductibles": (
        lambda p: p.coverage_deductibles(),
        f"""SELECT hash_plcy_cvrg_id, {_money_cells('w', 'Coverage Deductible Amount')}
FROM {_DEDUCTIBLES} w""",
    ),
    "coverage_limits": (
        lambda p: p.coverage_limits(),
        f"""SELECT hash_plcy_cvrg_id, {_money_cells('w', 'Coverage Limit Amount')}
FROM {_COVERAGE_LIMITS} w""",
    ),
    "schedule_modifiers": (
        lambda p: p.schedule_modifiers(),
        f"""SELECT ref_id, {_money_cells('w', 'Coverage Level Schedule Modifier Rate Percent')}
FROM {_MODIFIERS} w""",
    ),
    "lob_exposures": (lambda p: p.lob_exposures(), _exposure_sql()),
    "lob_iso_codes": (
        lambda p: p.lob_iso_codes(),
        """SELECT l.hash_plcy_id, l.hash_lob_id, x.iso_cd
FROM lnk_plcy_lob l LEFT JOIN sat_plcy_lob_dtl x USING (hash_plcy_lob_id)""",
    ),
}

QUERIES = {
    **{f"feed_{n}": partial(policy_feed, n) for n in FEEDS},
    "union_feeds": combined_policies,
    "claims_center": partial(claim_feed, "center"),
    "claims_esl": partial(claim_feed, "esl"),
    "claims_juris": partial(claim_feed, "juris"),
    "claims_esl_reserve": partial(claim_feed, "esl_reserve"),
    "claims_juris_changes": claim_changes,
    "union_claims": combined_claims,
    "claims_slice_null_period": sliced_claims,
    "claims_slice_last_year": claims_of_a_year,
    "formatted_extract": formatted_feed,
    "reconcile_counts": reconciled_feed,
    **{f"reconcile_{n}": partial(reconciled, n) for n in FEEDS},
    **{f"fan_out_{n}": partial(fan_out, n) for n in FEEDS},
    "feed_duplicates": repeated_transactions,
    "run_audit": feed_audit,
    "spot_check": feed_spot_check,
    **{name: _part(build) for name, (build, _) in _PARTS.items()},
}

ORACLES = {
    **{f"feed_{n}": policy_sql(n) for n in FEEDS},
    "union_feeds": combined_policies_sql(),
    "claims_center": claim_sql("center"),
    "claims_esl": claim_sql("esl"),
    "claims_juris": claim_sql("juris"),
    "claims_esl_reserve": claim_sql("esl_reserve"),
    "claims_juris_changes": claim_changes_sql(),
    "union_claims": combined_claims_sql(),
    "claims_slice_null_period": sliced_claims_sql(),
    "claims_slice_last_year": claims_of_a_year_sql(),
    "formatted_extract": formatted_sql(),
    "reconcile_counts": reconcile_sql(),
    **{f"reconcile_{n}": reconciled_sql(n) for n in FEEDS},
    **{f"fan_out_{n}": fan_out_sql(n) for n in FEEDS},
    "feed_duplicates": repeated_sql(),
    "run_audit": audit_sql(),
    "spot_check": spot_check_sql(),
    **{name: with_tables(sql) for name, (_, sql) in _PARTS.items()},
}
