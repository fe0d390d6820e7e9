"""Side datasets, each built once at its own grain and joined to a feed by key."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultfeed.functions import codes
from vaultfeed.functions.measures import percent_of
from vaultfeed.functions.period import text_in_range
from vaultfeed.operators.joins import (
    ROWS_PER_TASK,
    Hot,
    blank_filled,
    hot_keys,
    restrict_to,
    same,
    spread_join,
)
from vaultfeed.operators.newest import first_value_per_key, latest_per_key, newest_first
from vaultfeed.operators.shape import union_by_name
from vaultfeed.operators.widen import NULL_TYPE, widen
from vaultfeed.plans import columns
from vaultfeed.sources.lookups import json_lookup

AGENCY_SOURCE = "0036"
ATTRIBUTE_SOURCE = "109"

# Where each family of wide columns comes from.
FAMILIES = {
    columns.POLICY_LIMIT: ("sat_plcy_lmt", "lmt_tp_cd"),
    columns.DEDUCTIBLE: ("sat_plcy_cvrg_ded", "ded_tp_cd"),
    columns.COVERAGE_LIMIT: ("sat_plcy_cvrg_lmt", "lmt_tp_cd"),
    columns.EXPOSURE_AMOUNT: ("sat_plcy_lob_expsr", "expsr_tp_cd"),
    columns.MODIFIER: ("sat_sched_mdfr", "sched_mdfr_tp_cd"),
}

# Keys and fields of the code lists held as JSON text.
COMPANIES = ("DM_GAIN_UW_COMP", "Company_Code string, Company_Name string")
STATES_WITH_NAME = ("DIM_STATE_CODE_WINS", "CDKEY3 string, CDDESC string")
STATES = ("ISO_STATE_CODE", "Code string")
SOURCE_NAME_LIST = "IT Application"

COVERAGE_KEYS = (
    "hash_plcy_id", "hash_cvrg_id", "hash_insd_obj_id", "hash_lob_id", "hash_job_cls_cd_id",
    "hash_cntct_pnt_id",
)


def _of_policies(df: DataFrame, own: DataFrame | None) -> DataFrame:
    """Rows of the given policies; all rows if none are given."""
    return df if own is None else restrict_to(df, own, same("hash_plcy_id"), null_safe=True)


class Parts:
    """The side datasets of one warehouse.

    ``types`` names the types of a family of wide columns; families left out are read from the
    data when a dataset needs them; a family of more than ``max_types`` is an error, since each
    type becomes a column. ``min_hot_rows`` is the row count above which a key is
    spread over several tasks. Where a dataset takes ``own``, a frame of policy ids, only their
    rows are built: a feed of one source then leaves the rows of the others alone.
    """

    def __init__(
        self,
        warehouse: Mapping[str, DataFrame],
        types: Mapping[str, Sequence[str]] | None = None,
        min_hot_rows: int = ROWS_PER_TASK,
        hot: dict[str, dict[str, Hot]] | None = None,
        max_types: int = 1_000,
    ):
        self.warehouse = warehouse
        self._types = dict(types or {})
        self.min_hot_rows = min_hot_rows
        self.max_types = max_types
        self._hot = {} if hot is None else hot
        self._finding = Lock()

    def __getitem__(self, table: str) -> DataFrame:
        return self.warehouse[table]

    def over(self, warehouse: Mapping[str, DataFrame]) -> Parts:
        """The same datasets over part of the warehouse, with the types and hot keys of the whole."""
        return Parts(warehouse, self.types, self.min_hot_rows, self._hot, self.max_types)

    # Hot keys: one pass per link table, on first use.

    def _hot_of(
        self, label: str, df: DataFrame, sets: Mapping[str, Sequence[str]]
    ) -> dict[str, Hot]:
        if label not in self._hot:
            there = {n: cols for n, cols in sets.items() if set(cols) <= set(df.columns)}
            self._hot[label] = hot_keys(df, there, self.min_hot_rows)
        return self._hot[label]

    def hot_transactions(self, blank: bool) -> dict[str, Hot]:
        link = self["lnk_prem_tran"]
        return self._hot_of(
            f"transactions blank={blank}",
            blank_filled(link) if blank else link,
            {
                "policy": ["hash_plcy_id"],
                "coverage": ["hash_cvrg_id"],
                "object": ["hash_insd_obj_id"],
                "lob": ["hash_lob_id"],
                "state": ["st_prvnc_cd"],
                "treaty": ["hash_trty_id"],
                "reference": ["ref_id"],
                "policy_lob": ["hash_plcy_id", "hash_lob_id"],
                "link6": list(COVERAGE_KEYS),
                "link7": [*COVERAGE_KEYS, "ref_id"],
                "link8": [*COVERAGE_KEYS, "ref_id", "st_prvnc_cd"],
            },
        )

    def hot_roles(self) -> Hot:
        sets = {"party": ["hash_prty_id"]}
        return self._hot_of("roles", self["lnk_plcy_prty_role"], sets)["party"]

    def hot_claims(self) -> dict[str, Hot]:
        sets = {"claim": ["hash_clm_id"], "exposure": ["hash_expsr_id"]}
        return self._hot_of("claims", self["lnk_clm_tran"], sets)

    # Families of wide columns.

    @property
    def types(self) -> dict[str, list[str]]:
        """The types of every family."""
        return self.types_of(FAMILIES)

    def types_of(self, families: Iterable[str]) -> dict[str, list[str]]:
        """The types of these families; those not known yet are read in one job, once, and no other family's table."""
        with self._finding:
            missing = [f for f in families if f not in self._types]
            if missing:
                parts = []
                for family in missing:
                    table, type_column = FAMILIES[family]
                    type_name = F.coalesce(F.col(type_column), F.lit(NULL_TYPE))
                    rows = self._attribute_rows(table)
                    parts.append(rows.select(F.lit(family).alias("f"), type_name.alias("t")).distinct())
                rows = union_by_name([p.limit(self.max_types + 1) for p in parts]).collect()
                for family in missing:
                    found = sorted(r["t"] for r in rows if r["f"] == family)
                    if len(found) > self.max_types:
                        raise ValueError(
                            f"{family}: more than {self.max_types} types; name the ones to widen,"
                            " or raise max_types"
                        )
                    self._types[family] = found
            known = {f: sorted(t) for f, t in self._types.items()}
        if columns.EXPOSURE_AMOUNT in known:
            known[columns.EXPOSURE_BASE] = known[columns.EXPOSURE_AMOUNT]
        return known

    def _attribute_rows(self, table: str) -> DataFrame:
        df = self[table]
        if table == "sat_plcy_lob_expsr":
            return df
        return df.filter(F.col("rec_src_nm") == ATTRIBUTE_SOURCE)

    def _widen(self, family: str, key: str, measures: Mapping[str, str], rows: DataFrame):
        newest = ["btch_dt"] if "btch_dt" in rows.columns else []
        type_column = FAMILIES[family][1]
        return widen(rows, [key], type_column, measures, self.types_of([family])[family], newest)

    def policy_limits(self, own: DataFrame | None = None) -> DataFrame:
        rows = _of_policies(self._attribute_rows("sat_plcy_lmt"), own)
        family = columns.POLICY_LIMIT
        return self._widen(family, "hash_plcy_id", {family: "lmt_amt"}, rows)

    def _of_coverages(
        self, table: str, linked_only: bool, own: DataFrame | None = None
    ) -> DataFrame:
        rows = self._attribute_rows(table)
        if own is not None:
            return restrict_to(rows, own, same("hash_plcy_cvrg_id"))
        if not linked_only:
            return rows
        linked = self["lnk_plcy_cvrg"].filter(F.col("hash_plcy_id").isNotNull())
        return restrict_to(rows, linked, same("hash_plcy_cvrg_id"))

    def coverage_deductibles(
        self, linked_only: bool = True, own: DataFrame | None = None
    ) -> DataFrame:
        """Deductibles of coverages that belong to a policy; a join from the link needs no check.

        ``own``, rows of the coverage link, leaves those of other coverages out before widening.
        """
        family = columns.DEDUCTIBLE
        rows = self._of_coverages("sat_plcy_cvrg_ded", linked_only, own)
        return self._widen(family, "hash_plcy_cvrg_id", {family: "ded_amt"}, rows)

    def coverage_limits(
        self, linked_only: bool = True, own: DataFrame | None = None
    ) -> DataFrame:
        family = columns.COVERAGE_LIMIT
        rows = self._of_coverages("sat_plcy_cvrg_lmt", linked_only, own)
        return self._widen(family, "hash_plcy_cvrg_id", {family: "lmt_amt"}, rows)

    def schedule_modifiers(self) -> DataFrame:
        family = columns.MODIFIER
        rows = self._attribute_rows("sat_sched_mdfr")
        return self._widen(family, "ref_id", {family: "sched_mdfr_rt_pct"}, rows)

    def _policy_lobs(self, own: DataFrame | None) -> DataFrame:
        link = self["lnk_plcy_lob"].select("hash_plcy_lob_id", "hash_plcy_id", "hash_lob_id")
        return _of_policies(link, own)

    def lob_exposures(self, own: DataFrame | None = None) -> DataFrame:
        """Exposure amount and base by type for each policy and line of business."""
        measures = {columns.EXPOSURE_AMOUNT: "expsr_amt", columns.EXPOSURE_BASE: "expsr_base"}
        link, rows = self._policy_lobs(own), self["sat_plcy_lob_expsr"]
        if own is not None:
            rows = restrict_to(rows, link, same("hash_plcy_lob_id"))
        wide = self._widen(columns.EXPOSURE_AMOUNT, "hash_plcy_lob_id", measures, rows)
        return spread_join(link, wide, same("hash_plcy_lob_id")).drop("hash_plcy_lob_id")

    def lob_iso_codes(self, own: DataFrame | None = None) -> DataFrame:
        iso = self["sat_plcy_lob_dtl"].select("hash_plcy_lob_id", "iso_cd")
        link = self._policy_lobs(own)
        return spread_join(link, iso, same("hash_plcy_lob_id")).drop("hash_plcy_lob_id")

    # Code lists.

    def companies(self) -> DataFrame:
        return json_lookup(self["xfrmtn"], *COMPANIES)

    def states_with_name(self) -> DataFrame:
        return json_lookup(self["xfrmtn"], *STATES_WITH_NAME)

    def states(self) -> DataFrame:
        return json_lookup(self["xfrmtn"], *STATES)

    def source_names(self) -> DataFrame:
        listed = self["ref_lkup"].filter(F.col("cd_lst") == SOURCE_NAME_LIST)
        return listed.select("cd_val", "cd_shrt_desc")

    # Parties, addresses, agencies.

    def _parties(
        self, role: Column, source: str | None = None, own: DataFrame | None = None
    ) -> DataFrame:
        roles = _of_policies(self["lnk_plcy_prty_role"].filter(role), own)
        orgs = self["sat_org"]
        if source:
            roles = roles.filter(F.col("rec_src_nm") == source)
            orgs = orgs.filter(F.col("rec_src_nm") == source)
        roles = roles.select(
            "hash_plcy_prty_role_id", "hash_plcy_id", "hash_prty_id", "prty_role_tp_cd", "btch_dt"
        )
        orgs = orgs.select(
            "hash_prty_id", "org_nm", "org_cd", "sic_cd", "nbr_of_emp_cnt", "ownrsp_tp_cd"
        )
        how = "inner" if source else "left"
        return spread_join(
            roles,
            orgs,
            same("hash_prty_id"),
            how,
            hot=self.hot_roles(),
            row_id=["hash_plcy_prty_role_id"],
        )

    def _latest_party(self, parties: DataFrame) -> DataFrame:
        order = newest_first("btch_dt", "hash_plcy_prty_role_id")
        return latest_per_key(parties, ["hash_plcy_id"], order)

    def insured(self, own: DataFrame | None = None) -> DataFrame:
        """Newest insured party of each policy."""
        is_insured = F.lower("prty_role_tp_cd") == "insured"
        return self._latest_party(self._parties(is_insured, own=own)).select(
            "hash_plcy_id", "sic_cd", "nbr_of_emp_cnt"
        )

    def insurer_latest(self, source: str) -> DataFrame:
        """Newest insurer of each policy."""
        is_insurer = F.lower("prty_role_tp_cd") == "insurer"
        return self._latest_party(self._parties(is_insurer, source)).select(
            "hash_plcy_id", "org_nm", "sic_cd", "ownrsp_tp_cd"
        )

    def insurer_names(self, source: str, with_code: bool = False) -> DataFrame:
        """Name on the newest insurer row per policy and role spelling, as distinct rows."""
        parties = self._parties(F.lower("prty_role_tp_cd") == "insurer", source)
        beside = ["org_cd"] if with_code else []
        keys = ["hash_plcy_id", "prty_role_tp_cd"]
        named = first_value_per_key(parties, keys, ["btch_dt"], "org_nm", "org_nm", beside)
        return named.select("hash_plcy_id", *beside, "org_nm").distinct()

    def producers(self, source: str) -> DataFrame:
        """One selling agency per policy: the producer number of the newest role."""
        roles = self["lnk_plcy_prty_role"].filter(
            (F.col("prty_role_tp_cd") == "Selling_Agency") & (F.col("rec_src_nm") == source)
        )
        agencies = self["sat_sell_agcy"].filter(F.col("rec_src_nm") == source)
        numbered = spread_join(
            roles.select("hash_plcy_prty_role_id", "hash_plcy_id", "btch_dt"),
            agencies.select("hash_plcy_prty_role_id", "prodr_nbr"),
            same("hash_plcy_prty_role_id"),
            "inner",
        )
        order = newest_first("btch_dt", "prodr_nbr")
        return latest_per_key(numbered, ["hash_plcy_id"], order).select("hash_plcy_id", "prodr_nbr")

    def primary_address(self, own: DataFrame | None = None) -> DataFrame:
        points = self["lnk_plcy_cntct_pnt"].filter(F.col("cntct_pnt_tp_cd") == "Primary_Address")
        points = _of_policies(points, own)
        order = [*newest_first("btch_dt"), F.col("hash_cntct_pnt_id").asc_nulls_first()]
        latest = latest_per_key(points, ["hash_plcy_id"], order)
        address = self["sat_phys_addr"].select("hash_cntct_pnt_id", "pstl_cd", "city_nm", "cnty_nm")
        return spread_join(
            latest.select("hash_plcy_id", "hash_cntct_pnt_id"), address, same("hash_cntct_pnt_id")
        ).drop("hash_cntct_pnt_id")

    def agency_accounts(self) -> DataFrame:
        """Newest account row per account number."""
        rows = self["sat_agcy_acct_dtl"].filter(F.col("rec_src_nm") == AGENCY_SOURCE)
        numbered = rows.withColumn("acct_number", codes.join_number(F.col("acct_nbr")))
        order = [*newest_first("btch_dt"), F.col("hash_agcy_acct_id").asc_nulls_first()]
        return latest_per_key(numbered, ["acct_number"], order).select(
            "acct_number", "hash_agcy_acct_id", "mstr_acct_nbr"
        )

    def agencies(self) -> DataFrame:
        """Account, its link to a legal agency, the agency, and the detail of the link."""

        def own(table: str, *names: str) -> DataFrame:
            return self[table].filter(F.col("rec_src_nm") == AGENCY_SOURCE).select(*names)

        link_id, agency_id = "hash_agcy_acct_lgl_agcy_id", "hash_lgl_agcy_id"
        link = own("lnk_agcy_acct_lgl_agcy", "hash_agcy_acct_id", agency_id, link_id)
        agency = own("sat_lgl_agcy_dtl", agency_id, "dstn_chnnl_cd", "dest_grp_cd")
        office = own("sat_agcy_acct_lgl_agcy_dtl", link_id, "serv_ofc_cd")
        chain = spread_join(self.agency_accounts(), link, same("hash_agcy_acct_id"))
        chain = spread_join(chain, agency, same(agency_id))
        return spread_join(chain, office, same(link_id)).drop(
            "hash_agcy_acct_id", agency_id, link_id
        )

    # Commission.

    def _commission_rows(self, source: str, types: Sequence[str]) -> DataFrame:
        link = self["lnk_prem_tran"].filter(
            (F.col("rec_src_nm") == source) & F.col("tran_tp_cd").isin(*types)
        )
        link = link.select(
            "hash_prem_tran_id", "hash_plcy_id", "hash_lob_id", "hash_cvrg_id",
            F.col("ref_id").alias("link_ref_id"), F.col("btch_dt").alias("link_btch_dt"),
        )
        return spread_join(link, self["sat_cmsn"], same("hash_prem_tran_id"))

    def policy_revision_commission(self, source: str) -> DataFrame:
        """Distinct percentage and amount per policy and revision."""
        rows = self._commission_rows(source, ["Policy_Level_Commission"])
        return rows.select("hash_plcy_id", "endrsmt_revsn_nbr", "cmsn_pct", "cmsn_amt").distinct()

    def coverage_commission(self, source: str) -> DataFrame:
        """Distinct percentage and amount per policy, line, coverage and reference."""
        types = ["Coverage_Level_Commission", "Endorsement_Level_Commission"]
        rows = self._commission_rows(source, types)
        return rows.select(
            "hash_plcy_id", "hash_lob_id", "hash_cvrg_id", F.col("link_ref_id").alias("ref_id"),
            "cmsn_pct", "cmsn_amt",
        ).distinct()

    def net_commission(self, source: str) -> DataFrame:
        """Net commission per policy, revision, reference root and period, newest version only."""
        rows = self._commission_rows(source, ["Policy_Level_Commission"]).withColumns(
            {
                "endrsmt_revsn_nbr": F.coalesce(
                    "endrsmt_revsn_nbr", codes.reference_revision(F.col("ref_id"))
                ),
                "rf": codes.reference_root(F.col("ref_id")),
            }
        )
        order = newest_first("link_btch_dt", "src_eff_dt", "link_ref_id", "hash_prem_tran_id")
        newest = latest_per_key(rows, ["hash_plcy_id", "rf", "endrsmt_revsn_nbr"], order)
        return newest.groupBy("hash_plcy_id", "rf", "endrsmt_revsn_nbr", "acctg_yr_mo_txt").agg(
            F.max("cmsn_pct").alias("cmsn_pct"), F.sum("net_cmsn_amt").alias("net_cmsn_amt")
        )

    def commission_percent(
        self, source: str, period: tuple[date, date] | None = None
    ) -> DataFrame:
        """Net commission as a percentage of the charged premium of the same key.

        The period text is part of the key, so a feed of one period needs no premium of another.
        """
        link = self["lnk_prem_tran"].filter(F.col("rec_src_nm") == source)
        premium = self["sat_prem"].select(
            "hash_prem_tran_id", "endrsmt_revsn_nbr", "acctg_yr_mo_txt", "chgd_prem_amt",
            codes.reference_root(F.col("ref_id")).alias("rf"),
        )
        if period:
            premium = premium.filter(text_in_range(F.col("acctg_yr_mo_txt"), *period))
        charged = spread_join(
            link.select("hash_prem_tran_id", "hash_plcy_id"),
            premium,
            same("hash_prem_tran_id"),
            "inner",
        )
        keys = ["hash_plcy_id", "rf", "endrsmt_revsn_nbr", "acctg_yr_mo_txt"]
        totals = charged.groupBy(*keys).agg(F.sum("chgd_prem_amt").alias("chgd_prem_amt"))
        joined = spread_join(totals, self.net_commission(source), same(*keys))
        percent = percent_of(F.col("net_cmsn_amt"), F.col("chgd_prem_amt"))
        return joined.select(*keys, percent.alias("cmsn_pct_calculated"))
