"""Claim feeds: one row per financial transaction of a claim, one declaration per branch.

Claim, policy and insurer are joined per claim; transactions are cut to the wanted months (or
type) before they meet the claims.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultfeed.functions.codes import int_text
from vaultfeed.functions.period import months_between
from vaultfeed.operators.joins import lookup_join, restrict_to, same, spread_join
from vaultfeed.operators.newest import (
    latest_per_key,
    latest_then_filter,
    newest_first,
    previous_value,
)
from vaultfeed.operators.shape import project, union_by_name
from vaultfeed.plans import columns
from vaultfeed.plans.parts import Parts
from vaultfeed.plans.policy import tagged

Month = tuple[int, int]


@dataclass(frozen=True)
class Branch:
    """How one branch differs from the others."""

    source: str
    columns: Mapping[str, str]
    # "own_newest": newest policy link, kept if it is of the source; "newest"; or "all".
    links: str = "all"
    exposure: bool = False
    insurer: bool = False
    reserves: bool = False


# Business name and where it comes from; clm claim, pol policy, trn transaction,
# exp exposure, insr insurer.
SHARED_COLUMNS = {
    "Claim Source Name": "src_cd_shrt_desc",
    "Claim Source Code": "clm_rec_src_nm",
    "UW Source Name": "clm_src_sys_rec_nm",
    "Accounting Year": "trn_acctg_yr_nbr",
    "Accounting Month": "trn_acctg_mo_nbr",
    "Claim Number": "clm_clm_nbr",
    "Claim Public Id": "clm_clm_pub_id",
    "Policy Number": "clm_plcy_nbr",
    "Policy Effective Date": "clm_plcy_eff_dt",
    "Transaction Date": "trn_tran_dt",
    "Transaction Type": "trn_tran_tp_descr",
    "Cost Type": "trn_cost_tp_descr",
    "Cost Category Code": "trn_cost_ctgry_cd",
    "Cost Category Type": "trn_cost_ctgry_descr",
    "Claim Status": "clm_clm_sts_descr",
    "Date of Loss": "clm_loss_dt",
    "Loss State": "clm_loss_loc_st_cd",
    "Erode Reserve Flag": "trn_erd_rsrv_flg",
    "Cell": "clm_cell_cd",
    "Segment Code": "clm_sgmt_cd",
    "Financial Line of Business": "clm_fincl_ln_of_bus_cd",
    "Transaction Amount": "trn_tran_amt",
    "Reserve Line Public Id": "trn_rsrv_ln_id",
    "Batch Date": "trn_btch_dt",
    "Transaction Status": "trn_tran_sts_descr",
    "Retired Flag": "trn_retrd_flg",
}
_ESL_COLUMNS = {
    "Claim Source Code": "pol_rec_src_nm",
    "Writing Company": "insr_org_nm",
    "Policy Effective Date": "pol_eff_dt",
    "Transaction Type": "trn_tran_tp_cd",
}
BRANCHES = {
    "center": Branch(
        source="45",
        links="own_newest",
        exposure=True,
        columns={
            "Writing Company": "clm_wrtg_co_nm",
            "Loss State": "clm_loss_loc_st_nm",
            "Cell": "exp_cell_cd",
            "Segment Code": "exp_sgmt_cd",
            "Financial Line of Business": "exp_fincl_ln_of_bus_cd",
        },
    ),
    "esl": Branch(source="61", insurer=True, columns=_ESL_COLUMNS),
    "esl_reserve": Branch(source="61", insurer=True, reserves=True, columns=_ESL_COLUMNS),
    "juris": Branch(
        source="105",
        columns={"Writing Company": "clm_wrtg_co_cd", "Claim Status": "clm_clm_sts_cd"},
    ),
}

# Transactions that follow one another.
CHANGE_KEYS = ("hash_clm_id", "cost_ctgry_cd", "cost_tp_descr", "rsrv_ln_id", "tran_tp_cd")

_DATES = ("Policy Effective Date", "Transaction Date", "Date of Loss")
_NUMBERS = ("Accounting Year", "Accounting Month", "Accident Year")


@dataclass
class ClaimFeeds:
    """Builds the claim branches of one warehouse for a run of accounting months."""

    parts: Parts
    start: Month
    end: Month
    branches: Mapping[str, Branch] = field(default_factory=lambda: BRANCHES)

    def policy_links(self, branch: Branch) -> DataFrame:
        links = self.parts["lnk_clm_plcy"]
        order = newest_first("btch_dt", "hash_plcy_id")
        if branch.links == "own_newest":
            own = F.col("rec_src_nm") == branch.source
            links = latest_then_filter(links, ["hash_clm_id"], order, own)
        elif branch.links == "newest":
            links = latest_per_key(links, ["hash_clm_id"], order)
        return links.select("hash_clm_id", "hash_plcy_id")

    def claims(self, branch: Branch) -> DataFrame:
        """Everything known per claim and policy link."""
        parts = self.parts
        claims = tagged(parts["sat_clm_dtl"].filter(F.col("rec_src_nm") == branch.source), "clm")
        links = tagged(self.policy_links(branch), "lnk")
        frame = spread_join(claims, links, [("clm_hash_clm_id", "lnk_hash_clm_id")])
        policies = tagged(parts["sat_plcy_dtl"].select("hash_plcy_id", "rec_src_nm", "eff_dt"), "pol")
        frame = spread_join(frame, policies, [("lnk_hash_plcy_id", "pol_hash_plcy_id")])
        if branch.insurer:
            names = tagged(parts.insurer_names(branch.source), "insr")
            frame = spread_join(frame, names, [("lnk_hash_plcy_id", "insr_hash_plcy_id")])
        names = tagged(parts.source_names(), "src").filter(F.col("src_cd_val") == branch.source)
        return lookup_join(frame, names, [("clm_rec_src_nm", "src_cd_val")])

    def transactions(self, branch: Branch, every: bool = False) -> DataFrame:
        """Financial transactions in the run of months, or reserves of any month; or ``every`` one."""
        parts, hot = self.parts, self.parts.hot_claims()
        detail = parts["sat_clm_tran_dtl"]
        if every:
            wanted = F.lit(True)
        elif branch.reserves:
            wanted = F.col("tran_tp_cd") == "Reserve"
        else:
            year, month = F.col("acctg_yr_nbr"), F.col("acctg_mo_nbr")
            wanted = months_between(year, month, self.start, self.end)
        link = parts["lnk_clm_tran"].select(
            "hash_clm_id", "hash_clm_fincl_tran_id", "hash_expsr_id"
        )
        key = same("hash_clm_fincl_tran_id")
        detail = detail.filter(wanted).drop("hash_clm_id", "hash_expsr_id")
        frame = tagged(spread_join(link, detail, key, "inner"), "trn")
        if branch.exposure:
            exposures = tagged(parts["sat_expsr_dtl"], "exp")
            frame = spread_join(
                frame,
                exposures,
                [("trn_hash_expsr_id", "exp_hash_expsr_id")],
                hot=hot.get("exposure"),
                row_id=["trn_hash_clm_fincl_tran_id"],
            )
        return frame

    def build(self, name: str) -> DataFrame:
        """One branch on the claim schema; years and months as whole-number text.

        Transactions are first cut to the source's claims: these are a plain filter, whose keys Spark can try on the
        transactions before they are shuffled (see ``prune_before_shuffles``). The cut and the join share a shuffle.
        """
        branch = self.branches[name]
        claims = self.parts["sat_clm_dtl"].filter(F.col("rec_src_nm") == branch.source)
        frame = restrict_to(
            self.transactions(branch),
            claims,
            [("trn_hash_clm_id", "hash_clm_id")],
            hot=self.parts.hot_claims().get("claim"),
            row_id=["trn_hash_clm_fincl_tran_id"],
        )
        return self._finished(frame, branch)

    def changes(self, name: str = "juris") -> DataFrame:
        """A branch with the amount before each transaction's, and the change from it.

        The one before is the next older transaction of the same claim, cost, reserve line and type, also if
        it lies before the run of months; the first has none.
        """
        branch, keys = self.branches[name], [f"trn_{c}" for c in CHANGE_KEYS]
        claims = self.parts["sat_clm_dtl"].filter(F.col("rec_src_nm") == branch.source)
        frame = restrict_to(
            self.transactions(branch, every=True), claims, [("trn_hash_clm_id", "hash_clm_id")]
        )
        frame = previous_value(
            frame, keys, "trn_tran_dt", ["trn_hash_clm_fincl_tran_id"], "trn_tran_amt",
            "trn_previous_amt", "month",
        )
        year, month = F.col("trn_acctg_yr_nbr"), F.col("trn_acctg_mo_nbr")
        frame = frame.filter(months_between(year, month, self.start, self.end))
        more = {
            "Previous Amount": F.col("trn_previous_amt"),
            "Change In Amount": F.col("trn_tran_amt") - F.col("trn_previous_amt"),
        }
        return self._finished(frame, branch, more)

    def _finished(
        self, transactions: DataFrame, branch: Branch, more: Mapping[str, Column] | None = None
    ) -> DataFrame:
        frame = spread_join(
            transactions,
            self.claims(branch),
            [("trn_hash_clm_id", "clm_hash_clm_id")],
            "inner",
            hot=self.parts.hot_claims().get("claim"),
            row_id=["trn_hash_clm_fincl_tran_id"],
        )
        output: dict[str, Column] = {
            n: F.col(c) for n, c in {**SHARED_COLUMNS, **branch.columns}.items()
        }
        output["Accident Year"] = F.year("clm_loss_dt")
        for n in _DATES:
            output[n] = output[n].cast("date")
        for n in _NUMBERS:
            output[n] = int_text(output[n])
        return project(frame, {n: output[n] for n in columns.CLAIM_COLUMNS} | dict(more or {}))

    def union(self, names: Sequence[str] | None = None, branch_column: str | None = None):
        """All rows of the named branches (default: all); a reserve can also be a claim row.

        ``branch_column`` adds the branch of each row, which tells such pairs apart.
        """
        frames = []
        for name in names or self.branches:
            frame = self.build(name)
            frames.append(frame.withColumn(branch_column, F.lit(name)) if branch_column else frame)
        return union_by_name(frames)


def claim_slice(claims: DataFrame, start: Month, end: Month) -> DataFrame:
    """Rows of a run of months from a finished claim extract; rows without a year are kept."""
    year, month = F.col("Accounting Year"), F.col("Accounting Month")
    return claims.filter(months_between(year, month, start, end, keep_missing=True))
