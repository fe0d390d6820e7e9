"""Policy premium feeds: one row per premium transaction, one declaration per source system.

A feed is built from the bottom up. What belongs to a policy is joined once per policy, what
belongs to a coverage once per coverage, and only the finished rows meet the transactions, which
are the largest input: they are cut to the wanted types, period and source before anything wide
is attached to them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vaultfeed.functions import codes
from vaultfeed.functions.measures import commission_amount
from vaultfeed.functions.period import text_in_range
from vaultfeed.operators import joins
from vaultfeed.operators.joins import Hot, blank_filled, restrict_to
from vaultfeed.operators.newest import latest_per_key, newest_first
from vaultfeed.operators.shape import project, union_by_name
from vaultfeed.operators.widen import columns_with_prefix
from vaultfeed.plans import columns
from vaultfeed.plans.parts import COVERAGE_KEYS, FAMILIES, Parts

Period = tuple[date, date]

# Partition column of the rows that a feed stores.
_OWN = "_own"

# Tables are tagged before they are joined here, so no key column has to be renamed or dropped.
spread_join = partial(joins.spread_join, keep_keys=True)
lookup_join = partial(joins.lookup_join, keep_keys=True)


@dataclass(frozen=True)
class Feed:
    """How one source system differs from the others."""

    source: str
    types: tuple[str, ...]
    # Join of transactions to policies and coverages: null matches null, or null counts as ''.
    null_safe: bool
    coverage_keys: tuple[str, ...]
    insurer: str
    commission: str
    columns: Mapping[str, str]
    # Rate is a percentage of the premium, or a plain factor.
    per_hundred: bool = True
    source_name: str | None = None
    products: tuple[str, ...] = ()
    skip_binders: bool = False
    coverage_required: bool = False
    newest_coverage: bool = False
    one_per_reference: bool = False
    agency: bool = False
    producer: bool = False
    state_names: bool = False
    treaty: bool = False
    commercial: bool = False
    risk_state: str = "txn_st_prvnc_cd"


# Business name and where it comes from, for the columns all sources fill alike.
# The prefix tells the table: pol policy, txn transaction link, prm premium, cms commission,
# cov coverage of the policy, cvg coverage, insr insurer, insd insured, adr address, prop property.
SHARED_COLUMNS = {
    "Source System Name": "src_cd_shrt_desc",
    "Source System Code": "hub_rec_src_nm",
    "Writing Company": "insr_org_nm",
    "Policy Symbol": "pol_plcy_sym_cd",
    "Policy Number": "pol_plcy_nbr",
    "Original Policy Number": "pol_orgnl_plcy_nbr",
    "Transaction Date": "prm_tran_dt",
    "Transaction Effective Date": "prm_tran_eff_dt",
    "Transaction Type": "txn_tran_tp_cd",
    "Transaction Code": "prm_tran_cd",
    "Transaction Desc": "prm_tran_descr",
    "Policy Effective Date": "pol_eff_dt",
    "Policy Expiration Date": "pol_exprn_dt",
    "Accounting Year Month": "prm_acctg_yr_mo_txt",
    "Cell": "cov_cell_cd",
    "Segment Code": "cov_sgmt_cd",
    "Financial Line of Business Code": "cov_fincl_ln_of_bus_cd",
    "Changed Premium Amount": "prm_chgd_prem_amt",
    "Written Premium Amount": "prm_wrtn_prem_amt",
    "Commission Percentage": "cms_cmsn_pct",
    "Commission Amount": "cms_cmsn_amt",
    "Transaction Expiration Date": "prm_tran_exprn_dt",
    "Primary Address Zip Code": "adr_pstl_cd",
    "Primary Address City": "adr_city_nm",
    "Primary Address County": "adr_cnty_nm",
    "Class Code": "cov_cls_cd",
    "Retroactive Date": "pol_retro_dt",
    "Tail Date": "pol_tail_dt",
    "Coinsurance Value": "cov_coins_val",
    "Policy Event Type Code": "prm_plcy_evnt_tp_cd",
    "Renewal Count": "pol_rnwl_cnt",
    "Cancellation Description": "pol_canctn_descr",
    "Exposure Amount": "cov_expsr_amt",
    "Exposure Base": "cov_expsr_base",
    "Insured SIC Code": "insd_sic_cd",
    "Revision Number": "pol_revsn_nbr",
    "Insured Property Location Number": "prop_prpty_loc_nbr",
}

# Source codes, transaction types, and the columns only some sources fill.
FEEDS = {
    "gain": Feed(
        source="92",
        types=("Coverage_Level_Premium", "Manual_Rated_Coverage_Premium"),
        null_safe=True,
        coverage_keys=(*COVERAGE_KEYS, "ref_id", "st_prvnc_cd"),
        insurer="company",
        commission="transaction",
        agency=True,
        state_names=True,
        columns={
            "Writing Company": "comp_Company_Name",
            "Company Number": "pol_co_nbr",
            "Annual Statement Line of Business": "cvg_aslob_cd",
            "Coverage Code": "cvg_cvrg_cd",
            "Coverage TP Code": "cvg_cvrg_tp_cd",
            "Subline Code": "cvg_subline_cd",
            "Claim_Made Indicator": "pol_clm_made_flg",
            "Reinsurance Code": "pol_reins_co_nbr",
            "Line of Business": "lob_lob_cd",
            "Bureau Type": "bur_tp_bur_cd",
            "Distribution Channel": "agy_dstn_chnnl_cd",
            "Group Destination Code": "agy_dest_grp_cd",
            "Service Office": "agy_serv_ofc_cd",
            "Master Account Number": "agy_mstr_acct_nbr",
            "Agency Number": "pol_agency_nbr",
            "Policy Kind Code": "pol_plcy_kind_cd",
        },
    ),
    "arrowhead": Feed(
        source="Arrowhead",
        types=("Coverage_Level_Premium",),
        null_safe=False,
        coverage_keys=COVERAGE_KEYS,
        insurer="names_and_codes",
        commission="transaction",
        source_name="Arrowhead",
        columns={
            "Annual Statement Line of Business": "cvg_aslob_cd",
            "Program Code": "pol_pgm_cd",
            "Organization Code": "insr_org_cd",
        },
    ),
    "prwins": Feed(
        source="217",
        types=("Coverage_Level_Premium",),
        null_safe=True,
        coverage_keys=(*COVERAGE_KEYS, "ref_id"),
        insurer="names",
        commission="policy_revision",
        producer=True,
        state_names=True,
        columns={
            "Annual Statement Line of Business": "cvg_aslob_cd",
            "Subline Code": "cvg_subline_cd",
            "Agency Number": "prod_prodr_nbr",
            "Program Code": "pol_pgm_cd",
            "Sub Program Code": "pol_sub_pgm_cd",
            "Business Type Code": "pol_bus_tp_cd",
        },
    ),
    "esl": Feed(
        source="61",
        types=("Coverage_Level_Premium", "Coverage_Level_Contract_Premium"),
        null_safe=False,
        coverage_keys=COVERAGE_KEYS,
        insurer="names",
        commission="transaction",
        treaty=True,
        risk_state="pol_cntrl_st_cd",
        columns={
            "Annual Statement Line of Business": "cvg_aslob_cd",
            "Treaty Code": "trty_ref_id",
        },
    ),
    "majesco": Feed(
        source="109",
        types=("Coverage_Level_Premium",),
        null_safe=True,
        coverage_keys=(*COVERAGE_KEYS, "ref_id"),
        coverage_required=True,
        insurer="latest",
        commission="net",
        products=("BO", "MP"),
        skip_binders=True,
        commercial=True,
        columns={
            "Product Code": "pol_prod_cd",
            "Annual Statement Line of Business": "cvg_aslob_cd",
            "Coverage Code": "cvg_cvrg_cd",
            "Coverage TP Code": "cvg_cvrg_tp_cd",
            "Coverage Code Description": "cvg_cvrg_descr",
            "Subline Code": "cvg_subline_cd",
            "Claim_Made Indicator": "cov_clm_made_flg",
            "Line of Business": "cvg_lob_cd",
            "Program Code": "pol_pgm_cd",
            "Policy Type Code": "pol_plcy_tp_cd",
            "Coverage Part Code": "cvg_cvrg_part_cd",
            "Market Segment Code": "pol_mkt_sgmt_cd",
            "Policy Structure": "pol_plcy_strc_cd",
            "Insurer SIC Code": "insr_sic_cd",
            "Ownership Type Code": "insr_ownrsp_tp_cd",
            "Extended RPT Number": "pol_extndd_rpt_dt_nbr",
            "Extended Attachment PNT Number": "pol_excs_attchmt_pnt_amt",
            "Number Of Employee Count": "insd_nbr_of_emp_cnt",
            "ISO Code": "iso_iso_cd",
        },
    ),
    "xm": Feed(
        source="220",
        types=("Coverage_Level_Premium", "Endorsment_Level_Premium"),
        null_safe=False,
        coverage_keys=(*COVERAGE_KEYS, "ref_id"),
        newest_coverage=True,
        insurer="latest",
        commission="coverage",
        per_hundred=False,
        one_per_reference=True,
        columns={},
    ),
}


def tagged(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns named after their table, so that no two joined tables share a name."""
    kept = df.select(*keep) if keep else df
    return kept.toDF(*[f"{prefix}_{c}" for c in kept.columns])


def on(left: str, right: str, *names: str) -> list[tuple[str, str]]:
    return [(f"{left}_{n}", f"{right}_{n}") for n in names]


@dataclass
class PolicyFeeds:
    """Builds the feeds of one warehouse."""

    parts: Parts
    period: Period | None = None
    feeds: Mapping[str, Feed] = field(default_factory=lambda: FEEDS)
    #: Keep what was joined countable: see ``traced``.
    trace: bool = False
    #: Names a fresh folder that all executors share; with it a source's own rows are stored, see ``_kept``.
    folder: Callable[[str], str] | None = None
    _stored: dict[tuple, tuple[DataFrame, list[str], int]] = field(default_factory=dict, repr=False, compare=False)
    _policies: dict[str, int] = field(default_factory=dict, repr=False, compare=False)

    def _kept(self, name: str, feed: Feed, df: DataFrame, tried: bool = True, of: str = "") -> DataFrame:
        """The source's own rows of a part of the feed, stored once if there is a folder.

        Premium, commission and coverage details do not name their source. Spark tries the keys of a plainly filtered
        table on the other side before it shuffles that (see ``prune_before_shuffles``), but not those of a join: so
        the join that finds the own rows is done first, and the rest of the warehouse is cut by its result.

        Each filter of keys passes through the driver, which holds several copies of it for as long as a query runs. So
        the parts of a feed are queries of their own, with a few filters each, and what is stored last is not ``tried``
        on others: the rows that meet then are all of the source. The filters have the size for the keys of ``of``, a
        part stored before, or of the source's policies.
        """
        if self.folder is None:
            return df
        key = (name, repr(feed), self.trace)
        if key not in self._stored:
            path = self.folder(name)
            # Finished parts have their columns stored by number: a type can give a wide column any name.
            names = df.columns if tried else [f"c{i}" for i in range(len(df.columns))]
            plain = StructType([StructField(n, f.dataType) for n, f in zip(names, df.schema, strict=True)])
            stored = df.toDF(*names).withColumn(_OWN, F.lit("yes")).write.partitionBy(_OWN)
            with joins.filters_for(df.sparkSession, self._rows(of, feed)):
                stored.option("compression", "zstd").parquet(path)
            # The schema is given, since a source without rows leaves no file to ask.
            schema = StructType([*plain, StructField(_OWN, StringType())])
            own = df.sparkSession.read.schema(schema).parquet(path)
            rows = own.count()  # kept in the files
            self._stored[key] = joins.not_broadcast(own, rows), df.columns, rows
        own, names, _ = self._stored[key]
        return (own.filter(F.col(_OWN) == "yes") if tried else own).drop(_OWN).toDF(*names)

    def _rows(self, name: str, feed: Feed) -> int:
        """Rows of a stored part, or the source's policies if none is named."""
        key = (name, repr(feed), self.trace)
        if key in self._stored:
            return self._stored[key][2]
        if feed.source not in self._policies:
            self._policies[feed.source] = self.parts["hub_plcy"].filter(F.col("rec_src_nm") == feed.source).count()
        return self._policies[feed.source]

    def _numbered(
        self, part: DataFrame, tag: str, names: Sequence[str], null_safe: bool = False
    ) -> DataFrame:
        """When tracing, ``row_<tag>`` numbers the rows of a part that share a join key, from 1.

        The window asks for the partitioning that the join asks for, so it adds no shuffle to a plain join. Rows that
        a plain join cannot match are left out first, so null keys do not meet in one task.
        """
        if not self.trace:
            return part
        keys = [F.col(f"{tag}_{n}") for n in names]
        if not null_safe:
            part = part.filter(reduce(lambda a, b: a & b, [k.isNotNull() for k in keys]))
        return part.withColumn(
            f"row_{tag}", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
        )

    # Policy grain.

    def _own_policies(self, feed: Feed) -> DataFrame:
        """Policy ids of the source (and products), to cut other tables down."""
        hub = self.parts["hub_plcy"].filter(F.col("rec_src_nm") == feed.source)
        hub = hub.select("hash_plcy_id", "rec_src_nm")
        if feed.products:
            detail = self.parts["sat_plcy_dtl"].filter(F.col("prod_cd").isin(*feed.products))
            hub = restrict_to(hub, detail, [("hash_plcy_id", "hash_plcy_id")], feed.null_safe)
        return hub

    def _of_own(self, df: DataFrame, feed: Feed) -> DataFrame:
        """Rows of the source's policies (and products).

        With products the source is asked for first: it is a plain filter, whose keys Spark can try on ``df`` before the
        shuffle (see ``prune_before_shuffles``); both checks share that shuffle.
        """
        by_policy = [("hash_plcy_id", "hash_plcy_id")]
        if feed.products:
            hub = self.parts["hub_plcy"].filter(F.col("rec_src_nm") == feed.source)
            df = restrict_to(df, hub, by_policy, feed.null_safe)
        return restrict_to(df, self._own_policies(feed), by_policy, feed.null_safe)

    def policies(self, feed: Feed) -> DataFrame:
        """Everything known per policy."""
        parts, key = self.parts, "hub_hash_plcy_id"
        hub = parts["hub_plcy"].filter(F.col("rec_src_nm") == feed.source)
        detail = tagged(parts["sat_plcy_dtl"], "pol")
        if feed.products:
            detail = detail.filter(F.col("pol_prod_cd").isin(*feed.products))
        frame = spread_join(
            self._numbered(
                tagged(hub, "hub", ["hash_plcy_id", "rec_src_nm"]), "hub", ["hash_plcy_id"], feed.null_safe
            ),
            self._numbered(detail, "pol", ["hash_plcy_id"], feed.null_safe),
            [(key, "pol_hash_plcy_id")],
            "inner",
            feed.null_safe,
        )
        frame = self._kept("details", feed, frame, tried=False)

        def attach(frame: DataFrame, part: DataFrame, prefix: str, null_safe=False) -> DataFrame:
            right = self._numbered(tagged(part, prefix), prefix, ["hash_plcy_id"], null_safe)
            return spread_join(frame, right, [(key, f"{prefix}_hash_plcy_id")], "left", null_safe)

        if feed.insurer == "latest":
            frame = attach(frame, parts.insurer_latest(feed.source), "insr")
        elif feed.insurer in ("names", "names_and_codes"):
            with_code = feed.insurer == "names_and_codes"
            names = parts.insurer_names(feed.source, with_code)
            frame = attach(frame, names, "insr", feed.null_safe)
        own = self._own_policies(feed)
        for part, prefix in ((parts.insured, "insd"), (parts.primary_address, "adr"), (parts.policy_limits, "lim")):
            frame = attach(frame, self._kept(part.__name__, feed, part(own), tried=False), prefix)
        if feed.producer:
            frame = attach(frame, parts.producers(feed.source), "prod")
        if feed.insurer == "company":
            companies = self._numbered(tagged(parts.companies(), "comp"), "comp", ["Company_Code"])
            frame = lookup_join(frame, companies, [("pol_co_nbr", "comp_Company_Code")])
        if feed.agency:
            number = codes.join_number(F.col("pol_prodr_nbr"))
            frame = frame.withColumn("pol_agency_number", number).withColumn(
                "pol_agency_nbr", number.cast("string")
            )
            agencies = self._numbered(tagged(parts.agencies(), "agy"), "agy", ["acct_number"])
            frame = lookup_join(frame, agencies, [("pol_agency_number", "agy_acct_number")])
        if feed.source_name:
            return frame.withColumn("src_cd_shrt_desc", F.lit(feed.source_name))
        names = tagged(parts.source_names(), "src").filter(F.col("src_cd_val") == feed.source)
        names = self._numbered(names, "src", ["cd_val"])
        return lookup_join(frame, names, [("hub_rec_src_nm", "src_cd_val")])

    # Coverage grain.

    def coverages(self, feed: Feed) -> DataFrame:
        """Everything known per coverage of a policy."""
        parts, key = self.parts, "lnk_hash_plcy_cvrg_id"
        link, detail = parts["lnk_plcy_cvrg"], parts["sat_plcy_cvrg_dtl"]
        if not feed.null_safe:
            link = blank_filled(link)
        link, of = self._of_own(link, feed), ""
        if feed.newest_coverage:
            if not self.trace:  # the core counts every coverage
                order = newest_first("btch_dt", "hash_plcy_cvrg_id")
                link = latest_per_key(link, feed.coverage_keys, order)
            order = newest_first("btch_dt", *sorted(set(detail.columns) - {"btch_dt"}))
            detail = latest_per_key(detail, ["hash_plcy_cvrg_id"], order)
        if self.trace and feed.coverage_required:
            link = self._kept("links", feed, link)
            link = restrict_to(link, detail, [("hash_plcy_cvrg_id", "hash_plcy_cvrg_id")])
            of = "links"
        link = tagged(link, "lnk", ["hash_plcy_cvrg_id", *feed.coverage_keys])
        link = self._numbered(link, "lnk", feed.coverage_keys, feed.null_safe)
        link = self._kept("coverages", feed, link, of=of)
        # Without a stored link nothing but the check leaves other coverages out before they are widened.
        of_link = None if self.folder else link.select(F.col(key).alias("hash_plcy_cvrg_id"))

        def attach(frame: DataFrame, part: DataFrame, prefix: str, how="left") -> DataFrame:
            right = self._numbered(tagged(part, prefix), prefix, ["hash_plcy_cvrg_id"])
            return spread_join(frame, right, [(key, f"{prefix}_hash_plcy_cvrg_id")], how)

        frame = attach(link, detail, "cov", "inner" if feed.coverage_required else "left")
        frame = attach(frame, parts.coverage_deductibles(False, of_link), "ded")
        if feed.commercial:
            frame = attach(frame, parts.coverage_limits(False, of_link), "clm")
        if feed.agency:
            bureau = parts["sat_plcy_cvrg_sar_dtl"].select("hash_plcy_cvrg_id", "tp_bur_cd")
            frame = attach(frame, bureau, "bur")
        if feed.coverage_required:
            frame = self._describe(frame, "lnk", feed, {})
        return frame

    def _describe(
        self, frame: DataFrame, prefix: str, feed: Feed, hot: Mapping[str, Hot]
    ) -> DataFrame:
        """Attach what hangs on the coverage, property, line, state or reference of a row.

        Where every transaction must have its coverage this is done per coverage, which holds the
        same keys; otherwise per transaction.
        """
        parts = self.parts

        def attach(frame, part, tag, names, hot_name, null_safe=False):
            pairs = [(f"{prefix}_{n}", f"{tag}_{n}") for n in names]
            row_id = [f"{prefix}_hash_prem_tran_id"] if prefix == "txn" else []
            right = self._numbered(tagged(part, tag), tag, names, null_safe)
            return spread_join(frame, right, pairs, "left", null_safe, hot.get(hot_name), row_id)

        if feed.commission != "coverage":
            frame = attach(frame, parts["sat_cvrg_dtl"], "cvg", ["hash_cvrg_id"], "coverage")
        places = parts["sat_ins_obj_prop"].select("hash_insd_obj_id", "prpty_loc_nbr")
        frame = attach(frame, places, "prop", ["hash_insd_obj_id"], "object")
        if feed.agency:
            lines = parts["sat_lob_dtl"].select("hash_lob_id", "lob_cd")
            frame = attach(frame, lines, "lob", ["hash_lob_id"], "lob")
        if feed.treaty:
            treaties = parts["sat_trty_dtl"].select("hash_trty_id", "ref_id")
            frame = attach(frame, treaties, "trty", ["hash_trty_id"], "treaty")
        if feed.commercial:
            policy_lob = ["hash_plcy_id", "hash_lob_id"]
            own = self._own_policies(feed)
            frame = attach(frame, parts.lob_iso_codes(own), "iso", policy_lob, "policy_lob", True)
            frame = attach(frame, parts.lob_exposures(own), "exp", policy_lob, "policy_lob", True)
            frame = attach(frame, parts.schedule_modifiers(), "mod", ["ref_id"], "reference")
        if feed.state_names:
            states = self._numbered(tagged(parts.states_with_name(), "st"), "st", ["CDKEY3"])
            frame = lookup_join(
                frame, states, [(f"{prefix}_st_prvnc_cd", "st_CDKEY3")], hot=hot.get("state")
            )
        return frame

    # Transaction grain.

    def transactions(self, feed: Feed) -> DataFrame:
        """The source's premium transactions of the wanted types and period, with their premium."""
        parts = self.parts
        link = parts["lnk_prem_tran"].filter(F.col("tran_tp_cd").isin(*feed.types))
        if not feed.null_safe:
            link = blank_filled(link)
        own = tagged(self._own_policies(feed), "own")
        hot = parts.hot_transactions(blank=not feed.null_safe).get("policy")
        link = restrict_to(
            tagged(link, "txn"), own, [("txn_hash_plcy_id", "own_hash_plcy_id")], feed.null_safe, hot,
            ["txn_hash_prem_tran_id"],
        )
        link = self._numbered(link, "txn", ["hash_prem_tran_id"], null_safe=True)
        link = self._kept("transactions", feed, link)
        premium = tagged(parts["sat_prem"], "prm")
        no_binder = F.coalesce("prm_bndr_flg", F.lit("N")) == "N"
        if self.period:
            premium = premium.filter(text_in_range(F.col("prm_acctg_yr_mo_txt"), *self.period))
            if feed.skip_binders:
                premium = premium.filter(no_binder)
        premium = self._numbered(premium, "prm", ["hash_prem_tran_id"])
        how = "inner" if self.period else "left"
        frame = spread_join(link, premium, on("txn", "prm", "hash_prem_tran_id"), how)
        if feed.skip_binders and not self.period:
            frame = frame.filter(no_binder)
        if feed.one_per_reference:
            order = newest_first("txn_btch_dt", "txn_hash_prem_tran_id")
            frame = latest_per_key(frame, ["txn_hash_plcy_id", "txn_ref_id"], order)
        return frame

    def _with_commission(self, frame: DataFrame, feed: Feed) -> DataFrame:
        parts = self.parts
        by_policy = partial(
            spread_join,
            hot=parts.hot_transactions(blank=not feed.null_safe).get("policy"),
            row_id=["txn_hash_prem_tran_id"],
            hot_on=["txn_hash_plcy_id"],
        )
        if feed.commission == "transaction":
            rows = parts["sat_cmsn"].select("hash_prem_tran_id", "cmsn_pct", "cmsn_amt")
            rows = self._numbered(tagged(rows, "cms"), "cms", ["hash_prem_tran_id"])
            return spread_join(frame, rows, on("txn", "cms", "hash_prem_tran_id"))
        if feed.commission == "policy_revision":
            rows = tagged(parts.policy_revision_commission(feed.source), "cms")
            rows = self._numbered(rows, "cms", ["hash_plcy_id", "endrsmt_revsn_nbr"], null_safe=True)
            pairs = [
                ("txn_hash_plcy_id", "cms_hash_plcy_id"),
                ("prm_endrsmt_revsn_nbr", "cms_endrsmt_revsn_nbr"),
            ]
            return by_policy(frame, rows, pairs, null_safe=True)
        if feed.commission == "coverage":
            rows = parts.coverage_commission(feed.source)
            keys = ["hash_plcy_id", "hash_lob_id", "hash_cvrg_id", "ref_id"]
            rows = latest_per_key(rows, keys, newest_first("cmsn_pct", "cmsn_amt"))
            rows = self._numbered(tagged(rows, "cms"), "cms", keys)
            return by_policy(frame, rows, on("txn", "cms", *keys))
        frame = frame.withColumn("prm_rf", codes.reference_root(F.col("prm_ref_id")))
        net = parts.net_commission(feed.source).withColumnRenamed("net_cmsn_amt", "cmsn_amt")
        percent = parts.commission_percent(feed.source, self.period)

        names = ("rf", "endrsmt_revsn_nbr", "acctg_yr_mo_txt")
        for part, tag in ((net, "cms"), (percent, "pct")):
            rows = self._numbered(tagged(part, tag), tag, ["hash_plcy_id", *names])
            pairs = [("txn_hash_plcy_id", f"{tag}_hash_plcy_id"), *on("prm", tag, *names)]
            frame = by_policy(frame, rows, pairs)
        return frame

    def core(self, feed: Feed) -> DataFrame:
        """Transactions, premium and coverage of the source: the rows a feed must account for."""
        how = "inner" if feed.coverage_required else "left"
        link = self.parts["lnk_plcy_cvrg"]
        link = link if feed.null_safe else blank_filled(link)
        if self.folder:  # others match no transaction of the source, and so are left out before the join
            link = self._kept("links", feed, self._of_own(link, feed), tried=feed.coverage_required)
        link = tagged(link, "lnk")
        frame = self._kept("premium", feed, self.transactions(feed), False, "transactions")
        if feed.coverage_required:
            ids = self.parts["sat_plcy_cvrg_dtl"]
            link = restrict_to(link, ids, [("lnk_hash_plcy_cvrg_id", "hash_plcy_cvrg_id")])
            link = self._kept("covered_links", feed, link, False, "links")
        return self._join_coverages(frame, link, feed, how)

    def _join_coverages(
        self, frame: DataFrame, coverages: DataFrame, feed: Feed, how: str
    ) -> DataFrame:
        hot = self.parts.hot_transactions(blank=not feed.null_safe)
        return spread_join(
            frame,
            coverages,
            on("txn", "lnk", *feed.coverage_keys),
            how,
            feed.null_safe,
            hot.get(f"link{len(feed.coverage_keys)}"),
            ["txn_hash_prem_tran_id"],
        )

    def assemble(self, feed: Feed) -> DataFrame:
        """All joined columns of a feed under their table-tagged names."""
        hot = self.parts.hot_transactions(blank=not feed.null_safe)
        how = "inner" if feed.coverage_required and not self.trace else "left"
        # All families of the feed in one job, before the datasets ask for theirs one by one.
        self.parts.types_of(FAMILIES if feed.commercial else (columns.POLICY_LIMIT, columns.DEDUCTIBLE))
        frame = self._kept("measured", feed, self._with_commission(self.transactions(feed), feed), False, "transactions")
        covered = self._kept("covered", feed, self.coverages(feed), False, "coverages")
        frame = self._join_coverages(frame, covered, feed, how)
        if not feed.coverage_required:
            frame = self._describe(frame, "txn", feed, hot)
        frame = spread_join(
            frame,
            self._kept("policies", feed, self.policies(feed), tried=False),
            [("txn_hash_plcy_id", "hub_hash_plcy_id")],
            "left" if self.trace else "inner",
            feed.null_safe,
            hot.get("policy"),
            ["txn_hash_prem_tran_id"],
        )
        if feed.one_per_reference and not self.trace:
            # The grain is asked of the finished rows: side tables may repeat what they describe.
            first = ["txn_btch_dt", "txn_hash_prem_tran_id", "prop_prpty_loc_nbr"]
            order = newest_first(*first, *sorted(set(frame.columns) - set(first)))
            frame = latest_per_key(frame, ["txn_hash_plcy_id", "txn_ref_id"], order)
        return frame

    # Accounting for the rows of a finished feed.

    def traced(self, feed: Feed) -> DataFrame:
        """The joined rows of a feed with ``row_<tag>`` per join, and whether each stands for a row of three stages.

        ``in_base`` marks one row of each transaction with premium, ``in_core`` one of each such transaction and
        coverage, ``in_feed`` the rows that the finished feed has. So one execution counts all stages, and a
        transaction with several rows names the joins that multiplied it: those with a number above 1.
        """
        frame = replace(self, trace=True).assemble(feed)
        sides = [c for c in columns_with_prefix(frame, "row_") if c not in ("row_txn", "row_prm")]

        def first(names: Sequence[str]) -> Column:
            return reduce(lambda a, b: a & b, [F.coalesce(n, F.lit(1)) == 1 for n in names])

        covered = F.col("row_lnk").isNotNull() if feed.coverage_required else F.lit(True)
        finished = covered & F.col("row_hub").isNotNull()
        if feed.one_per_reference:  # the transactions are one per reference, and so is the feed
            finished = finished & first(sides)
        return frame.withColumns(
            {
                "in_base": first(sides),
                "in_core": covered & first([c for c in sides if c != "row_lnk"]),
                "in_feed": finished,
            }
        )

    def accounts(self, feed: Feed) -> DataFrame:
        """Per transaction: rows and premium in each stage, and ``culprits``, the joins that multiplied it, by tag."""
        frame, premium = self.traced(feed), F.col("prm_chgd_prem_amt")
        tags = sorted(c.removeprefix("row_") for c in columns_with_prefix(frame, "row_"))
        measures = [F.max(F.when(F.col("in_feed"), F.col(f"row_{t}"))).alias(f"row_{t}") for t in tags]
        for stage in ("base", "core", "feed"):
            inside = F.col(f"in_{stage}")
            measures.append(F.count_if(inside).alias(f"{stage}_rows"))
            measures.append(F.sum(F.when(inside, premium)).alias(f"{stage}_premium"))
        per = frame.groupBy("txn_hash_prem_tran_id").agg(*measures)
        named = F.array_compact(F.array(*[F.when(F.col(f"row_{t}") > 1, F.lit(t)) for t in tags]))
        culprits = F.when(F.col("feed_rows") > 1, F.array_join(named, ",")).alias("culprits")
        stages = [f"{s}_{m}" for s in ("base", "core", "feed") for m in ("rows", "premium")]
        return per.select("txn_hash_prem_tran_id", *stages, culprits)

    # Output.

    def build(self, name: str, flags: bool = False) -> DataFrame:
        """One feed on the business schema, wide families last."""
        feed = self.feeds[name]
        frame = self.assemble(feed)
        rate = "pct_cmsn_pct_calculated" if feed.commission == "net" else "cms_cmsn_pct"
        state = "st_CDDESC" if feed.state_names else feed.risk_state
        output: dict[str, Column] = {
            **{n: F.col(c) for n, c in {**SHARED_COLUMNS, **feed.columns}.items()},
            "Underwriting Year": F.year("pol_eff_dt"),
            "Risk State": F.col(state),
            "Risk State Code": F.col(feed.risk_state),
            "Commission Amount (Calculated)": commission_amount(
                F.col("prm_chgd_prem_amt"), F.col(rate), feed.per_hundred
            ),
        }
        if flags and feed.agency:
            output.update(list_flags())
        for tag, prefix in (
            ("lim", columns.POLICY_LIMIT),
            ("ded", columns.DEDUCTIBLE),
            ("clm", columns.COVERAGE_LIMIT),
            ("exp", columns.EXPOSURE_AMOUNT),
            ("exp", columns.EXPOSURE_BASE),
            ("mod", columns.MODIFIER),
        ):
            for wide in columns_with_prefix(frame, f"{tag}_{prefix} - "):
                output[wide.removeprefix(f"{tag}_")] = F.col(f"`{wide}`")
        padded = {n: output.pop(n, F.lit("")) for n in columns.POLICY_COLUMNS}
        return project(frame, {**padded, **output})

    def stored(self, name: str) -> DataFrame:
        """A feed as ``build`` makes it, its finished rows stored if there is a folder."""
        return self._kept("feed", self.feeds[name], self.build(name), tried=False)

    def union(self, names: Sequence[str] | None = None) -> DataFrame:
        """All rows of the named feeds (default: all), on the columns of any of them."""
        return union_by_name([self.build(n) for n in names or self.feeds])


def list_flags() -> dict[str, Column]:
    """Code-list flags of a feed that carries agency data; they are not part of the extract."""
    reinsurer = codes.reinsurer_status(F.col("pol_reins_co_nbr"))
    state = codes.int_text(F.left("agy_mstr_acct_nbr", F.lit(3)))
    subline = codes.normalise_code(F.col("cvg_subline_cd"))
    return {
        "Policy Symbol Status": codes.list_flag(F.col("pol_plcy_sym_cd"), codes.POLICY_SYMBOLS),
        "Major Peril Status": codes.list_flag(F.trim("cvg_cvrg_cd"), codes.MAJOR_PERILS),
        "Subline Code Status": codes.list_flag(subline, codes.SUBLINES),
        "EPLI": codes.employment_liability(
            F.col("agy_dstn_chnnl_cd"),
            F.col("lob_lob_cd"),
            F.col("bur_tp_bur_cd"),
            F.col("cvg_cvrg_cd"),
        ),
        "Reinsurance Company Code Status": reinsurer,
        "Reins Flag": F.when(reinsurer == "NotInList", "FALSE").otherwise(""),
        "Service Office Status": codes.list_flag(
            F.col("agy_serv_ofc_cd"), codes.SERVICE_OFFICES, missing="NotInList"
        ),
        "Agency State Status": codes.list_flag(state, codes.AGENCY_STATES),
        "Kind Code Status": codes.list_flag(F.col("pol_plcy_kind_cd"), codes.POLICY_KINDS),
    }
