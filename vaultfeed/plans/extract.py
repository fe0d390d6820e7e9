"""One run: build the wanted extracts, store each once, and derive every output from that."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultfeed.functions.period import accounting_range
from vaultfeed.operators.quality import Watch
from vaultfeed.operators.shape import file_name_of, with_file_names
from vaultfeed.plans.claims import BRANCHES, ClaimFeeds, Month, claim_slice
from vaultfeed.plans.parts import Parts
from vaultfeed.plans.policy import FEEDS, PolicyFeeds
from vaultfeed.plans.split import combined_policies
from vaultfeed.sources.sinks import discard, publish, scratch_path, write_csv, write_envelopes, write_json_lines

# What a run can be asked for.
SOURCES = {
    "All": (tuple(FEEDS), tuple(BRANCHES)),
    "Majesco": (("majesco",), ()),
    "Gain": (("gain",), ()),
    "Prwins": (("prwins",), ()),
    "Arrowhead": (("arrowhead",), ()),
    "DYESL": (("esl",), ()),
    "XM": (("xm",), ()),
    "ClaimCenter": ((), ("center",)),
    "Juris": ((), ("juris",)),
    "DYESL Claim": ((), ("esl", "esl_reserve")),
}


def formatted(df: DataFrame) -> DataFrame:
    """An extract with file-safe names and its transaction date as a day."""
    named = with_file_names(df)
    day = file_name_of("Transaction Date")
    return named.withColumn(day, F.to_date(day)) if day in named.columns else named


def export(df: DataFrame, path: str, formats: Sequence[str] = ("csv",), watch: Watch | None = None) -> DataFrame:
    """Store an extract as Parquet, formatted, then write the other formats from it; ``watch`` sees the rows stored."""
    named = formatted(df)
    (watch.over(named) if watch else named).write.parquet(f"{path}/parquet")
    stored = df.sparkSession.read.schema(named.schema).parquet(f"{path}/parquet")
    writers = {"csv": write_csv, "json": write_json_lines, "envelope": write_envelopes}
    for name in formats:
        writers[name](stored, f"{path}/{name}")
    return stored


def _note(spark: SparkSession, path: str, audit: DataFrame | None, error: Exception | None, batch_date: str) -> None:
    """Store a run's audit under its own name, so that a repeated run replaces it."""
    if error is not None:
        failed = [("failed", str(error)[:2000], batch_date)]
        audit = spark.createDataFrame(failed, "status string, message string, batch_date string")
    else:
        status = F.when(F.col("row_count") == 0, "empty").otherwise("written")
        audit = audit.withColumns({"status": status, "message": F.lit(None).cast("string")})
    audit.write.mode("overwrite").parquet(path)


def claim_outputs(claims: DataFrame, start: Month, end: Month) -> dict[str, DataFrame]:
    """A run's claims as they are handed on: all, Claim Center alone, the last year, all but the last month."""
    before = (end[0], end[1] - 1) if end[1] > 1 else (end[0] - 1, 12)
    return {
        "claims": claims,
        "claims_center": claims.filter(F.col("Branch") == "center"),
        "claims_last_year": claim_slice(claims, (end[0], 1), (end[0], 12)),
        "claims_without_last_month": claim_slice(claims, start, before),
    }


def run(
    spark: SparkSession,
    parts: Parts,
    out: str,
    months: int,
    batch_date: str = "",
    source: str = "All",
    formats: Sequence[str] = ("csv", "json"),
) -> dict[str, str]:
    """Write the extracts of a source for the months before a batch date (default: today).

    Returns the folder of each extract; claims also come in slices. Rows, premium total, newest date
    and status per feed go to ``<out>/audit``, with a row for a feed without rows and for a failed
    run. A run of the same source, date and months replaces what it wrote before, all extracts at once and only when
    all are written: a run that fails leaves the earlier extracts whole, and no files of its own.
    """
    if source not in SOURCES:
        raise ValueError(f"source must be one of {sorted(SOURCES)}, got {source!r}")
    batch_date = batch_date.strip() or datetime.now().strftime("%Y%m%d")
    period = accounting_range(batch_date, months)
    policies, claims = SOURCES[source]
    name = f"{file_name_of(source)}_{batch_date}_{months}"
    folder = f"{out.rstrip('/')}/{name}"
    staged = f"{folder}.next-{uuid.uuid4().hex}"
    scratch = scratch_path(spark, "by-source")
    written: list[str] = []

    def policy_audit() -> DataFrame:
        if len(policies) > 1:
            feed = combined_policies(spark, parts, scratch, period, policies)
        else:
            feed = PolicyFeeds(parts, period).build(policies[0])
        columns = map(file_name_of, ("Changed Premium Amount", "Transaction Date"))
        watch = Watch(file_name_of("Source System Code"), [FEEDS[p].source for p in policies], *columns)
        written.append("policies")
        export(feed, f"{staged}/policies", formats, watch)
        return watch.audit(feed, batch_date)

    def claim_audit() -> DataFrame:
        start, end = ((d.year, d.month) for d in period)
        feed = ClaimFeeds(parts, start, end).union(claims, branch_column="Branch")
        watch = Watch("Branch", claims, "Transaction Amount", "Transaction Date")
        watch.over(feed).write.parquet(f"{staged}/claims/rows")
        rows = spark.read.schema(feed.schema).parquet(f"{staged}/claims/rows")
        outputs = claim_outputs(rows, start, end)
        if "juris" in claims:
            outputs["claims_juris_changes"] = ClaimFeeds(parts, start, end).changes()
        for each, part in outputs.items():
            written.append(each)
            export(part, f"{staged}/{each}", formats)
        return watch.audit(feed, batch_date)

    audits: dict[str, DataFrame] = {}
    place = f"{out.rstrip('/')}/audit/{{}}/run={name}".format
    try:
        for kind, feeds, build in (("policies", policies, policy_audit), ("claims", claims, claim_audit)):
            if feeds:
                try:
                    audits[kind] = build()
                except Exception as error:
                    _note(spark, place(kind), None, error, batch_date)
                    raise
        publish(spark, staged, folder)
    finally:
        discard(spark, staged)
        discard(spark, scratch)
    for kind, audit in audits.items():
        _note(spark, place(kind), audit, None, batch_date)
    return {each: f"{folder}/{each}" for each in written}
