"""Training documents from raw ones: rate, drop near-duplicates, decontaminate, take out secrets, encode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultfeed.llm import bpe, decontaminate, neardup, quality, secrets
from vaultfeed.llm.common import written
from vaultfeed.llm.queries import table, vocabulary


def well_rated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learned from the labelled ones among them, gives the highest grade.

    Rows without a text and empty ones are rated by their shape, equal texts and repeated rows equally; columns stay.
    """
    return quality.select(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id. A row without an id stays, repeated rows don't.

    Null, empty and wordless texts are near nothing. Of rows with one id, a kept one each, those with equal texts are one
    row. Texts are not moved for that, but for the few rows whose id occurs twice. Columns of any name stay as they are.
    """
    kept = written(neardup.clusters(docs).where("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    twice = written(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    one = docs.join(kept, "doc_id", "left_semi")
    digest = F.sha2(F.coalesce("text", F.lit("-")), 256)
    copies = Window.partitionBy("doc_id", digest, F.isnull("text")).orderBy(F.lit(0))
    again = one.join(twice, "doc_id", "left_semi").select(F.struct(docs.columns).alias("row"), F.row_number().over(copies).alias("copy"))
    return one.join(twice, "doc_id", "left_anti").unionByName(again.where("copy = 1").select("row.*")).unionByName(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; a document that mostly consists of them goes.

    Null and empty texts stay as they are, repeated rows are each treated alike, extra columns stay.
    """
    return _counted(decontaminate.clean(docs, table(spark, sf_dir, "benchmark")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark. Null and empty texts and extra columns stay, repeated rows are treated alike."""
    return _counted(secrets.redact(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian unsigned 32-bit) of every row; null and empty texts have no tokens."""
    return bpe.encode(docs, vocabulary()).select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", well_rated),
    ("near_duplicates", distinct),
    ("decontaminate", decontaminated),
    ("secrets", without_secrets),
    ("encode", encoded),
]

#: No stage but decontamination can be said in SQL; the stages are tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs, f"stage-{name}") if k < len(STAGES) - 1 else docs
    return docs
