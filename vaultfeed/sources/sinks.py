"""Extract files. Every writer is distributed: a path is a directory of part files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory below the shared folder that the session names for checkpoints.

    Only a local session may fall back to a folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="vaultfeed-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').option(
        "encoding", "UTF-8"
    ).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Read a headed CSV extract; without a schema every column is text."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record per line; a null is written, not left out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_envelopes(
    stored: DataFrame,
    path: str,
    root: str = "ISO",
    rows_per_document: int = 10_000,
    mode: str = "errorifexists",
) -> None:
    """Write ``{"<root>": [record, ...]}`` documents, one per line.

    A document holds at most ``rows_per_document`` records, so no task gathers more than that
    however large the extract is; together the documents hold every record once.
    ``stored`` must come straight from files: the row numbers are then the same on a retry.
    """
    record = F.to_json(F.struct(*stored.columns), {"ignoreNullFields": "false"})
    per_partition = 1 << 33
    number = F.monotonically_increasing_id()
    chunked = stored.select(
        record.alias("record"),
        F.shiftright(number, 33).alias("part"),
        F.floor((number % F.lit(per_partition)) / rows_per_document).alias("chunk"),
    )
    (
        chunked.groupBy("part", "chunk")
        .agg(F.concat_ws(",", F.collect_list("record")).alias("records"))
        .select(F.concat(F.lit(f'{{"{root}":['), "records", F.lit("]}")).alias("value"))
        .write.mode(mode)
        .text(path)
    )


def _store(spark: SparkSession, path: str):
    """The file system of a path, and a function that makes its paths."""
    jvm = spark.sparkContext._jvm
    to_path = jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to_path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run has made, if it is there."""
    files, to_path = _store(spark, path)
    files.delete(to_path(path), True)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of an earlier one, which stays whole until then.

    The earlier folder is moved aside and removed last. If a run dies between the two moves, the next one puts the
    earlier folder back before it goes on.
    """
    files, to_path = _store(spark, path)
    here, new, before = to_path(path), to_path(staged), to_path(f"{path}.previous")
    if files.exists(before):
        if files.exists(here):
            files.delete(before, True)
        else:
            files.rename(before, here)
    if files.exists(here) and not files.rename(here, before):
        raise OSError(f"{path} cannot be moved aside")
    if not files.rename(new, here):
        files.rename(before, here)
        raise OSError(f"{staged} cannot be moved to {path}")
    files.delete(before, True)


def append_audit(audit: DataFrame, path: str) -> None:
    """Add the counts of one run to the table that keeps all runs."""
    audit.write.mode("append").parquet(path)
