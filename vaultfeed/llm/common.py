"""What the operators share: bounded slices of Arrow batches, hashes of byte runs, written tables, components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which every executor sees; an own one only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor sees")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read again: lineage ends there and lost executors cost nothing above it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, group: str, order: list[str], position: str, count: str) -> DataFrame:
    """rows with their position, from 0, within their group in the given order, and the number of rows of the group.

    rows should be a stored table: it is read twice. Rows are dealt by ranges of the order, equal ones by their place
    in the table, so that a group of any size lies in many tasks; it is numbered there and the rows before are added.
    """
    spread = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    dealt = spread.repartitionByRange(group, *order, "_tie").sortWithinPartitions(group, *order).drop("_tie")
    dealt = written(dealt.withColumn("_at", F.monotonically_increasing_id()), "ordered").withColumn("_part", F.shiftright("_at", 33))
    parts = dealt.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        group, "_part", (F.col("_first") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_shift"), F.sum("_n").over(whole).alias(count)
    )
    placed = dealt.join(written(parts, "parts"), [group, "_part"])  # stored, so that its size is known
    return placed.withColumn(position, F.col("_at") - F.col("_shift")).drop("_at", "_part", "_shift")


_SHIPPED: set[str] = set()


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(run, schema), after this package has been sent to the executors, once per application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / "vaultfeed.zip"  # on the driver only; Spark serves it
        with zipfile.ZipFile(archive, "w") as out:
            for source in (package / "__init__.py", *sorted((package / "llm").glob("*.py"))):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Returns freed memory to the system: a worker process outlives its task and would else keep the most it ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `limit` bytes of `column`, or of one row where that alone is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(byte_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_lengths(column: pa.Array) -> np.ndarray:
    offsets = _offsets(column)
    return np.diff(offsets).astype(np.int64)


def _offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(column.buffers()[1], kind) if column.buffers()[1] is not None else np.zeros(1, kind)
    return raw[column.offset : column.offset + len(column) + 1]


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column as one array, and the n + 1 offsets of its rows; null rows are empty."""
    if column.null_count:
        column = column.fill_null(b"" if "binary" in str(column.type) else "")
    offsets = _offsets(column).astype(np.int64)
    data = column.buffers()[2]
    if data is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated indexes starts[i] .. starts[i] + lengths[i] - 1."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    full = lengths > 0
    starts, lengths = starts[full], lengths[full]
    begin = np.cumsum(lengths) - lengths
    out[begin] = starts - np.concatenate(([0], starts[:-1] + lengths[:-1] - 1))
    out[0] = starts[0]
    return np.cumsum(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RunHash:
    """64-bit hashes of arbitrary runs of one byte array, from one pass of prefix sums."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, data: np.ndarray, seed: int = 1):
        self.up, self.down = _powers(len(data) + 1, self.BASE)
        codes = mix(np.arange(256, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x632BE59BD9B4E019))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Runs of equal bytes have equal hashes; the length takes part."""
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64; grown when a longer run comes."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[base] = have = (both[0], both[1])
        if size > (1 << 20):  # not kept: one very long text shall not hold memory afterwards
            del _POWERS[base]
    return have


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node of the undirected edges; root: the smallest node that can be reached.

    Alternates two steps over the edges until nothing changes: each node's larger neighbours, then its smaller
    ones, are linked to the smallest neighbour. A round writes two tables; the driver only sees a count and two sums,
    observed while the edges are written. The least neighbours are a table of their own, so that a join with a node of
    very many neighbours can be split.
    """

    def stored(pair: DataFrame) -> tuple[DataFrame, tuple]:
        seen, h = Observation(), F.xxhash64("lo", "hi")
        pair = pair.where("lo < hi").distinct().observe(seen, F.count("*").alias("n"), F.sum(h % 1_000_003).alias("sum"), F.bit_xor(h).alias("xor"))
        pair = written(pair, "edges")
        return pair, tuple(seen.get[k] for k in ("n", "sum", "xor"))

    pair, before = stored(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")))
    while before[0]:
        both = pair.union(pair.select("hi", "lo")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(written(least, "least"), "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").select("m", F.explode(F.array("lo", "hi")).alias("hi"))
        pair, now = stored(small.select(F.col("m").alias("lo"), "hi"))
        if now == before:
            break
        before = now
    roots = pair.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(pair.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
