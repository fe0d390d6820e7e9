"""Document fingerprints by Order MinHash, which follows edit distance: minimal k-mers kept in text order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, mix, slices

#: Characters of a k-mer, k-mers of a tuple, tuples of a fingerprint.
K, TUPLE, TUPLES = 6, 2, 32
#: Ids are cut into ranges of so many bytes of text, into RANGES of them at most; a task gets TASK_BYTES of ranges.
RANGE_BYTES, RANGES, TASK_BYTES = 1 << 20, 100_000, 16 << 20
_ODD = mix(np.arange(1, TUPLES + 1, dtype=np.uint64)) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def sketch(text: str) -> np.ndarray:
    """TUPLES 16-bit hashes. k-mers are numbered by occurrence, so repetitions count; a text shorter than K is one k-mer.

    For each tuple the TUPLE k-mers of the least hashes are taken and hashed in the order in which they stand.
    An empty text has zeros.
    """
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    if not len(points):
        return np.zeros(TUPLES, np.uint16)
    codes, width = mix(points + _STEP), min(K, len(points))
    gram = codes[: len(codes) - width + 1].copy()
    for k in range(1, width):
        gram = gram * _STEP + codes[k : len(codes) - width + 1 + k]
    gram = mix(gram)
    bits = np.uint64(len(gram).bit_length())
    key = (gram >> bits << bits) | np.arange(len(gram), dtype=np.uint64)
    key.sort()
    place = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    key >>= bits
    at = np.arange(len(key))
    fresh = np.concatenate(([True], key[1:] != key[:-1]))
    occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0))
    value = mix(gram[place] + occurrence.astype(np.uint64) * _STEP)
    out = np.zeros(TUPLES, np.uint64)
    step = max(1, (1 << 20) // len(value))  # bounded memory for long texts
    for start in range(0, TUPLES, step):
        hashed = value[None, :] * _ODD[start : start + step, None]
        row = np.arange(len(hashed))
        least = []
        for _ in range(min(TUPLE, len(value))):
            best = hashed.argmin(axis=1)
            hashed[row, best] = np.uint64(0xFFFFFFFFFFFFFFFF)
            least.append(place[best])
        for position in np.sort(np.array(least), axis=0):
            out[start : start + step] = mix(out[start : start + step] + gram[position])
    return (out >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of tuples that agree."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many of the following text's first ones, or all of them."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _ranges(ids: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds of n ranges of ids of like size, and the least id of every range that has any (both on the driver: n numbers)."""
    bounds = np.unique(np.array(ids.approxQuantile("doc_id", list(np.arange(1, n) / n), 0.2 / n) if n > 1 else [], np.float64))
    found = ids.select(_numbered(bounds)("doc_id").alias("p"), "doc_id").groupBy("p").agg(F.min("doc_id").alias("least"))
    return bounds, np.array(sorted((r.p, r.least) for r in found.collect()), np.int64).reshape(-1, 2)


def _numbered(bounds: np.ndarray):
    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right").astype(np.int32))

    return number


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """part, doc_id, text, extra: partitions of a range of ids each, in order, with the next range's first row as extra.

    Rows are ordered by doc_id (a whole number; null first), then by text. Texts are moved once; rows that open a range
    are moved to the range before, too, and the very first row to the last range.
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 62))).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bounds, firsts = _ranges(rows.select("doc_id"), min(RANGES, max(1, ceil(size / RANGE_BYTES))))
    before = dict(zip(firsts[:, 1].tolist(), np.roll(firsts[:, 0], 1).tolist(), strict=True))
    opening = np.array(sorted(before), np.int64)

    @F.pandas_udf("int")
    def earlier(ids: pd.Series) -> pd.Series:
        at = ids.to_numpy()
        hit = np.isin(at, opening)
        out = np.full(len(at), -1, np.int32)
        out[hit] = [before[i] for i in at[hit].tolist()]
        return pd.Series(out)

    own = F.struct(_numbered(bounds)("doc_id").alias("part"), F.lit(False).alias("extra"))
    other = F.struct(earlier("doc_id").alias("part"), F.lit(True).alias("extra"))
    spread = rows.select("doc_id", "text", F.explode(F.array(own, other)).alias("to")).where("to.part >= 0")
    spread = spread.select("to.part", "to.extra", "doc_id", "text")
    tasks = max(1, ceil(size / TASK_BYTES))
    return spread.repartition(tasks, "part").sortWithinPartitions("part", "extra", "doc_id", "text")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    A null text is an empty one; two empty texts are alike. The row after the last is the first, so a single row
    follows itself. Rows with equal ids follow one another by text; null ids come first and stay null.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row whose follower has not come yet
        done = None  # the part whose first extra row has come
        for part in slices(batches, "text"):
            out = []
            for p, extra, i, t in zip(*(part.column(c).to_pylist() for c in ("part", "extra", "doc_id", "text")), strict=True):
                if extra and done == p:
                    continue
                mark = sketch(t)
                if last and last[0] == p:
                    out.append(_row(*last[1:], t, mark))
                last, done = (None, p) if extra else ((p, i, t, mark), done)
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    rows = mapped(neighbours(docs, doc_id, text), run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
    return rows.withColumn("doc_id", F.nullif("doc_id", F.lit(-(1 << 62))))


def _row(i: int, text: str, mark: np.ndarray, following: str, next_mark: np.ndarray) -> tuple:
    new = edited(text, following)
    own = sketch(new)
    digest = hashlib.sha256(new.encode()).hexdigest()
    return i, len(text), digest, mark.tobytes().hex(), own.tobytes().hex(), likeness(mark, own), likeness(mark, next_mark)
