"""Quality classification: ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RunHash, joined_bytes, mapped, slices

SLOTS = 1 << 18
#: A word longer than so many bytes also counts by its first so many.
PREFIXES = (4, 6, 7)
#: Learned are slots whose log odds between the highest grade and the others are so many standard errors from 0.
CLEAR = 3.0
#: Bound of the labelled rows that are learned from; chosen by a hash of their id.
SAMPLE = 6000
PENALTY, STEPS = 1e-4, 400
#: A document is kept if the chance of the highest grade is at least this.
KEEP = 0.5
#: Bytes of text that are worked on at once; working arrays take some hundred times as much.
SLICE = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_INSIDE = np.array([c > 127 or chr(c).isalnum() for c in range(256)])


def _grade(quality: Column, toxic: Column) -> Column:
    """The graded rating: 0 to 2, one grade for quality and one for not being toxic; null if either label is."""
    return (quality + 1 - toxic).cast("int")


@dataclass
class Model:
    """P(grade > k) = 1 / (1 + exp(cuts[k] - weights . x)), one weight per slot for all grades."""

    weights: np.ndarray
    cuts: np.ndarray

    def beyond(self, scores: np.ndarray) -> np.ndarray:
        """Texts x thresholds: the chance of a grade above each threshold."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - scores[:, None], -500, 500)))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and slot of every distinct hashed word, word start and shape token of every text, sorted by text.

    Shape tokens say in which of a few ranges the shares of upper case, of symbols and of repeated words and the
    mean word length lie, so that the same weights serve words and layout. Whole texts are read.
    """
    data, offsets = joined_bytes(texts)
    n = len(texts)
    size = np.diff(offsets)
    inside = _INSIDE[data]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(starts):  # words end at a text's end
        inner = np.unique(offsets[1:-1])
        cut = inner[(np.searchsorted(starts, inner, "left") - 1 >= 0)]
        at = np.searchsorted(starts, cut, "left") - 1
        split = cut[(starts[at] < cut) & (cut < ends[at])]
        starts, ends = np.sort(np.concatenate([starts, split])), np.sort(np.concatenate([ends, split]))
    owner = np.searchsorted(offsets, starts, "right") - 1
    hashed = RunHash(_FOLD[data])

    def slot(s: np.ndarray, e: np.ndarray, of: np.ndarray) -> np.ndarray:
        return of * SLOTS + (hashed.of(s, e) >> np.uint64(40)).astype(np.int64) % (SLOTS - 64)

    whole, first = np.unique(slot(starts, ends, owner), return_index=True)
    words = np.bincount(owner, minlength=n)
    distinct = np.bincount(whole // SLOTS, minlength=n)
    pairs, s, e, own = [whole], starts[first], ends[first], owner[first]
    for k in PREFIXES:
        long = e - s > k
        s, e, own = s[long], e[long], own[long]
        pairs.append(slot(s, s + k, own))
    pair = np.unique(np.concatenate(pairs))

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask)))
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(size, 1)

    upper, lower = share((data >= 65) & (data <= 90)), share((data >= 97) & (data <= 122))
    symbol = share((data > 32) & ~inside & (data != 46) & (data != 44))
    shapes = (
        (upper / np.maximum(upper + lower, 1e-9), (0.02, 0.1, 0.3, 0.6)),
        (symbol, (0.005, 0.02, 0.05, 0.1, 0.2)),
        (1 - distinct / np.maximum(words, 1), (0.2, 0.4, 0.6, 0.8, 0.95)),
        (np.bincount(owner, ends - starts, minlength=n) / np.maximum(words, 1), (2, 4, 6, 8, 12)),
        (words, (1, 5, 20, 100)),
    )
    base, rows, cols = SLOTS - 64, [pair // SLOTS], [pair % SLOTS]
    for values, limits in shapes:
        rows.append(np.arange(n))
        cols.append(base + np.searchsorted(limits, values, "right"))
        base += len(limits) + 1
    return np.concatenate(rows), np.concatenate(cols)


def values(cols: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Shape tokens weigh 1, a text's words 1 over the fourth root of their number: a rare word still counts in a long text."""
    word = cols < SLOTS - 64
    count = np.bincount(rows[word], minlength=n)
    return np.where(word, 1 / np.maximum(count, 1)[rows] ** 0.25, 1.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most `sample` labelled texts; the thresholds' number follows from the grades 0, 1 and 2.

    Rows without text or without either label are not learned from; several labels of one id are all used, equal rows
    once. Without any labelled row every chance is one half.
    """
    graded = labels.select(F.col("doc_id"), _grade(F.col("quality"), F.col("toxic")).alias("grade")).where("grade between 0 and 2")
    rows = docs.select("doc_id", "text").where("text is not null")
    # Ids first: the texts of the chosen rows only are moved, and by how many rows there are the share is chosen.
    total = graded.count()
    slice_ = graded.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < min(1.0, sample / max(total, 1)) * (1 << 20))
    chosen = slice_.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            r, c = features(part.column("text"))
            order = np.argsort(r, kind="stable")
            lists = np.split(c[order].astype("<i4"), np.cumsum(np.bincount(r, minlength=part.num_rows))[:-1])
            packed = pa.array([x.tobytes() for x in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in ("id", "h", "grade")), packed], names=["id", "h", "grade", "slots"])

    # At most `sample` pairs of numbers are broadcast. Rows of one id and text are one; an id may still have many texts.
    joined = rows.join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id").alias("id"), F.xxhash64("text").alias("h"), "grade", "text")
    distinct = mapped(joined, run, "id long, h long, grade int, slots binary").groupBy("id", "h", "grade").agg(F.first("slots").alias("slots"))
    found = distinct.orderBy("id", "h", "grade").limit(sample).collect()
    return solve(sorted((r.grade, bytes(r.slots)) for r in found))


def solve(rated: list[tuple[int, bytes]], grades: int = 3) -> Model:
    """Maximum likelihood by gradient steps with momentum; thresholds stay ordered as sums of positive gaps.

    Slots are scaled by their log odds, and those without clear odds are left out, so that the many random words of
    a text do not outweigh the few telling ones.
    """
    n = len(rated)
    model = Model(np.zeros(SLOTS), np.zeros(grades - 1))
    if not n:
        return model
    grade = np.array([g for g, _ in rated])
    row = np.repeat(np.arange(n), [len(s) // 4 for _, s in rated])
    col = np.frombuffer(b"".join(s for _, s in rated), "<i4").astype(np.int64)
    scale = _odds(col, grade[row] < grades - 1, int((grade < grades - 1).sum()), n)
    val = values(col, row, n) * scale[col]
    row, col, val = row[val > 0], col[val > 0], val[val > 0]
    used, col = np.unique(col, return_inverse=True)
    above = (grade[:, None] > np.arange(grades - 1)[None, :]).mean(axis=0).clip(0.01, 0.99)
    cuts = -np.log(above / (1 - above))
    cuts = np.maximum.accumulate(cuts + np.arange(grades - 1) * 1e-3)
    free = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    theta, velocity, second = np.concatenate([np.zeros(len(used)), free]), 0.0, 0.0
    for t in range(1, STEPS + 1):
        w, cuts = theta[: len(used)], _cuts(theta[len(used) :])
        score = np.bincount(row, val * w[col], minlength=n)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        hi, lo = (1 / (1 + np.exp(np.clip(score - e, -500, 500))) for e in (edges[grade + 1], edges[grade]))
        p = np.maximum(hi - lo, 1e-12)  # P(grade) = F(cut above - score) - F(cut below - score)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        g_w = np.bincount(col, val * (d_hi - d_lo)[row], minlength=len(used)) / n + PENALTY * w
        g_cut = np.zeros(grades - 1)
        np.add.at(g_cut, grade[grade < grades - 1], -d_hi[grade < grades - 1] / n)
        np.add.at(g_cut, grade[grade > 0] - 1, d_lo[grade > 0] / n)
        tail = np.cumsum(g_cut[::-1])[::-1]
        g = np.concatenate([g_w, tail[:1], tail[1:] * np.exp(theta[len(used) + 1 :])])
        velocity = 0.9 * velocity + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        theta = theta - 0.05 * (velocity / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    model.weights[used], model.cuts = theta[: len(used)] * scale[used], _cuts(theta[len(used) :])
    return model


def _odds(col: np.ndarray, low: np.ndarray, n_low: int, n: int) -> np.ndarray:
    """Per slot the size of its log odds between low and highest grades; 0 if not CLEAR; 1 for shape tokens."""
    have_low, have = np.bincount(col, low, minlength=SLOTS), np.bincount(col, minlength=SLOTS)
    have_top = have - have_low
    odds = np.log((have_low + 0.5) / (n_low + 1)) - np.log((have_top + 0.5) / (n - n_low + 1))
    clear = np.abs(odds) > CLEAR * np.sqrt(1 / (have_low + 0.5) + 1 / (have_top + 0.5))
    out = np.where(clear, np.abs(odds), 0.0)
    out[SLOTS - 64 :] = 1.0
    return out


def _cuts(free: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    rows, cols = features(texts)
    return np.bincount(rows, values(cols, rows, len(texts)) * model.weights[cols], minlength=len(texts))


def _rated(part: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray]:
    beyond = model.beyond(scores(part.column("text"), model))
    return beyond.sum(axis=1), beyond[:, -1]


def rate(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, expected_grade (0 to 2), p_top (chance of grade 2), keep (p_top >= KEEP): one row per row of docs.

    Null and empty texts have shape tokens only and are rated by them, equally. Equal texts are rated equally;
    rows with equal or null ids are each rated.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            grade, top = _rated(part, shared.value)
            columns = [part.column("doc_id"), pa.array(grade), pa.array(top), pa.array(top >= KEEP)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "expected_grade", "p_top", "keep"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return mapped(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, expected_grade double, p_top double, keep boolean")


def select(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that rate() would keep, with all their columns, null and empty texts and repeated rows as there."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            yield part.filter(pa.array(_rated(part, shared.value)[1] >= KEEP))

    return mapped(docs, run, docs.schema)
