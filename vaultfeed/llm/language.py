"""Language identification by string kernels: Nyström landmarks and one-versus-rest kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, mix, slices

ORDERS = (1, 2, 3, 4)
SLOTS = 1 << 15  # of one order's n-grams; texts with equal n-grams always agree
#: Bounds of the labelled sample and of the landmarks, per language and of all languages together.
PER_LANGUAGE, SAMPLE, LANDMARKS, MARKS = 250, 16_000, 24, 512
RIDGE = 1e-3
BATCH = 128


def _letters() -> np.ndarray:
    """Code point of the lower-case letter, or 32 for what isn't a letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_TABLE: list[np.ndarray] = []


def present(text: str | None) -> np.ndarray:
    """The sorted slots of the n-grams of all orders that occur in the text's letters, words set off by one space."""
    if not _TABLE:
        _TABLE.append(_letters())
    points = _TABLE[0][np.frombuffer((text or "").encode("utf-32-le"), "<u4")]
    if not (points != 32).any():
        return np.zeros(0, np.int64)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    codes = mix(np.concatenate(([32], points[keep], [32])).astype(np.uint64))
    flags = np.zeros(len(ORDERS) * SLOTS, bool)
    gram = codes
    for k, n in enumerate(ORDERS):
        if n > 1:
            gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        flags[((gram * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int64) + k * SLOTS] = True
    return np.flatnonzero(flags)


@dataclass
class Model:
    """Landmark texts as columns of a presence matrix over the slots they use, and one weight per landmark and language."""

    languages: list[str]
    slot: np.ndarray  # slot -> row of the matrix, or -1
    matrix: np.ndarray  # rows x landmarks, 0 or 1 over the root of the landmark's size
    weights: np.ndarray  # landmarks + 1 x languages

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Cosine-normalised presence kernels of texts with all landmarks, one matrix product per BATCH texts."""
        out = np.zeros((len(sets), self.matrix.shape[1]), np.float32)
        dense = np.zeros((BATCH, self.matrix.shape[0]), np.float32)
        for start in range(0, len(sets), BATCH):
            part = sets[start : start + BATCH]
            dense[: len(part)] = 0
            for row, s in zip(dense, part, strict=False):
                at = self.slot[s]
                row[at[at >= 0]] = 1 / np.sqrt(max(1, len(s)))
            out[start : start + len(part)] = dense[: len(part)] @ self.matrix
        return out

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        kernel = self.kernel(sets)
        return np.hstack([kernel, np.ones((len(sets), 1), np.float32)]) @ self.weights


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is 2 modulo 4; a null id is not held out, and never learned from either."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", held: bool = True) -> Model:
    """A model of all languages from at most PER_LANGUAGE texts of each, fewer with many languages, chosen by a hash of the text.

    Only rows with a language and a text that has a letter, a text that repeats once; with held, rows that held_out() names are left out.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()) if held else rows
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    # Distinct texts before the rank, so that copies of one take no other's place.
    light = rows.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("doc_id"))
    each = max(1, min(PER_LANGUAGE, SAMPLE // max(1, light.select("lang").distinct().count())))
    chosen = light.withColumn("r", F.row_number().over(order)).where(F.col("r") <= each).select("h").distinct()
    wanted = [r.h for r in chosen.collect()]  # at most SAMPLE numbers, or one per language
    picked = rows.where(F.xxhash64("text").isin(wanted)) if wanted else rows.limit(0)
    picked = picked.dropDuplicates(["lang", "text"]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = [present(t).astype(np.int32) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(sets, pa.list_(pa.int32()))], names=["lang", "slots"])

    sample = [(r.lang, np.array(r.slots, np.int64)) for r in mapped(picked, run, "lang string, slots array<int>").collect()]
    return solve(sorted(((g, s) for g, s in sample if len(s)), key=lambda x: (x[0], x[1].tobytes())))


def solve(sample: list[tuple[str, np.ndarray]]) -> Model:
    """Landmarks spread evenly over each language's sample; ridge regression on the Nyström features of the sample.

    With more than MARKS languages, MARKS landmarks are spread evenly over the languages.
    """
    texts: dict[str, list[np.ndarray]] = {}
    for g, s in sample:
        texts.setdefault(g, []).append(s)
    languages, marks = sorted(texts), []
    for g in languages:
        own = texts[g]
        marks += [own[i] for i in np.linspace(0, len(own) - 1, min(LANDMARKS, max(1, MARKS // len(languages)), len(own))).astype(int)]
    if len(marks) > MARKS:
        marks = [marks[i] for i in np.linspace(0, len(marks) - 1, MARKS).astype(int)]
    used = np.unique(np.concatenate(marks)) if marks else np.zeros(0, np.int64)
    slot = np.full(len(ORDERS) * SLOTS, -1, np.int32)
    slot[used] = np.arange(len(used))
    matrix = np.zeros((len(used), len(marks)), np.float32)
    for k, s in enumerate(marks):
        matrix[slot[s], k] = 1 / np.sqrt(len(s))
    model = Model(languages, slot, matrix, np.zeros((len(marks) + 1, len(languages)), np.float32))
    if not sample:
        return model
    values, vectors = np.linalg.eigh(model.kernel(marks).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))  # Nyström features: kernel with landmarks times K^(-1/2)
    x = model.kernel([s for _, s in sample]).astype(np.float64) @ root
    x = np.hstack([x, np.ones((len(x), 1))])
    number = {g: k for k, g in enumerate(languages)}
    y = np.full((len(sample), len(languages)), -1.0)
    y[np.arange(len(sample)), [number[g] for g, _ in sample]] = 1.0
    share = np.array([1 / len(texts[g]) for g, _ in sample])[:, None] * len(sample) / len(languages)
    w = np.linalg.solve(x.T @ (share * x) + RIDGE * len(sample) * np.eye(x.shape[1]), x.T @ (share * y))
    model.weights = np.vstack([root @ w[:-1], w[-1:]]).astype(np.float32)
    return model


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row of docs; only the whole text is looked at.

    A null text, one without a letter, or a model without languages gives `und` and 0. The score is the share of
    the best language in a softmax over the regressions; ties go to the first language by name. Equal texts
    get equal predictions; rows with equal or null ids are each predicted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in slices(batches, "text"):
            sets = [present(t) for t in part.column("text").to_pylist()]
            best, score = ["und"] * len(sets), np.zeros(len(sets))
            if own.languages:
                raw = own.scores(sets).astype(np.float64)
                soft = np.exp(4 * (raw - raw.max(axis=1, keepdims=True)))
                soft /= soft.sum(axis=1, keepdims=True)
                for k, s in enumerate(sets):
                    if len(s):
                        top = int(raw[k].argmax())
                        best[k], score[k] = own.languages[top], soft[k, top]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(best, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"]
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return mapped(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the documents that are not held out."""
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
