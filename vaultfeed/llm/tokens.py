"""Token counts of sections: whole documents are encoded once, token spans are joined to section spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, worker_encoder
from .common import joined_bytes, mapped, runs, slices

Section = tuple[str, int, int]


def paragraphs(text: str) -> list[Section]:
    """Every line with its line break, named by its kind; an empty text is one empty line."""
    out, start = [], 0
    while True:
        end = text.find("\n", start) + 1 or len(text)
        line = text[start:end].strip()
        out.append(("blank" if not line else "list" if line[0] in "-*•|#" else "prose", start, end))
        if end == len(text):
            return out
        start = end


def spans(ids: np.ndarray, lengths: np.ndarray, first: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character start and end of every token of a run of texts, from the byte lengths of the tokens.

    `first` tells, per byte, how many characters begin before it; a token that begins or ends inside a character
    holds that character.
    """
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    inside = (data[np.minimum(starts, len(data) - 1)] & 0xC0) == 0x80
    return first[starts] - inside, first[ends]


def allocate(start: np.ndarray, end: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The section of every token, -1 for none, and whether it crosses a boundary.

    Sections are sorted and don't overlap. A token goes to the section with most of its characters, to the first of
    several with as many; a token that touches more than one section, or lies partly in none, crosses.
    """
    if not len(s):
        return np.full(len(start), -1), np.zeros(len(start), bool)
    first = np.searchsorted(e, start, "right")
    last = np.searchsorted(s, end, "left") - 1
    owner = np.where(last >= first, first, -1)
    many = np.flatnonzero(last > first)
    if len(many):
        token = np.repeat(many, last[many] - first[many] + 1)
        section = runs(first[many], last[many] - first[many] + 1)
        common = np.minimum(end[token], e[section]) - np.maximum(start[token], s[section])
        best = np.lexsort((section, -common, token))
        owner[many] = section[best[np.concatenate(([True], np.diff(token[best]) > 0))]]
    at = np.maximum(owner, 0)
    crossing = (owner >= 0) & ((start < s[at]) | (end > e[at]))
    return owner, crossing


def counts(
    docs: DataFrame,
    vocabulary: Vocabulary,
    sections: Callable[[str], list[Section]] = paragraphs,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, section (number), name, start, end (code points), n_tokens, n_crossing: one row per section of every row.

    Every token is counted once, in the section that allocate() gives it; one that lies in no section is counted
    in a row numbered -1, which is there only then. `sections` gives sorted spans; where two overlap, the later one
    starts where the earlier one ends. A null text is an empty text. Rows with equal or null ids are each counted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    names = ["doc_id", "section", "name", "start", "end", "n_tokens", "n_crossing"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value)
        lengths = np.array([len(t) for t in shared.value.tokens], np.int64)
        for part in slices(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays(*_counted(part, encoder, lengths, sections, kinds), names=names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return mapped(rows, run,
        f"doc_id {dict(rows.dtypes)['doc_id']}, section int, name string, start int, end int, n_tokens long, n_crossing long",
    )


def _counted(part: pa.RecordBatch, encoder, lengths: np.ndarray, sections, kinds) -> tuple[list[pa.Array]]:
    texts = [t or "" for t in part.column("text").to_pylist()]
    data, offsets = joined_bytes(part.column("text"))
    first = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    ids = [np.frombuffer(encoder.encode(t), "<u4") for t in texts]
    start, end = spans(np.concatenate(ids).astype(np.int64), lengths, first, data) if len(data) else (np.zeros(0, int),) * 2
    owner_doc, number, name, s, e = [], [], [], [], []
    for k, t in enumerate(texts):
        base = done = int(first[offsets[k]])
        for i, (label, a, b) in enumerate(sections(t)):
            a = min(max(base + a, done), base + len(t))
            done = max(a, min(base + b, base + len(t)))
            owner_doc.append(k), number.append(i), name.append(label), s.append(a), e.append(done)
    s, e, owner_doc = np.array(s, np.int64), np.array(e, np.int64), np.array(owner_doc, np.int64)
    solid = np.flatnonzero(e > s)  # an empty section holds no token
    owner, crossing = allocate(start, end, s[solid], e[solid])
    token_doc = np.repeat(np.arange(len(texts)), [len(x) for x in ids])
    at = np.where(owner >= 0, solid[owner] if len(solid) else -1, -1)
    at[(at >= 0) & (owner_doc[at] != token_doc) if len(owner_doc) else at >= 0] = -1
    held = at[at >= 0]
    n = np.bincount(held, minlength=len(s))
    over = np.bincount(held, crossing[at >= 0], minlength=len(s)).astype(np.int64)
    base = first[offsets[:-1]]
    rest = np.bincount(token_doc[at < 0], minlength=len(texts))
    loose = np.flatnonzero(rest)
    doc = np.concatenate([owner_doc, loose])
    columns = [
        [*number, *[-1] * len(loose)],
        [*name, *[None] * len(loose)],
        [*(s - base[owner_doc]), *[0] * len(loose)],
        [*(e - base[owner_doc]), *[0] * len(loose)],
        [*n, *rest[loose]],
        [*over, *[0] * len(loose)],
    ]
    return ([part.column("doc_id").take(pa.array(doc)), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],)
