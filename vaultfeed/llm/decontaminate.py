"""Benchmark decontamination: documents are streamed through a suffix automaton of all benchmark items."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices, written

WINDOW = 10
#: Words of one automaton; a larger benchmark is worked through in blocks, each against all documents.
BLOCK_WORDS = 100_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def words(text: str | None) -> list[bytes]:
    """Lower-case A-Z, then the runs without ASCII punctuation, space or control characters, as UTF-8."""
    return text.encode().translate(_PLAIN).split() if text else []


class Automaton:
    """A generalised suffix automaton over words; its states know the items of their windows.

    `full[s]`: items that contain the window of `window` words ending here (for matches at least that long);
    `short[s]`: (words, item) of items shorter than a window that end here, the state's own and inherited ones.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocabulary: dict[bytes, int] = {}
        ends = []
        for _, item in items:
            path = [0]
            for w in item:
                path.append(self._extend(path[-1], self.vocabulary.setdefault(w, len(self.vocabulary))))
            ends.append(path)
        self.full: list[set | None] = [None] * len(self.next)
        self.short: list[tuple] = [()] * len(self.next)
        for item_id, item in items:
            state = 0
            for k, w in enumerate(item, 1):
                state = self.next[state][self.vocabulary[w]]
                if len(item) >= window and k >= window:
                    at = self._window_state(state)
                    self.full[at] = (self.full[at] or set()) | {item_id}
            if 0 < len(item) < window:
                while self.length[self.link[state]] >= len(item):
                    state = self.link[state]
                self.short[state] += ((len(item), item_id),)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[s] += self.short[self.link[s]]
            if self.full[s] is None and self.length[s] >= window:
                self.full[s] = self.full[self._window_state(s)]

    def _window_state(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _new(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _copy(self, p: int, w: int, q: int) -> int:
        """A copy of q for the matches through p, to which p and its suffixes are turned."""
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if (q := self.next[last].get(w)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._copy(last, w, q)
        state, p = self._new(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._copy(p, w, q)
        return state

    def hits(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Runs of words (start, end) covered by windows, joined where they touch or overlap, and the items hit."""
        follow, link, length, full, short, window = self.next, self.link, self.length, self.full, self.short, self.window
        spans: list[tuple[int, int]] = []
        items: set = set()
        state = matched = 0
        for at, w in enumerate(map(self.vocabulary.get, text), 1):
            if w is None:
                state = matched = 0
                continue
            to = follow[state].get(w)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = follow[state].get(w)
                matched = length[state]
            state, matched = to, matched + 1
            long = window if matched >= window and full[state] else 0
            if long:
                items |= full[state]
            for n, item in short[state]:
                if n <= matched:
                    items.add(item)
                    long = max(long, n)
            if long:
                start = at - long
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, at))
        return spans, items


def automata(items: DataFrame, item_id: str, text: str, window: int) -> Iterator[Automaton]:
    """One automaton per block of items, each of about BLOCK_WORDS words, so that driver and workers hold one at a time."""
    rows = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(size / 6 / BLOCK_WORDS))
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Automaton([(r.item_id, words(r.text)) for r in part.toLocalIterator()], window)


def matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, runs (array of start and end word in turn), item_ids: one row per row of docs.

    A null or empty text has no words, no runs and no items. An empty benchmark hits nothing; an item without words
    or without text has no window; windows of an item whose id is null are hit but name no item. Items that share an
    id count once. Rows of docs with equal or null ids are each judged by themselves.
    """
    kind = dict(docs.select(F.col(doc_id).alias("d")).dtypes)["d"]
    schema = f"doc_id {kind}, text string, n_words long, runs array<int>, item_ids array<string>"
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("runs"),
        F.array().cast("array<string>").alias("item_ids"),
    )
    for k, automaton in enumerate(automata(items, item_id, item_text, window)):
        rows = mapped((written(rows, "matches") if k else rows), _streamed(docs, automaton), schema)
    return rows


def _streamed(docs: DataFrame, automaton: Automaton):
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in slices(batches, "text"):
            counts, runs, found = [], [], []
            for text, old, ids in zip(*(part.column(c).to_pylist() for c in ("text", "runs", "item_ids")), strict=True):
                ws = words(text)
                spans, items = own.hits(ws)
                spans = _joined([*spans, *zip(old[::2], old[1::2], strict=True)]) if old else spans
                counts.append(len(ws))
                runs.append([x for s in spans for x in s])
                found.append(sorted({*ids, *(i for i in items if i is not None)}))
            new = [pa.array(counts, pa.int64()), pa.array(runs, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), *new], names=part.schema.names)

    return run


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document, from matches()."""
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, x: x - acc)
    return matches(docs, items).select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("item_ids")), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def clean(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, text: str = "text"
) -> DataFrame:
    """The rows of docs with their columns; covered runs are cut out of the text, from first to last word of each run.

    A row is dropped if more than max_coverage of its words are covered. All other rows, null and empty texts too,
    stay as they are. The runs of all blocks are gathered on the uncut text, as in matches(), before any is cut.
    """
    mark = "_runs"
    while mark in docs.columns:
        mark += "_"
    rows = docs.withColumn(mark, F.array().cast("array<int>"))
    for k, automaton in enumerate(automata(items, "item_id", "text", window)):
        rows = mapped((written(rows, "clean") if k else rows), _marked(docs, automaton, text, mark), rows.schema)
    return mapped(rows, _cut(text, mark, max_coverage), docs.schema)


def _marked(docs: DataFrame, automaton: Automaton, column: str, mark: str):
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in slices(batches, column):
            runs = []
            for text, old in zip(part.column(column).to_pylist(), part.column(mark).to_pylist(), strict=True):
                spans, _ = own.hits(words(text))
                spans = _joined([*spans, *zip(old[::2], old[1::2], strict=True)]) if old else spans
                runs.append([x for s in spans for x in s])
            where = part.schema.get_field_index(mark)
            columns = list(part.columns)
            columns[where] = pa.array(runs, part.schema.field(where).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return run


def _cut(column: str, mark: str, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column):
            texts, keep = part.column(column).to_pylist(), []
            for k, (text, runs) in enumerate(zip(texts, part.column(mark).to_pylist(), strict=True)):
                spans = list(zip(runs[::2], runs[1::2], strict=True))
                keep.append(not spans or sum(b - a for a, b in spans) <= most * len(words(text)))
                if spans:
                    raw = text.encode()
                    at = [m.span() for m in _WORD.finditer(raw.lower())]
                    for a, b in reversed(spans):
                        raw = raw[: at[a][0]] + raw[at[b - 1][1] :]
                    texts[k] = raw.decode()
            where = part.schema.get_field_index(column)
            part = part.set_column(where, part.schema.field(where), pa.array(texts, part.schema.field(where).type))
            yield part.filter(pa.array(keep)).drop_columns([mark])

    return run


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS MATERIALIZED (SELECT item_id, {_WORDS} AS ws FROM benchmark),
spots AS (
  SELECT item_id, least({WINDOW}, len(ws)) AS n, ws, unnest(range(1, greatest(len(ws) - {WINDOW}, 0) + 2)) AS i
  FROM b WHERE len(ws) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w FROM spots),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths WHERE len(ws) >= n)),
found AS MATERIALIZED (SELECT doc_id, item_id, g.n, i FROM grams g JOIN windows USING (n, w)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM found)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
