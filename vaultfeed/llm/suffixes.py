"""Removal of repeated byte strings: windows meet at their minimal k-gram, and deep-shallow sorted contexts find repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RunHash, joined_bytes, mapped, runs, slices, written

#: A window is a string of LENGTH bytes; its anchor is its GRAM-byte substring of the least hash, the first of equal ones.
LENGTH, GRAM = 100, 16
SPAN = LENGTH - GRAM + 1
#: Bytes that are ordered by words with a library sort before blind tries take over.
SHALLOW = 48
#: Bytes of text hashed at a time, of segments gathered before they are sent, and of segments per bucket on average.
CHUNK_BYTES, PACK_BYTES, BUCKET_BYTES = 2 << 20, 40 << 20, 24 << 20
#: Different segments of one anchor above which its windows are sent one by one; the share of segments (one in so many, by
#: their bytes) that this is judged by, which decides on the way only, not on results; windows gathered before they are
#: sent; bytes of such a window.
HOT_SEGMENTS, SAMPLED, PACK_WINDOWS, WINDOW_BYTES = 20_000, 64, 1 << 18, 32
_BLOCK = 1 << 19


def anchors(hashed: RunHash, n: int) -> np.ndarray:
    """The anchor position of the window at each start 0 .. n - LENGTH; blocks keep the arrays small."""
    out = [np.zeros(0, np.int64)]
    for first in range(0, max(n - LENGTH + 1, 0), _BLOCK):
        last = min(first + _BLOCK, n - LENGTH + 1)
        at = np.arange(first, last + SPAN - 1)
        least = (hashed.of(at, at + GRAM) >> np.uint64(24) << np.uint64(24)) | np.arange(len(at), dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < SPAN:
            least = np.minimum(least[: width - SPAN], least[SPAN - width :])
        out.append((least & np.uint64(0xFFFFFF)).astype(np.int64) + first)
    return np.concatenate(out)


@dataclass
class Segments:
    """Runs of windows that share an anchor: document (id and check value), start of the first window in the document,
    number of windows, bytes before the anchor, and where the bytes lie in `data`."""

    doc: np.ndarray
    check: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    at: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.doc)

    @property
    def size(self) -> np.ndarray:
        return self.windows + LENGTH - 1

    def take(self, which: np.ndarray) -> Segments:
        return Segments(*(getattr(self, f)[which] for f in ("doc", "check", "start", "windows", "anchor", "at")), self.data)

    def spans(self) -> np.ndarray:
        """doc, check, first byte and end of each run."""
        return np.stack([self.doc, self.check, self.start, self.start + self.size], axis=1)

    def order(self) -> np.ndarray:
        """The order by document and place; of rows that were given twice one is named."""
        by = np.lexsort((self.start, self.check, self.doc))
        fresh = np.ones(len(by), bool)
        for f in (self.doc[by], self.check[by], self.start[by]):
            fresh[1:] &= f[1:] == f[:-1]
        fresh[1:] = ~fresh[1:]
        return by[fresh]

    def keys(self, hashed: RunHash) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the segments' bytes, and of their anchors."""
        anchor = self.at + self.anchor
        return hashed.of(self.at, self.at + self.size), hashed.of(anchor, anchor + GRAM)

    def repeated(self, key: np.ndarray) -> np.ndarray:
        """Which segments have the same bytes, not only the same key, as an earlier one (of segments in order)."""
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        later = np.flatnonzero(first[inverse] != np.arange(len(key)))
        model = first[inverse[later]]
        same = self.size[later] == self.size[model]
        later, model = later[same], model[same]
        out = np.zeros(len(key), bool)
        for start in range(0, len(later), 8192):  # bounded memory
            one, two = later[start : start + 8192], model[start : start + 8192]
            size = self.size[one]
            alike = self.data[runs(self.at[one], size)] == self.data[runs(self.at[two], size)]
            out[one] = np.logical_and.reduceat(alike, np.cumsum(size) - size)
        return out

    def packed(self) -> Segments:
        """The same segments over their own bytes alone."""
        size = self.size
        raw = np.concatenate([np.zeros(0, np.uint8), *(self.data[runs(self.at[k : k + 4096], size[k : k + 4096])] for k in range(0, len(size), 4096))])
        return Segments(self.doc, self.check, self.start, self.windows, self.anchor, np.cumsum(size) - size, raw)


def joint(parts: list[Segments]) -> Segments:
    """Packed segments, one after the other."""
    fields = [np.concatenate([getattr(p, f) for p in parts]) for f in ("doc", "check", "start", "windows", "anchor")]
    size = fields[3] + LENGTH - 1
    return Segments(*fields, np.cumsum(size) - size, np.concatenate([p.data for p in parts]))


def segments(doc: np.ndarray, check: np.ndarray, data: np.ndarray, offsets: np.ndarray, hashed: RunHash) -> Segments:
    anchor = anchors(hashed, len(data))
    n = len(anchor)
    cut = np.zeros(n, bool)
    cut[offsets[offsets < n]] = True
    cut[1:] |= anchor[1:] != anchor[:-1]
    if n:
        cut[0] = True
    start = np.flatnonzero(cut)
    end = np.concatenate((start[1:], [n])) if n else start
    owner = np.searchsorted(offsets, start, "right") - 1
    end = np.minimum(end, offsets[owner + 1] - LENGTH + 1)  # windows lie within their document
    whole = np.flatnonzero(end > start)
    start, end, owner = start[whole], end[whole], owner[whole]
    return Segments(doc[owner], check[owner], start - offsets[owner], end - start, anchor[start] - start, start, data)


def blind_order(rows: list[bytes]) -> list[int]:
    """The order of strings of one length by a blind trie: inner nodes know a depth and one byte per child.

    A string is led down by those bytes only, compared once with the leaf it comes to, and put in where they part.
    """
    root: list | int = 0  # an inner node is [depth, {byte: child}], a leaf the number of its string
    equal: dict[int, list[int]] = {0: [0]}
    for i in range(1, len(rows)):
        s, node = rows[i], root
        while not isinstance(node, int):
            child = node[1].get(s[node[0]])
            node = next(iter(node[1].values())) if child is None else child
        other = rows[node]
        if s == other:
            equal[node].append(i)
            continue
        equal[i] = [i]
        part = len(s) - ((int.from_bytes(s, "big") ^ int.from_bytes(other, "big")).bit_length() + 7) // 8
        above, node = None, root
        while not isinstance(node, int) and node[0] < part:
            above, node = node, node[1][s[node[0]]]
        if not isinstance(node, int) and node[0] == part:
            node[1][s[part]] = i
        elif above is None:
            root = [part, {s[part]: i, other[part]: node}]
        else:
            above[1][s[above[0]]] = [part, {s[part]: i, other[part]: node}]
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, int):
            out += equal[node]
        else:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def deep_shallow(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of equally long byte strings (a matrix, its width a multiple of 8), and each one's common prefix with the next."""
    n, width = rows.shape
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order, group = np.arange(n), np.zeros(n, np.int64)
    for w in range(min(SHALLOW, width) // 8):
        by = np.lexsort((words[order, w], group))
        order, group = order[by], group[by]
        value = words[order, w]
        group = np.concatenate(([0], np.cumsum((group[1:] != group[:-1]) | (value[1:] != value[:-1]))))
    tail = words[:, SHALLOW // 8 :]
    differs = (group[1:] == group[:-1]) & (tail[order[1:]] != tail[order[:-1]]).any(axis=1)
    for g in np.unique(group[1:][differs]):
        a, b = np.searchsorted(group, [g, g + 1])
        inside = order[a:b]
        order[a:b] = inside[blind_order([r.tobytes() for r in rows[inside, SHALLOW:]])]
    equal = rows[order[1:]] == rows[order[:-1]]
    return order, np.where(equal.all(axis=1), width, equal.argmin(axis=1))


def _matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, back: bool) -> np.ndarray:
    """Row i: the bytes from starts[i] on (or, backwards, before it), then zeros."""
    step = np.arange(width)
    at = starts[:, None] + (-1 - step if back else step)[None, :]
    inside = step[None, :] < lengths[:, None]
    return np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint8)


def repeated_windows(s: Segments) -> np.ndarray:
    """doc, check, first byte and end of runs of windows that also start earlier; s: different segments in order.

    Two windows are equal if they agree before and after their common anchor. So the contexts after the anchors, and
    before them read backwards, are sorted; for each place of the anchor in the window, segments fall into classes of
    agreement on both sides, whose first member holds the earliest window.
    """
    n = len(s)
    after, after_common = deep_shallow(_matrix(s.data, s.at + s.anchor, s.size - s.anchor, -(-LENGTH // 8) * 8, False))
    before, before_common = deep_shallow(_matrix(s.data, s.at + s.anchor, s.anchor, -(-SPAN // 8) * 8, True))
    later = np.zeros((n, SPAN + 1), bool)  # the last column closes runs
    for place in range(SPAN):
        window = s.anchor - place
        valid = np.flatnonzero((window >= 0) & (window < s.windows))
        if len(valid) < 2:
            continue
        right, left = np.empty(n, np.int64), np.empty(n, np.int64)
        right[after] = np.concatenate(([0], np.cumsum(after_common < LENGTH - place)))
        left[before] = np.concatenate(([0], np.cumsum(before_common < place)))
        key = right[valid] * n + left[valid]
        _, first = np.unique(key, return_index=True)
        again = np.ones(len(valid), bool)
        again[first] = False
        again = valid[again]
        later[again, window[again]] = True
    edge = np.diff(later.astype(np.int8), axis=1, prepend=0)
    item, first = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return np.stack([s.doc[item], s.check[item], s.start[item] + first, s.start[item] + end - 1 + LENGTH], axis=1)


_BLOB = "bucket int, docs binary, checks binary, starts binary, windows binary, anchors binary, bytes binary"
_FIELDS = (("doc", "<i8"), ("check", "<u4"), ("start", "<i4"), ("windows", "u1"), ("anchor", "u1"))


def _sent(parts: list[tuple[Segments, np.ndarray, np.ndarray]], done: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """One row per bucket with the segments that are new among these; spans known to be repeats ride in a row beside."""
    s, key, anchor = joint([p[0] for p in parts]), *(np.concatenate([p[k] for p in parts]) for k in (1, 2))
    by = s.order()
    again = s.take(by).repeated(key[by])
    known = joined(np.concatenate([*done, s.take(by[again]).spans()]))
    by = by[~again]
    bucket = (anchor[by] % np.uint64(buckets)).astype(np.int64)
    by = by[np.argsort(bucket, kind="stable")]
    cuts = np.searchsorted(np.sort(bucket), np.arange(buckets + 1))
    press, rows = zstandard.ZstdCompressor(level=6), []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        p = s.take(by[cuts[b] : cuts[b + 1]])
        raw = p.data[runs(p.at, p.size)].tobytes()
        rows.append((b, *(getattr(p, f).astype(t).tobytes() for f, t in _FIELDS), press.compress(raw)))
    if len(known):
        wide = (known[:, k].astype(t).tobytes() for k, t in enumerate(("<i8", "<u4", "<i4", "<i4")))
        rows.append((int(known[0, 0]) % buckets, *wide, None, None))
    return _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * 6]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    names = [c.split()[0] for c in _BLOB.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


@dataclass
class Windows:
    """Single windows: document (id and check value), start in the document, and two hashes of all their bytes."""

    doc: np.ndarray
    check: np.ndarray
    start: np.ndarray
    one: np.ndarray
    two: np.ndarray

    def take(self, which: np.ndarray) -> Windows:
        return Windows(*(getattr(self, f)[which] for f in ("doc", "check", "start", "one", "two")))

    def settled(self) -> tuple[Windows, np.ndarray]:
        """The earliest window of each content, and the spans of the others; a window that was given twice is one."""
        w = self.take(np.lexsort((self.start, self.check, self.doc, self.two, self.one)))
        fresh = np.ones(len(w.doc), bool)
        fresh[1:] = (w.one[1:] != w.one[:-1]) | (w.two[1:] != w.two[:-1])
        model = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        later = (w.doc != w.doc[model]) | (w.check != w.check[model]) | (w.start != w.start[model])
        spans = np.stack([w.doc, w.check, w.start, w.start + LENGTH], axis=1)[later]
        return w.take(np.flatnonzero(fresh)), joined(spans)


def single_windows(s: Segments) -> Windows:
    """All windows of packed segments."""
    at = runs(s.at, s.windows)
    one, two = (RunHash(s.data, seed).of(at, at + LENGTH) for seed in (1, 2))
    return Windows(np.repeat(s.doc, s.windows), np.repeat(s.check, s.windows), runs(s.start, s.windows), one, two)


def _scattered(parts: list[Segments], buckets: int) -> pa.RecordBatch:
    """Windows of hot anchors, one row per bucket of their hashes: the earliest of each content among these, and the spans of the others."""
    w, known = single_windows(joint(parts)).settled()
    bucket = (w.one % np.uint64(buckets)).astype(np.int64)
    w = w.take(np.argsort(bucket, kind="stable"))
    cuts, rows = np.searchsorted(np.sort(bucket), np.arange(buckets + 1)), []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        p = w.take(np.arange(cuts[b], cuts[b + 1]))
        hashes = np.stack([p.one, p.two]).astype("<u8").tobytes()
        rows.append((b, *(x.astype(t).tobytes() for x, t in ((p.doc, "<i8"), (p.check, "<u4"), (p.start, "<i4"))), None, hashes, None))
    if len(known):
        wide = (known[:, k].astype(t).tobytes() for k, t in enumerate(("<i8", "<u4", "<i4", "<i4")))
        rows.append((int(known[0, 0]) % buckets, *wide, None, None))
    return _rows(rows)


def _gathered(rows: list[dict]) -> Windows:
    """The windows of several rows."""
    fields = [np.concatenate([np.frombuffer(r[c], t) for r in rows]).astype(np.int64) for c, t in (("docs", "<i8"), ("checks", "<u4"), ("starts", "<i4"))]
    return Windows(*fields, *np.concatenate([np.frombuffer(r["anchors"], "<u8").reshape(2, -1) for r in rows], axis=1))


def _received(row: dict) -> tuple[Segments, np.ndarray, np.ndarray]:
    """One row's segments, with the keys of their bytes and anchors."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["bytes"]), np.uint8)
    names = ("docs", "checks", "starts", "windows", "anchors")
    fields = [np.frombuffer(row[c], t).astype(np.int64) for c, (_, t) in zip(names, _FIELDS, strict=True)]
    size = fields[3] + LENGTH - 1
    s = Segments(*fields, np.cumsum(size) - size, data)
    return s, *s.keys(RunHash(data))


def _known(row: dict) -> np.ndarray:
    kinds = zip(("docs", "checks", "starts", "windows"), ("<i8", "<u4", "<i4", "<i4"), strict=True)
    return np.stack([np.frombuffer(row[c], t).astype(np.int64) for c, t in kinds], axis=1)


def joined(spans: np.ndarray) -> np.ndarray:
    """Spans of one document that touch or overlap as one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
    fresh = (spans[1:, :2] != spans[:-1, :2]).any(axis=1)
    number = np.concatenate(([0], np.cumsum(fresh)))
    reach = np.maximum.accumulate(spans[:, 3] + number * (1 << 32)) - number * (1 << 32)  # documents don't reach into the next
    new = np.concatenate(([True], fresh | (spans[1:, 2] > reach[:-1])))
    first = np.flatnonzero(new)
    out = spans[first].copy()
    out[:, 3] = np.maximum.reduceat(spans[:, 3], first)
    return out


def _keyed(part: pa.RecordBatch) -> tuple[Segments, np.ndarray, np.ndarray]:
    """Segments of a chunk of texts in order, and their keys and anchors."""
    data, offsets = joined_bytes(part.column("text"))
    hashed = RunHash(data)
    doc, check = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "check"))
    s = segments(doc, check, data, offsets, hashed)
    s = s.take(s.order())
    return s, *s.keys(hashed)


def hot_anchors(docs: DataFrame, limit: int, sampled: int) -> tuple[np.ndarray, int]:
    """Hashes of the anchors with more than `limit` different segments, and the number of their windows.

    Counted on the segments whose bytes' hash is 0 modulo `sampled`: all copies of a segment count once, wherever they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", CHUNK_BYTES):
            s, key, anchor = _keyed(part)
            some = np.flatnonzero((key >> np.uint64(8)) % np.uint64(sampled) == 0)
            columns = [pa.array(x[some].view(np.int64)) for x in (anchor, key)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(s.windows[some])], names=["anchor", "key", "windows"])

    different = mapped(docs, run, "anchor long, key long, windows long").distinct()
    groups = different.groupBy("anchor").agg(F.count("*").alias("n"), F.sum("windows").alias("windows"))
    found = groups.where(F.col("n") * sampled > limit).select("anchor", "windows").collect()  # at most all segments / limit
    return np.sort(np.array([r.anchor for r in found], np.int64).view(np.uint64)), sampled * sum(r.windows for r in found)


def repeats(docs: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """doc_id, check, first, end: byte spans of windows that also start earlier.

    Map: texts are cut into segments; those that repeat among the texts of one pack are settled at once, so that a
    passage of many documents is sent once per pack. Reduce: the segments of a bucket of anchors meet. Windows whose
    anchor is hot go by a 128-bit hash of their bytes instead, the earliest of each per pack, so that such an anchor's
    windows are spread over all buckets.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    most = PACK_WINDOWS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, done, held = [], [], 0
        single, windows = [], 0
        for part in slices(batches, "text", CHUNK_BYTES):
            s, key, anchor = _keyed(part)
            again = s.repeated(key)
            done.append(joined(s.take(np.flatnonzero(again)).spans()))
            apart = ~again & np.isin(anchor, shared.value)
            cold = ~again & ~apart
            total = np.cumsum(s.windows[apart])
            for some in np.split(np.flatnonzero(apart), np.searchsorted(total, np.arange(most, total[-1] if len(total) else 0, most))):
                single.append(s.take(some).packed())
                windows += int(s.windows[some].sum())
                if windows >= most:
                    yield _scattered(single, buckets)
                    single, windows = [], 0
            parts.append((s.take(np.flatnonzero(cold)).packed(), key[cold], anchor[cold]))
            held += len(parts[-1][0].data)
            if held >= PACK_BYTES:
                yield _sent(parts, done, buckets)
                parts, done, held = [], [], 0
        if single:
            yield _scattered(single, buckets)
        if parts:
            yield _sent(parts, done, buckets)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                if held and held[0]["bucket"] != row["bucket"]:
                    yield _settled(held)
                    held = []
                held.append(row)
        if held:
            yield _settled(held)

    blobs = mapped(docs, cut, _BLOB).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return mapped(blobs, meet, "doc_id long, check long, first int, end int")


def _settled(rows: list[dict]) -> pa.RecordBatch:
    found = [np.zeros((0, 4), np.int64), *(_known(r) for r in rows if r["windows"] is not None and r["bytes"] is None)]
    if single := [r for r in rows if r["windows"] is None]:
        found.append(_gathered(single).settled()[1])
    parts = [_received(r) for r in rows if r["bytes"] is not None]
    if parts:
        s, key, anchor = joint([p[0] for p in parts]), *(np.concatenate([p[k] for p in parts]) for k in (1, 2))
        del parts
        by = s.order()
        again = s.take(by).repeated(key[by])
        found.append(s.take(by[again]).spans())
        by = by[~again]
        _, inverse, count = np.unique(anchor[by], return_inverse=True, return_counts=True)
        by = by[count[inverse] > 1]
        if len(by):
            found.append(repeated_windows(s.take(by)))
    spans = joined(np.concatenate(found))
    return pa.RecordBatch.from_arrays(
        [pa.array(spans[:, k], t) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.int32()), (3, pa.int32()))],
        names=["doc_id", "check", "first", "end"],
    )


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, spans (first, end, in bytes): one row per row of docs, with the spans to remove.

    A byte is in a span if a string of LENGTH bytes that covers it also starts earlier: in a document of a smaller id, or
    before in its own. Strings are judged on the input and do not cross documents. A null or short text has no
    span. Of rows that share an id but not the text, the order is that of a check value of the text; rows equal in both
    are one document and get equal spans. A row without an id is not looked at and keeps its text. doc_id is a whole
    number; other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("check", F.crc32(F.encode("text", "UTF-8")))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    long = rows.where("doc_id is not null and octet_length(text) >= 100")
    hot, windows = hot_anchors(long, HOT_SEGMENTS, SAMPLED)
    buckets = max(1, ceil((size * (1 + 2 * LENGTH / SPAN) + windows * WINDOW_BYTES) / BUCKET_BYTES))
    spans = repeats(long, buckets, hot)
    spans = written(spans, "repeats").groupBy("doc_id", "check").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    return rows.join(spans, ["doc_id", "check"], "left").select("doc_id", "text", "spans")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, from removed()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            text = part.column("text")
            data, offsets = joined_bytes(text)
            spans = part.column("spans")
            flat, owner = spans.flatten(), np.repeat(np.arange(len(text)), np.nan_to_num(_list_sizes(spans)).astype(int))
            first, end = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) + offsets[owner] for k in (0, 1))
            n = len(data)
            gone = np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:n] > 0
            opens = gone & ~np.concatenate(([False], gone[:-1])) if n else gone
            begin = offsets[:-1][(offsets[:-1] < n) & (np.diff(offsets) > 0)]
            opens[begin] = gone[begin]
            sums, starts = (np.concatenate(([0], np.cumsum(x))) for x in (gone, opens))
            digest = [_sha256(data[a:b][~gone[a:b]]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [
                part.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array(sums[offsets[1:]] - sums[offsets[:-1]]),
                pa.array(starts[offsets[1:]] - starts[offsets[:-1]]),
                pa.array(digest, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return mapped(removed(docs), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _list_sizes(column: pa.Array) -> np.ndarray:
    return column.value_lengths().to_numpy(zero_copy_only=False)


def _sha256(data: np.ndarray) -> str:
    return hashlib.sha256(data.tobytes()).hexdigest()


SQL = """
WITH b AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM b),
windows AS (SELECT doc_id, p, md5_number(substring(h, CAST(2 * p + 1 AS BIGINT), 200)) AS s FROM starts),
later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1),
cut AS (
  SELECT doc_id, p, p > 100 + lag(p, 1, -1000) OVER (PARTITION BY doc_id ORDER BY p) AS opens FROM later),
numbered AS (SELECT doc_id, p, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM cut),
spans AS MATERIALIZED (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS z FROM numbered GROUP BY doc_id, run),
sums AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last FROM spans GROUP BY doc_id),
pieces AS (
  SELECT doc_id, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS after FROM spans),
heads AS (
  SELECT doc_id, string_agg(substring(h, CAST(2 * after + 1 AS BIGINT), CAST(2 * (a - after) AS BIGINT)), '' ORDER BY a) AS kept
  FROM pieces JOIN b USING (doc_id) GROUP BY doc_id)
SELECT b.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substring(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM b LEFT JOIN sums USING (doc_id) LEFT JOIN heads USING (doc_id)
"""
