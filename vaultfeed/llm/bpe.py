"""Byte-level BPE: a minimal perfect hash for pre-tokens in the vocabulary, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import heapq
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RunHash, mapped, mix, slices

#: Bytes of remembered pre-tokens and ids of one generation, and what an entry takes besides its own bytes.
MEMO_BYTES, ENTRY_BYTES = 40 << 20, 160
#: White space as the rank files' library knows it (Unicode White_Space); `\s` of other libraries has a few more.
SPACE = r"\t-\r \x85\xa0  -     　"


@dataclass
class Vocabulary:
    """Tokens by id, and a perfect hash: bucket -> displacement, slot -> id. 50,000 tokens are about 2 MB."""

    tokens: list[bytes]
    shifts: np.ndarray
    slots: np.ndarray
    pattern: str
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        """Reads a file of base64 token and rank, on the driver; the vocabulary is broadcast, the file is not copied."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        return cls.of(ranks, pattern)

    @classmethod
    def of(cls, ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        keys = list(ranks)
        shifts, slots = _perfect(_hashes(keys), np.array([ranks[k] for k in keys], np.int64))
        return cls(tokens, shifts, slots, pattern)

    def find(self, pieces: list[bytes]) -> list[int]:
        """The id of each piece, or -1. Every piece lands on one slot, whose token is compared byte by byte."""
        if not pieces or not len(self.slots):
            return [-1] * len(pieces)
        at = self.slots[_slot(_hashes(pieces), self.shifts, len(self.slots))].tolist()
        tokens = self.tokens
        return [i if tokens[i] == p else -1 for i, p in zip(at, pieces, strict=True)]


def _hashes(pieces: list[bytes]) -> np.ndarray:
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    return RunHash(np.frombuffer(b"".join(pieces), np.uint8)).of(np.concatenate(([0], ends[:-1])).astype(np.int64), ends)


def _slot(hashes: np.ndarray, shifts: np.ndarray, n: int) -> np.ndarray:
    moved = mix(hashes + shifts[(hashes >> np.uint64(32)) % np.uint64(len(shifts))] * np.uint64(0xA0761D6478BD642F))
    return (moved % np.uint64(n)).astype(np.int64)


def _perfect(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and displace: the largest buckets first, each takes the first displacement that hits only free slots.

    n keys fill n slots, so the hash is minimal.
    """
    n = len(hashes)
    shifts, slots, taken = np.zeros(max(1, n // 3), np.uint64), np.zeros(n, np.int64), np.zeros(n, bool)
    if len(np.unique(hashes)) != n:
        raise ValueError("two tokens share a hash")
    bucket = ((hashes >> np.uint64(32)) % np.uint64(len(shifts))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    tries = np.arange(256, dtype=np.uint64)
    for keys in sorted(np.split(order, cuts), key=len, reverse=True) if n else ():
        base = np.uint64(0)
        while True:
            moved = mix(hashes[keys][None, :] + (tries + base)[:, None] * np.uint64(0xA0761D6478BD642F))
            at = (moved % np.uint64(n)).astype(np.int64)
            free = ~taken[at].any(axis=1)
            if len(keys) > 1:
                row = np.sort(at, axis=1)
                free &= (row[:, 1:] != row[:, :-1]).all(axis=1)
            hit = np.flatnonzero(free)
            if len(hit):
                shifts[bucket[keys[0]]] = tries[hit[0]] + base
                slots[at[hit[0]]], taken[at[hit[0]]] = ids[keys], True
                break
            base += np.uint64(len(tries))
    return shifts, slots


def merge(piece: bytes, ranks: dict[bytes, int], two: list[int]) -> list[int]:
    """The ids of a piece: always the pair of the lowest rank, the leftmost first, is merged.

    Bytes are a linked list (`after` of a token is its end; -1 once it is merged into its left neighbour); a heap
    holds rank, start and end of neighbouring pairs as one integer, and stale entries are skipped.
    """
    n, get = len(piece), ranks.get
    bits = n.bit_length()
    mask = (1 << bits) - 1
    after, before = list(range(1, n + 1)), list(range(-1, n))
    pairs = enumerate(zip(piece, piece[1:], strict=False))
    heap = [(r << bits | i) << bits | i + 2 for i, (a, b) in pairs if (r := two[a << 8 | b]) >= 0]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        entry = pop(heap)
        i, stop = entry >> bits & mask, entry & mask
        j = after[i]
        if j < 0 or j >= n or after[j] != stop:
            continue
        after[i], after[j] = stop, -1
        if stop < n:
            before[stop] = i
            k = after[stop]
            if (r := get(piece[i:k])) is not None:
                push(heap, (r << bits | i) << bits | k)
        if (h := before[i]) >= 0 and (r := get(piece[h:stop])) is not None:
            push(heap, (r << bits | h) << bits | stop)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Encoder:
    """Encodes texts in one Python worker; remembers twice MEMO_BYTES of pre-tokens, the last used ones, beside those of one text."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ranks = {t: i for i, t in enumerate(vocabulary.tokens) if t}
        known = vocabulary.pattern == KNOWN
        self.split = split if known else regex.compile(explicit(vocabulary.pattern)).findall
        two = [self.ranks.get(bytes(p), -1) for p in np.ndindex(256, 256)]
        self.merge = partial(merge, ranks=self.ranks, two=two)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text, all of them in the memo."""
        found = self.split(text)
        new = set(found).difference(self.memo)
        if new:
            if self.held > MEMO_BYTES:
                self.memo, self.older, self.held = {}, self.memo, 0
                new = set(found)
            memo, older = self.memo, self.older
            memo.update((p, older[p]) for p in new if p in older)
            miss = [p for p in new if p not in memo]
            raw = [p.encode() for p in miss]
            for p, b, i in zip(miss, raw, self.vocabulary.find(raw), strict=True):
                ids = (i,) if i >= 0 else self.merge(b)
                memo[p] = struct.pack(f"<{len(ids)}I", *ids)
            self.held += sum(ENTRY_BYTES + len(p) + len(memo[p]) for p in new)
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        found = self.pieces(text)
        return b"".join(map(self.memo.__getitem__, found))


#: The pattern of the public rank files; split() cuts by its rules without a regular expression.
KNOWN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def explicit(pattern: str) -> str:
    r"""The pattern with \s and \S as the explicit Unicode White_Space."""
    inside = regex.sub(r"\[[^\]]*\]", lambda m: m[0].replace(r"\s", SPACE), pattern)
    return inside.replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point: 0 other, 1 letter, 2 number, 3 white space."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, members in ((1, r"\p{L}"), (2, r"\p{N}"), (3, f"[{SPACE}]")):
        for m in regex.findall(f"{members}+", every):
            out[ord(m[0]) : ord(m[-1]) + 1] = kind
    out[0xD800:0xE000] = 0
    return out


def split(text: str) -> list[str]:
    """The matches of KNOWN, which cover the whole text: a token starts where the kind changes.

    The last character of a run of white space is the next token's if it is a space, else a token of its own;
    a quotation mark that starts a token takes a contraction's letters with it.
    """
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kind = _kinds()[points]
    n = len(points)
    start = np.empty(n + 1, bool)
    start[0] = start[n] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:n])
    last = np.flatnonzero((kind[:-1] == 3) & (kind[1:] != 3))
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    for i in np.flatnonzero(points == 39).tolist():
        if start[i] and (m := _short(text, i)):
            start[i + 1 : m.end()] = False
            start[m.end()] = True
    cuts = np.flatnonzero(start).tolist()
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


_short = re.compile("'(?:[stmd]|re|ve|ll)").match


_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per Python worker and vocabulary; a new vocabulary takes the place of the old one."""
    if vocabulary.key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary.key] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.key]


def encode(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit): every row's text encoded, one row out per row in.

    A null or empty text has empty ids. Rows with equal or null doc_id are each encoded; other columns are not
    looked at. Special tokens are ordinary text. Lone pre-tokens of any length are merged whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value)
        for part in slices(batches, "text"):
            ids = [encoder.encode(t) if t else b"" for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return mapped(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids binary")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids, bytes: the bytes that the packed ids stand for; an id outside the vocabulary is an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value.tokens
        for part in slices(batches, "ids"):
            raw = [
                b"".join(map(tokens.__getitem__, np.frombuffer(x, "<u4").tolist())) if x else b""
                for x in part.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=["doc_id", "ids", "bytes"])

    rows = encoded.select("doc_id", "ids")
    return mapped(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids binary, bytes binary")


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, from encode() and decode()."""
    return decode(encode(docs, vocabulary), vocabulary).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
