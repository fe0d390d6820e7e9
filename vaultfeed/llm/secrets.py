"""Secret scans: base patterns, and name-literal pairs read from source and configuration syntax."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices

KINDS = ("assign", "access", "hex", "literal")
#: A literal is reported from this score on: name weight times how much the literal looks like a secret.
THRESHOLD = 0.5

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # a shorter run ends where the base pattern's match ends, so none is lost
_HEX = re.compile(r"[0-9a-f]{32,}")

#: name, operator, and where the value begins: on this line, in brackets, or as a string on the next line. Names may be
#: quoted keys or attribute and index paths.
_PAIR = re.compile(
    r"""(?<![\w.$-])([A-Za-z_$][\w.$-]*+)["'\]]*+[ \t]*+(?::=|=>|=(?![=>])|:(?![:/]))"""
    r"""(?:[ \t]*+\\?+\r?+\n[ \t]*+(?=["'`])|[ \t]*+(?:(\()\s*+(?=[A-Za-z]{0,2}["'`]))?+(?=[\w"'`$+/.-]))"""
)
_ATOM = re.compile(
    r"""(?:[&*]|\[\w*\])*+(?:'\w++[ \t]++)?+(?:(?:mut|const|readonly|dyn)[ \t]++)?+(?:[A-Za-z_][\w.]*+(?:::\w++)*+|(?<=\]))"""
)
#: What stands before a type: `name:`, Go's `var name`; and `name string =` in a group or `name As type =`, with the type.
_TYPED = re.compile(
    r"""(?<![\w.$-])(?:(?:var|const)[ \t]++([A-Za-z_]\w*+)[ \t]++(?=[&*\[\w])"""
    r"""|([A-Za-z_]\w*+)[ \t]++(?:[*]?string|\[\w*\](?:byte|rune|string)|[Aa]s[ \t]++\w++)(?=[ \t]*+=)"""
    r"""|([A-Za-z_$][\w.$-]*+)["'\]]*+[?!]?+[ \t]*+:(?![:=/])[ \t]*+(?=[&*\[\w]))"""
)
_JOINT = re.compile(r"[?!*]?+[ \t]*+[|&][ \t]*+")
_EQUALS = re.compile(r"""[?!*]?+[ \t]*+=(?![=>])[ \t]*+(?=[\w"'`$+/.-])""")
_BRACKET = re.compile(r'[<>\[\]\n;"=]')
_STRING = re.compile(
    r'''[fFrRbBuU]{0,2}+(?:"{3}((?:[^"\\]|\\.|"(?!""))*+)"{3}|'{3}((?:[^'\\]|\\.|'(?!''))*+)'{3}'''
    r'''|"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`((?:[^`\\]|\\.)*+)`)''',
    re.S,
)
_BARE = re.compile(r"[A-Za-z0-9+/_.=$-]++")
_PLUS = re.compile(r"\s*+\+\s*+(?=[\w\"'`$])")
_BESIDE = re.compile(r"\s*+(?=[A-Za-z]{0,2}[\"'`])")
#: Calls that give a name and its value: `define("name", ...)`, `put("name", ...)` and the like, and `setName(...)`.
_CALL = re.compile(
    r"""(?<![\w$])(?:(?:define|putenv|setenv|getenv|env|put|add|append|insert|header|set|get)\w*+[ \t]*+\(\s*+["']([^"'\n]*+)["']\s*+,\s*+"""
    r"""|[sS]et_?+([A-Za-z]\w*+)[ \t]*+\(\s*+)(?=[A-Za-z]{0,2}["'`])"""
)
#: An element with a text, and neighbouring attributes that give a name and its value.
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*+)(?:\s[^<>]*+)?+>\s*+([^<>\s][^<>]*+)</")
_ATTRIBUTES = re.compile(r"""(?<![\w-])(?:key|name|id)[ \t]*+=[ \t]*+["']([^"'\n<>]*+)["']\s++value[ \t]*+=[ \t]*+["']([^"'\n<>]*+)["']""", re.I)
#: The head of a block scalar; its lines follow, deeper than the head.
_BLOCK = re.compile(r"""^([ \t]*+(?:-[ \t]++)*+)["']?+([A-Za-z_][\w.-]*+)["']?+[ \t]*+:[ \t]*+[|>][-+0-9]*+[ \t]*+\r?+\n""", re.M)
_LINE = re.compile(r"([ \t]*+)([^\r\n]*+)(?:\r?+\n|\Z|\r)")
_NAME = re.compile(r"[A-Za-z_$][\w.$]*+\Z")
#: How sensitive a name is, by the first word of it that is found; fixed values.
_SENSITIVE = (
    (re.compile(r"pass(?:word|wd|phrase)|(?<![a-z])pwd(?![a-z])", re.I), 1.0),
    (re.compile(r"secret|private[_-]?key|credential", re.I), 1.0),
    (re.compile(r"api[_-]?key|access[_-]?key|auth[_-]?token|bearer", re.I), 0.9),
    (re.compile(r"token|encryption[_-]?key|signing[_-]?key", re.I), 0.8),
)
#: Stems, one of which is in every base keyword and every sensitive name; a text without them has neither.
_STEMS = (b"pass", b"pwd", b"secret", b"private", b"credential", b"api", b"access", b"auth", b"bearer", b"token", b"encryption", b"signing")
_DUMMY = re.compile(r"(?:change|replace|insert|your|example|sample|dummy|placeholder|todo|none|null|true|false|xxx|\*\*\*|<|\$\{)", re.I)


def name_weight(name: str) -> float:
    return max((w for pattern, w in _SENSITIVE if pattern.search(name)), default=0.0)


class Value:
    """A value put together from literals and earlier values; of its text only what its weight needs is kept.

    Values refer to each other instead of being copied: a text in which each line doubles a value, or a chain of
    additions, takes time and memory in proportion to its length. `best` is the highest score of a name that holds it.
    """

    __slots__ = ("length", "head", "kinds", "shares", "places", "parts", "best")

    def __init__(self):
        self.length, self.head, self.kinds = 0.0, "", 0
        self.shares: dict[str, float] = {}  # of each character; beyond ASCII, of characters in 256 bins
        self.places: list[tuple[int, int]] = []
        self.parts: list[Value] = []
        self.best = 0.0

    def add(self, text: str, place: tuple[int, int]) -> None:
        self.places.append(place)
        counts: Counter = Counter()
        for c, n in Counter(text).items():
            counts[c if c < "\x80" else chr(128 + ord(c) % 256)] += n
        kinds = sum(1 << k for k, p in enumerate(_KINDS) if p.search(text))
        self._grow(float(len(text)), text[:16], kinds, {c: n / len(text) for c, n in counts.items()})

    def refer(self, other: Value) -> None:
        self.parts.append(other)
        self._grow(other.length, other.head, other.kinds, other.shares)

    def _grow(self, length: float, head: str, kinds: int, shares: dict[str, float]) -> None:
        if not length:
            return
        total = self.length + length
        old, new = self.length / total, length / total
        if not self.shares:
            self.shares = dict(shares)
        else:
            for c in self.shares:
                self.shares[c] *= old
            for c, share in shares.items():
                self.shares[c] = self.shares.get(c, 0.0) + share * new
        self.length, self.head, self.kinds = min(total, 1e15), (self.head + head)[:16], self.kinds | kinds

    def weight(self, name: float = 0.0) -> float:
        """0 for short, dummy or plain-word values; up to 1 with length, mixed characters and entropy.

        For a name of weight 1 a phrase or a value of one kind of characters counts by length and entropy, too.
        """
        if self.length < 8 or _DUMMY.match(self.head):
            return 0.0
        entropy = -sum(p * math.log2(p) for p in self.shares.values() if p > 0)
        if " " in self.shares or self.kinds.bit_count() < 2:
            return min(1.0, self.length / 12) * min(1.0, entropy / 4.0) if name >= 1.0 else 0.0
        return min(1.0, entropy / 3.0)


_KINDS = tuple(map(re.compile, ("[a-z]", "[A-Z]", "[0-9]", r"[^\w]")))


def _value(text: str, at: int, constants: dict[str, Value], bracket: bool = False) -> tuple[Value, int]:
    """The value at a place, and where it ends. In brackets, strings that stand beside each other are one value."""
    value = Value()
    while True:
        if s := _STRING.match(text, at):
            value.add(s[s.lastindex], s.span(s.lastindex))
        elif s := _BARE.match(text, at):
            known = constants.get(s[0].lstrip("$")) if _NAME.match(s[0]) else None
            if known:
                value.refer(known)
            else:
                value.add(s[0], s.span())
        else:
            break
        at = s.end()
        if more := _PLUS.match(text, at) or (bracket and _BESIDE.match(text, at)):
            at = more.end()
        else:
            break
    return value, at


def _scalar(text: str, head: re.Match) -> Value:
    """The lines of a block scalar, each a literal of one value."""
    value, at, indent = Value(), head.end(), None
    while at < len(text) and (line := _LINE.match(text, at)):
        if line[2]:
            if len(line[1]) <= len(head[1]) or (indent is not None and len(line[1]) < indent):
                break
            indent = len(line[1]) if indent is None else indent
            value.add(line[2].rstrip(), (line.start(2), line.start(2) + len(line[2].rstrip())))
        at = max(line.end(), at + 1)
    return value


def _closing(text: str) -> dict[int, int]:
    """Of every < and [ the place behind its match; no pair goes on over the end of a line, a string or an assignment."""
    ends: dict[int, int] = {}
    open_: dict[str, list[int]] = {"<": [], "[": []}
    for m in _BRACKET.finditer(text):
        c = m[0]
        if c in open_:
            open_[c].append(m.start())
        elif c in "]>":
            if stack := open_["[" if c == "]" else "<"]:
                ends[stack.pop()] = m.end()
        else:
            open_ = {"<": [], "[": []}
    return ends


def _typed(text: str) -> Iterator[tuple[int, str, int]]:
    """Start, name and the place of the value of declarations with a type, whose arguments may be of any length."""
    ends, at = None, 0
    while head := _TYPED.search(text, at):
        at = head.end()
        if head[2] is None:
            while atom := _ATOM.match(text, at):
                at = atom.end()
                if text[at : at + 1] in ("<", "["):
                    ends = _closing(text) if ends is None else ends
                    while (end := ends.get(at)) is not None:
                        at = end
                if not (joint := _JOINT.match(text, at)):
                    break
                at = joint.end()
        if equals := _EQUALS.match(text, at):
            yield head.start(), head[head.lastindex], equals.end()
        at = max(at, head.end()) if equals else head.end()


def _besides(text: str) -> list[tuple[int, str, re.Match | int, re.Pattern]]:
    """Names that get a value otherwise than by an operator next to them, in text order."""
    found = [(start, name, value, _TYPED) for start, name, value in _typed(text)]
    for pattern in (_CALL, _ELEMENT, _ATTRIBUTES, _BLOCK):
        for m in pattern.finditer(text):
            name = m[2] if pattern is _BLOCK else m[1] if pattern in (_ELEMENT, _ATTRIBUTES) else m[m.lastindex]
            found.append((m.start(), name, m, pattern))
    return sorted(found, key=lambda f: f[0])


def pairs(text: str) -> Iterator[tuple[str, Value]]:
    """Names and their values, constants propagated in text order.

    A value is a string, a bare word or a chain of them with `+`; a bare word that names an earlier constant stands for
    that constant's value. Read are assignments and entries (a value may stand on the next line or in brackets), typed
    declarations, calls that set a name, elements and attributes of markup, and block scalars. A name with a type
    annotation has what stands after its `=`, and the annotation besides, as that may be a value.
    """
    constants: dict[str, Value] = {}
    others = iter(_besides(text))
    m, other = _PAIR.search(text), next(others, None)
    while m or other:
        if m is None or (other and other[0] < m.start()):
            _, name, found, pattern = other
            if pattern is _BLOCK:
                value = _scalar(text, found)
            elif pattern in (_ELEMENT, _ATTRIBUTES):
                value = Value()
                if inner := found[2].rstrip():
                    value.add(inner, (found.start(2), found.start(2) + len(inner)))
            else:
                value, _ = _value(text, found if pattern is _TYPED else found.end(), constants)
            other = next(others, None)
        else:
            name, (value, at) = m[1], _value(text, m.end(), constants, m[2] is not None)
            at = max(at, m.end())
            if value.places and (last := value.places[-1][0]) >= m.end() and _PAIR.match(text, last):
                at = last  # the value is itself the name of a pair
            m = _PAIR.search(text, at)
        if value.places or value.parts:
            constants[name] = value
            yield name, value


def literals(text: str) -> dict[tuple[int, int], float]:
    """Place and score of every literal that a sensitive name gets, directly or through constants."""
    values, scores = [], {}
    for name, value in pairs(text):
        values.append(value)
        if (weight := name_weight(name)) and (score := weight * value.weight(weight)) >= THRESHOLD:
            value.best = max(value.best, score)
    for value in reversed(values):  # a value stands before those that refer to it
        if value.best:
            for part in value.parts:
                part.best = max(part.best, value.best)
            for place in (p for p in value.places if p[0] < p[1]):
                scores[place] = max(value.best, scores.get(place, 0.0))
    return scores


def _joined(spans_: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans by start, without those that another one covers whole; so their ends rise, too."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans_, key=lambda s: (s[0], -s[1])):
        if not out or end > out[-1][1]:
            out.append((start, end))
    return out


def _covered(place: tuple[int, int], base: list[tuple[int, int]]) -> bool:
    at = bisect_right(base, (place[0], math.inf)) - 1
    return at >= 0 and place[1] <= base[at][1]


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and score of every finding, by start and then kind; code points, end exclusive.

    The base patterns come first: leftmost, not overlapping, each kind by itself. A literal that a sensitive name
    gets is added unless a base finding covers it whole.
    """
    if not text:
        return []
    low = text.encode().lower()
    named = any(stem in low for stem in _STEMS)
    found = [("assign", *m.span(), 1.0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8] if named else []
    found += [("access", *m.span(), 1.0) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span(), 1.0) for m in _HEX.finditer(text)]
    if named:
        scores = literals(text)
        base = _joined([f[1:3] for f in found])
        found += [("literal", *p, s) for p, s in scores.items() if not _covered(p, base)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans (kind, start, end, score): one row per row of docs, whose other columns are not looked at.

    A null or empty text has no spans; rows with equal or null ids are scanned one by one.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans(t)] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return mapped(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, spans array<struct<kind string, start bigint, end bigint, score double>>"
    )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text) per document, from scan()."""

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))

    base = F.filter("spans", lambda s: s.kind != "literal")
    return scan(docs).select(
        "doc_id", *map(count, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count("literal")
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows of docs with their columns; every finding is replaced by the mark, overlapping ones by one mark.

    A null or empty text stays as it is, repeated rows are each redacted, and other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            texts = [_marked(t, mark) for t in part.column(text).to_pylist()]
            where = part.schema.get_field_index(text)
            columns = list(part.columns)
            columns[where] = pa.array(texts, part.schema.field(where).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return mapped(docs, run, docs.schema)


def _marked(text: str | None, mark: str) -> str | None:
    out, done = [], 0
    for _, start, end, _ in spans(text):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text
