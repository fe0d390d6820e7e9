"""Near-duplicates: MinHash signatures joined through inverted lists of coordinate values, links confirmed on whole sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RunHash, components, joined_bytes, mapped, mix, slices, written

#: Coordinates of a signature: the minima of so many hash functions over a set, so that sets of similarity s agree in
#: each with chance s. A linked pair agrees in fewer than the rule's `matches` of them with chance below MISS.
COORDINATES, MISS = 64, 1e-7
#: Bytes of text compared in one cell; a larger group is cut into blocks and every two blocks meet in a cell.
CELL_BYTES = 8 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Link documents whose sets of `words`-word shingles have 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80

    @property
    def matches(self) -> int:
        """Coordinates that a linked pair agrees in at least."""
        p, below = self.percent / 100, 0.0
        for k in range(COORDINATES):
            below += comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
            if below > MISS:
                return max(1, k)
        return COORDINATES

    @property
    def prefix(self) -> int:
        """Two sets with that many matches share one of so many coordinates, however these are ordered, if in one order."""
        return COORDINATES - self.matches + 1


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text as sorted 64-bit hashes, one after the other, and the n + 1 offsets.

    A-Z is lowered, words are runs without ASCII white space. A text of fewer words is one shingle, of all its
    words; one without words has none.
    """
    data, offsets = joined_bytes(texts)
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    n = len(texts)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    head = np.zeros(len(data) + 1, bool)  # a word may not run on into the next text
    head[offsets] = True
    start = ~blank & np.concatenate(([True], blank[:-1])) if len(data) else np.zeros(0, bool)
    start |= ~blank & head[:-1]
    starts = np.flatnonzero(start)
    stop = ~blank & (np.concatenate((blank[1:], [True])) | head[1:]) if len(data) else np.zeros(0, bool)
    word = RunHash(low).of(starts, np.flatnonzero(stop) + 1)
    bounds = np.searchsorted(starts, offsets)
    count = np.diff(bounds)
    size = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    sums = np.concatenate(([0], np.cumsum(size)))
    width = np.minimum(count, words)
    owner = np.repeat(np.arange(n), size)
    at = bounds[owner] + np.arange(sums[-1]) - sums[owner]
    hashes = np.zeros(sums[-1], np.uint64)
    for k in range(words):
        use = k < width[owner]
        hashes[use] = mix(hashes[use] * _STEP + word[at[use] + k])
    hashes = mix(hashes + width[owner].astype(np.uint64))
    out, ends = [], [0]
    for k in range(n):
        out.append(np.unique(hashes[sums[k] : sums[k + 1]]))
        ends.append(ends[-1] + len(out[-1]))
    return np.concatenate(out) if out else hashes, np.array(ends)


def minima(shingles: np.ndarray, n: int) -> np.ndarray:
    """The least value of each of n hash functions over a set, 32 bits each."""
    odd = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for start in range(0, len(shingles), 1 << 13):
        np.minimum(out, (shingles[None, start : start + (1 << 13)] * odd[:, None]).min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def described(docs: DataFrame, rule: Rule, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_bytes, n_shingles, set_id (128 bits, null for an empty set), signature (one value per coordinate)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 19):
            hashes, ends = shingle_sets(part.column("text"), rule.words)
            ids, values = [], []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                own = hashes[a:b]
                ids.append(set_id(own) if b > a else None)
                values.append(minima(own, COORDINATES).view(np.int32) if b > a else np.zeros(0, np.int32))
            columns = [
                part.column("doc_id"),
                pa.array(np.diff(joined_bytes(part.column("text"))[1])),
                pa.array(np.diff(ends)),
                pa.array(ids, pa.string()),
                pa.array(values, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_shingles", "set_id", "signature"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return mapped(rows, run, f"doc_id {kind}, n_bytes long, n_shingles long, set_id string, signature array<int>")


def set_id(shingles: np.ndarray) -> str:
    """Equal for equal sets: two independent sums over the members."""
    return f"{int(mix(shingles + _STEP).sum()):016x}{int(mix(shingles ^ _STEP).sum() & np.uint64(0xFFFFFFFFFFFFFFFF)):016x}{len(shingles):x}"


def groups(described_docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_bytes, root, of one document per distinct set that may be linked with another.

    Every document is posted under each of its coordinate-value pairs, and a list's length is counted. Prefix: sorted by
    these lengths, the shortest list first, two documents with enough matches share one of their first `prefix` lists.
    Most documents have as many values of their own, and drop out here; long lists, as of a common line, come last and
    mostly play no part. Of each remaining list only its least member is the partner of all others, so a list of n makes
    n - 1 rows, however long it is. Groups are the components of these rows.
    """
    reps = described_docs.where("set_id is not null and doc_id is not null").groupBy("set_id")
    reps = reps.agg(F.min_by(F.struct("doc_id", "n_bytes", "signature"), "doc_id").alias("d")).select("d.*")
    reps = written(reps.withColumn("rep", F.monotonically_increasing_id()), "sets")
    pair = F.shiftleft(F.col("k").cast("long"), 32) + F.col("value").cast("long")
    posts = reps.select("rep", F.posexplode("signature").alias("k", "value")).select("rep", pair.alias("post"))
    # Lists are tables of their own, so that Spark can split a join with a very long one, and are joined alike at every size.
    length = written(posts.groupBy("post").agg(F.count("*").alias("n")).where("n > 1"), "lengths")
    shared = posts.join(length.hint("merge"), "post").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "post"))).alias("lists"))
    use = F.greatest(F.lit(0), F.size("lists") - (COORDINATES - rule.prefix))
    first = written(shared.select("rep", F.explode(F.slice("lists", 1, use)).alias("list")).select("rep", "list.post"), "prefixes")
    lists = first.groupBy("post").agg(F.min("rep").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = first.join(written(lists, "lists").hint("merge"), "post").where("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b"))
    return components(pairs).withColumnRenamed("node", "rep").join(reps.drop("signature"), "rep").select("doc_id", "n_bytes", "root")


class Lists:
    """Inverted lists of a cell's signatures: of each set its `prefix` coordinate values with the shortest lists."""

    def __init__(self, signatures: np.ndarray, prefix: int):
        n, m = signatures.shape
        pairs = (np.arange(m, dtype=np.uint64) << np.uint64(32))[None, :] + signatures
        _, code, length = np.unique(pairs.ravel(), return_inverse=True, return_counts=True)
        code = code.reshape(n, m)
        order = np.argsort(length[code] * (code.max(initial=0) + 1) + code, axis=1)[:, :prefix]
        self.of = np.take_along_axis(code, order, axis=1)
        member = np.argsort(self.of.ravel(), kind="stable")
        ends = np.cumsum(np.bincount(self.of.ravel(), minlength=len(length)))
        self.members = {c: part // self.of.shape[1] for c, part in enumerate(np.split(member, ends[:-1])) if len(part) > 1}

    def merged(self, p: int, open_: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Open sets from lo up to hi in any list of p. Lists skip what lies outside, and drop what is not open any more."""
        found = []
        for c in self.of[p].tolist():
            if (part := self.members.get(c)) is not None:
                part = part[open_[part]]
                if len(part):
                    self.members[c] = part
                    found.append(part[np.searchsorted(part, lo, "left") : np.searchsorted(part, hi, "left")])
                else:
                    del self.members[c]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def linked_sets(hashes: np.ndarray, ends: np.ndarray, rule: Rule, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets: every two linked sets are joined by a chain of the pairs returned.

    Breadth first: a set's lists are merged, which names the sets that no chain has reached yet and that sizes allow; the
    coordinates in which they collide with it are counted, and with `matches` of them the two are compared in full. A
    set that is reached leaves all lists, so a group of near copies costs its length. With `side`, only pairs of
    different sides are compared.
    """
    size = np.diff(ends)
    order = np.argsort(size, kind="stable")  # sets are numbered by size, so that a range of sizes is a range of numbers
    size = size[order]
    signature = np.array([minima(hashes[ends[k] : ends[k + 1]], COORDINATES) for k in order]).reshape(len(order), COORDINATES)
    lists, open_, out = Lists(signature, rule.prefix), np.ones(len(order), bool), []
    for root in range(len(order)):
        if not open_[root]:
            continue
        open_[root] = False
        queue = [root]
        while queue:
            p = queue.pop()
            lo = np.searchsorted(size, ceil(size[p] * rule.percent / 100), "left")
            hi = np.searchsorted(size, size[p] * 100 // rule.percent, "right")
            near = lists.merged(p, open_, lo, hi)
            if side is not None:
                near = near[side[order[near]] != side[order[p]]]
            near = near[(signature[near] == signature[p]).sum(axis=1) >= rule.matches]
            mine = hashes[ends[order[p]] : ends[order[p] + 1]]
            for q in near.tolist():
                other = hashes[ends[order[q]] : ends[order[q] + 1]]
                at = np.minimum(np.searchsorted(other, mine), len(other) - 1)
                both = int(np.count_nonzero(other[at] == mine))
                if 100 * both >= rule.percent * (len(mine) + len(other) - both):
                    open_[q] = False
                    queue.append(q)
                    out.append((int(order[p]), int(order[q])))
    return out


def links(docs: DataFrame, rule: Rule, described_docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """a, b: ids of linked documents, enough of them that every component hangs together.

    Each group's whole texts meet in one task, sorted by cell. A group above CELL_BYTES is cut into blocks, and each two
    blocks meet in a cell of their own, so that no task holds more than two blocks and no pair is left out.
    """
    member = written(groups(described_docs, rule), "members")
    large = member.groupBy("root").agg(F.ceil(F.sum("n_bytes") / CELL_BYTES).alias("blocks"))
    member = member.join(large, "root").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    others = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.struct(F.least(F.col("block").cast("long"), other).alias("x"), F.greatest(F.col("block").cast("long"), other).alias("y")),
    )
    member = written(member.select("doc_id", "n_bytes", "root", "block", others.alias("cells")), "groups")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    # Texts are moved by the same join at every size: a broadcast of the members would only hold for small tables.
    cells = rows.join(member.hint("merge"), "doc_id").select("doc_id", "text", "root", "block", F.explode("cells").alias("cell"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for part in slices(batches, "text"):
            keys = list(zip(*(part.column(c).to_pylist() for c in ("root", "x", "y")), strict=True))
            start = 0
            while start < len(keys):
                stop = start
                while stop < len(keys) and keys[stop] == keys[start]:
                    stop += 1
                if held and keys[start] != key:
                    yield _cell(held, key, rule)
                    held = []
                key = keys[start]
                held.append(part.slice(start, stop - start))
                start = stop
        if held:
            yield _cell(held, key, rule)

    cells = cells.select("root", "cell.x", "cell.y", "block", "doc_id", "text")
    parts = max(1, ceil((member.agg(F.sum(F.col("n_bytes") * F.size("cells"))).first()[0] or 0) / CELL_BYTES))
    cells = cells.repartition(parts, "root", "x", "y").sortWithinPartitions("root", "x", "y")
    return mapped(cells, run, f"a {kind}, b {kind}")


def _cell(held: list[pa.RecordBatch], key: tuple, rule: Rule) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    sets = [shingle_sets(b.column("text"), rule.words) for b in slices(table.to_batches(), "text", 1 << 19)]
    hashes = np.concatenate([h for h, _ in sets])
    size = np.concatenate([np.diff(e) for _, e in sets])
    ends = np.concatenate(([0], np.cumsum(size)))
    side = np.array(table.column("block").to_pylist()) if key[1] != key[2] else None
    ids = table.column("doc_id")
    pairs = linked_sets(hashes, ends, rule, side) if len(ids) > 1 else []
    a, b = ([ids[p[k]] for p in pairs] for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in c], ids.type) for c in (a, b)], names=["a", "b"])


def clusters(docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs.

    component_id is the smallest id that links reach, the row's own included; kept says that it is the row's own. Rows
    with equal sets are linked without being compared. A null text, or one without words, has no set and is linked
    with nothing. A row without an id keeps its set's size, has no component and is kept. Rows that share an id are each
    linked by their own text, links of either text counting for both. Other columns are not looked at.
    """
    every = written(described(docs, rule, doc_id, text), "described")
    same = every.where("set_id is not null and doc_id is not null")
    least = same.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    found = components(written(links(docs, rule, every, doc_id, text), "links"))
    class_of = least.join(found.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "set_id", F.coalesce("root", "rep").alias("component_id")
    )
    out = every.join(class_of, "set_id", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL = rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT DISTINCT x AS a, x AS b FROM edges UNION SELECT a, y FROM reach JOIN edges ON b = x),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
  coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least ON w.doc_id = a
"""
