"""Merkle manifest of a table: built levels are stored as linked node rows, and a recursive query climbs them per leaf."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, numbered, written

#: A stored row climbs so many binary levels; a block is what hangs under one row.
LEVELS = 8
BLOCK = 1 << LEVELS
_NODE = "tree string, pos long, n long, hash binary, {kept}, block long, top binary, steps array<struct<left: binary, right: binary>>"


def _hash(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def block_levels(leaves: list[bytes], depth: int) -> list[list[bytes]]:
    """The levels above neighbouring nodes, `depth` of them; the last node of an odd level is hashed alone."""
    levels = [leaves]
    for _ in range(depth):
        below = levels[-1]
        levels.append([_hash(*below[k : k + 2]) for k in range(0, len(below), 2)])
    return levels


def _climbed(kept: list[str]):
    """For rows of whole blocks: every node with its block's top and the siblings on the way there."""
    side = pa.struct([("left", pa.binary()), ("right", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                tree, block, n = (row.column(c)[0].as_py() for c in ("tree", "block", "n"))
                nodes = row.column("nodes").flatten()
                hashes = nodes.field("hash").to_pylist()
                # The last block of a tree of several blocks is as high as the others, however few nodes it has.
                levels = block_levels(hashes, min(LEVELS, max(n - 1, 0).bit_length()))
                steps = []
                for at in range(len(hashes)):
                    way = []
                    for level in levels[:-1]:
                        way.append({"left": level[at - 1], "right": None} if at & 1 else {"left": None, "right": level[at + 1] if at + 1 < len(level) else None})
                        at >>= 1
                    steps.append(way)
                count = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tree] * count, pa.string()),
                        nodes.field("pos"),
                        pa.array([n] * count, pa.int64()),
                        nodes.field("hash"),
                        *(nodes.field(c) for c in kept),
                        pa.array([block] * count, pa.int64()),
                        pa.array([levels[-1][0]] * count, pa.binary()),
                        pa.array(steps, pa.list_(side)),
                    ],
                    names=["tree", "pos", "n", "hash", *kept, "block", "top", "steps"],
                )

    return run


def storeys(nodes: DataFrame, kept: list[str] = ()) -> list[DataFrame]:
    """Node rows by storey, from the lowest: each with its way (siblings, left or right) to its block's top.

    nodes: tree, pos (0 to n - 1 within its tree), n, hash and the columns `kept`. The parent of a row is row `block`
    of the next storey, LEVELS binary levels higher; a tree ends where it has one block. Blocks of BLOCK nodes are all
    that a task needs together, so a tree of any size is spread.
    """
    out = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        own = list(kept) if not out else []
        member = F.struct("pos", "hash", *own)
        blocks = nodes.groupBy("tree", "n", F.shiftright("pos", LEVELS).alias("block")).agg(F.array_sort(F.collect_list(member)).alias("nodes"))
        types = {c: dict(nodes.dtypes)[c] for c in own}
        schema = _NODE.replace("{kept}, ", "".join(f"{c} {t}, " for c, t in types.items()))
        rows = written(mapped(blocks.select("tree", "block", "n", "nodes"), _climbed(own), schema), "storey")
        out.append(rows)
        if most <= BLOCK:
            return out
        most = -(-most // BLOCK)
        higher = rows.where(f"pos = block * {BLOCK} and n > {BLOCK}")
        nodes = higher.select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("hash"))


def _count(n: Column) -> Column:
    """Storeys of a tree of n nodes."""
    bits = F.length(F.bin(F.greatest(n - 1, F.lit(1))))
    return F.greatest(F.ceil(bits / F.lit(LEVELS)), F.lit(1)).cast("long")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree, hash, start of every row: its leaf, and what the tampered row would hash to (else the leaf again)."""
    doc_id, n_chars = F.col("doc_id").cast("string"), F.col("n_chars")

    def digest(chars: Column) -> Column:
        return F.unhex(F.sha2(F.concat(*map(_field, (doc_id, F.col("source"), F.col("lang"), chars, F.col("text")))), 256))

    touched = (F.crc32(doc_id.cast("binary")) % 7 == 0) & n_chars.isNotNull()
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        digest(n_chars).alias("hash"),
        F.when(touched, digest(n_chars.cast("decimal(20,0)") + 1)).alias("start"),
    )


_FOLD = """aggregate({steps}, {start}, (h, s) -> unhex(sha2(concat(
    coalesce(lower(hex(s.left)), ''), lower(hex(h)), coalesce(lower(hex(s.right)), '')), 256)))"""
_PASSED = "aggregate({steps}, {start}, (p, s) -> concat(p, coalesce(s.left, X''), coalesce(s.right, X'')))"
_CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT doc_id, tree, block, hash, 1L AS floor,
         {_FOLD.format(steps="steps", start="coalesce(start, hash)")} AS folded,
         {_PASSED.format(steps="steps", start="X''")} AS proof
  FROM {{lowest}}
  UNION ALL
  SELECT c.doc_id, c.tree, c.block, c.hash, c.floor + 1,
         {_FOLD.format(steps="u.steps", start="c.folded")},
         {_PASSED.format(steps="u.steps", start="c.proof")}
  FROM climb c JOIN {{upper}} u ON c.tree = u.tree AND c.block = u.block AND c.floor = u.floor
)
SELECT c.doc_id, lower(hex(c.hash)) AS leaf, lower(hex(b.subroot)) AS subroot,
       sha2(lower(hex(c.proof)), 256) AS proof_sha256, lower(hex(c.folded)) AS folded_root
FROM climb c JOIN {{blocks}} b ON c.tree = b.tree AND c.block = b.block AND c.floor = b.floors
"""


def _recursive(lowest: DataFrame, upper: DataFrame, blocks: DataFrame) -> DataFrame:
    """The climb, run and stored at once: Spark's bound on the rows of a recursion, a million, is lifted only here."""
    spark, bound = lowest.sparkSession, "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(bound)
    spark.conf.set(bound, "-1")
    try:
        return written(spark.sql(_CLIMB, lowest=lowest, upper=upper, blocks=blocks), "climbed")
    finally:
        spark.conf.set(bound, before)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    A null in any column takes part in the leaf as '-', so rows without an id, a language or a text are leaves like
    others; an empty text is '0:'. Rows with one id stand in the order of their leaves; repeated rows are leaves each.
    An empty table has no root and gives no rows. Other columns are not looked at.

    The climb is a recursive query over stored node rows. A row carries LEVELS binary steps, so n leaves are climbed in
    log(n) / LEVELS rounds, not log(n). The rows of the upper storeys are stored once for each of the lowest blocks
    below them (a small part of the leaves), linked by floor: each meets at most BLOCK leaves, also at the root.
    """
    rows = numbered(written(leaves(docs), "leaves"), "tree", ["doc_id", "hash"], "pos", "n")
    own = storeys(rows, ["doc_id", "start"])
    tops = [s.where(f"pos = 0 and n <= {BLOCK}").select("tree", F.col("top").alias("hash")) for s in own]
    trees = tops[0]
    for more in tops[1:]:
        trees = trees.union(more)
    single = trees.select(F.lit("").alias("root"), "tree", "hash")
    ranked = numbered(single, "root", ["tree"], "pos", "n").withColumnRenamed("tree", "name").withColumnRenamed("root", "tree")
    above = storeys(ranked, ["name"])
    top = above[-1].where("pos = 0").select("top").first()
    root = top[0].hex() if top else None

    sizes = own[0].where("pos = 0").select("tree", F.col("n").alias("leaves"))
    names = above[0].select(F.col("name").alias("tree"), F.col("pos").alias("rank"), F.col("hash").alias("subroot"))
    known = sizes.join(names, "tree").select("*", _count(F.col("leaves")).alias("own"), F.ceil(F.col("leaves") / BLOCK).alias("n_blocks"))
    known = written(known, "trees")  # a row per tree

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block")
    blocks = written(known.select("tree", every, (F.col("own") + len(above)).alias("floors"), "subroot"), "blocks")
    parts = []
    for k, storey in enumerate(own[1:], start=1):
        span = F.lit(BLOCK ** (k - 1))
        under = storey.join(known.select("tree", "n_blocks"), "tree")
        last = F.least((F.col("pos") + 1) * span, F.col("n_blocks")) - 1
        parts.append(under.select("tree", F.explode(F.sequence(F.col("pos") * span, last)).alias("block"), F.lit(k).cast("long").alias("floor"), "steps"))
    count = above[0].count()
    for k, storey in enumerate(above):
        span = F.lit(BLOCK**k)
        ranks = storey.select(F.explode(F.sequence(F.col("pos") * span, F.least((F.col("pos") + 1) * span, F.lit(count)) - 1)).alias("rank"), "steps")
        parts.append(ranks.join(known, "rank").select("tree", every, (F.col("own") + k).alias("floor"), "steps"))
    upper = parts[0]
    for more in parts[1:]:
        upper = upper.union(more)
    upper = written(upper, "upper")
    return _recursive(own[0], upper, blocks).select(
        "doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified")
    )


#: The same in plain steps: whole levels as lists, crc32 bit by bit.
SQL = """
with recursive fields as (
  select doc_id, lang, n_chars,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') as head,
         coalesce(strlen(text) || ':' || text, '-') as tail,
         list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
           string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, e: case when e >= 0 then xor(c, e) else xor(c >> 1, (c & 1) * 3988292384) end) as crc
  from documents
), leaf as (
  select doc_id, lang, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) as leaf,
         case when xor(crc, 4294967295) % 7 = 0
              then sha256(head || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || tail)
              else sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) end as start
  from fields
), placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos from leaf
), trees as (
  select lang, 0 as lvl, list(leaf order by pos) as d from placed group by lang
  union all
  select lang, lvl + 1, list_transform(range(0, (len(d) + 1) // 2), lambda i: sha256(d[2 * i + 1] || coalesce(d[2 * i + 2], '')))
  from trees where len(d) > 1
), sub as (
  select lang, d[1] as subroot, row_number() over (order by lang nulls first) - 1 as pos from trees where len(d) = 1
), top as (
  select 0 as lvl, list(subroot order by pos) as d from sub
  union all
  select lvl + 1, list_transform(range(0, (len(d) + 1) // 2), lambda i: sha256(d[2 * i + 1] || coalesce(d[2 * i + 2], '')))
  from top where len(d) > 1
), steps as (
  select p.lang, p.pos, t.lvl, case when (p.pos >> t.lvl) & 1 = 1 then 'L' || t.d[(p.pos >> t.lvl)]
         else coalesce('R' || t.d[(p.pos >> t.lvl) + 2], '-') end as step
  from placed p join trees t on t.lang is not distinct from p.lang and len(t.d) > 1
  union all
  select p.lang, p.pos, 1000 + t.lvl, case when (s.pos >> t.lvl) & 1 = 1 then 'L' || t.d[(s.pos >> t.lvl)]
         else coalesce('R' || t.d[(s.pos >> t.lvl) + 2], '-') end
  from placed p join sub s on s.lang is not distinct from p.lang join top t on len(t.d) > 1
), ways as (
  select lang, pos, list(step order by lvl) as way from steps group by lang, pos
), folded as (
  select p.doc_id, p.leaf, s.subroot, (select d[1] from top where len(d) = 1) as root,
         sha256(coalesce(array_to_string(list_transform(w.way, lambda x: x[2:]), ''), '')) as proof_sha256,
         list_reduce(list_prepend(p.start, coalesce(w.way, [])), lambda h, x: case x[1]
           when 'L' then sha256(x[2:] || h) when 'R' then sha256(h || x[2:]) else sha256(h) end) as folded_root
  from placed p join sub s on s.lang is not distinct from p.lang
  left join ways w on w.lang is not distinct from p.lang and w.pos = p.pos
)
select *, folded_root = root as verified from folded
"""
