"""Chat formatting: quoted passages are linked to the messages they come from, and cut out of the conversation."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, slices, written

_MARK = re.compile(r"[ \t]*((?:>[ \t]?)+)")
_SPACE = re.compile(r"\s+")
#: How a line that introduces a quotation ends, whatever its length.
_ATTRIBUTION = (" wrote:", " said:")


def parse(text: str) -> list[tuple[int, str]]:
    """Blocks of neighbouring lines of one quote level, 0 for the writer's own; marks and surrounding space cut off.

    The line that introduces a quotation ("... wrote:") is dropped with it.
    """
    blocks: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        mark = _MARK.match(line)
        level, line = (mark[1].count(">"), line[mark.end() :]) if mark else (0, line)
        if not blocks or blocks[-1][0] != level:
            if blocks and blocks[-1][0] < level and blocks[-1][1] and blocks[-1][1][-1].strip().casefold().endswith(_ATTRIBUTION):
                blocks[-1][1].pop()
            blocks.append((level, []))
        blocks[-1][1].append(line)
    out = [(level, "\n".join(lines).strip()) for level, lines in blocks]
    return [b for b in out if b[1]]


def passages(block: str) -> dict[int, int]:
    """Hash and length of a block and of each of its lines, case and white space levelled."""
    plain = {_SPACE.sub(" ", p).strip().casefold() for p in (block, *block.split("\n"))} - {""}
    return {int.from_bytes(hashlib.blake2b(p.encode(), digest_size=8).digest(), "little", signed=True): len(p) for p in plain}


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = pa.list_(pa.int64())
    weighed = pa.list_(pa.struct([("level", pa.int32()), ("h", pa.int64()), ("n", pa.int32())]))
    for part in slices(batches, "text"):
        content, own, quoted, levels = [], [], [], []
        for text in part.column("text").to_pylist():
            blocks = parse(text or "")
            mine = "\n".join(b for level, b in blocks if level == 0)
            content.append(None if text is None else mine)
            own.append(sorted({h for level, b in [*blocks, (0, mine)] if level == 0 for h in passages(b)}))
            quoted.append([{"level": level, "h": h, "n": n} for level, h, n in sorted({(level, h, n) for level, b in blocks if level for h, n in passages(b).items()})])
            levels.append(max((level for level, _ in blocks), default=0))
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in ("conv_id", "turn", "role")), pa.array(content, pa.string()), pa.array(own, hashes), pa.array(quoted, weighed), pa.array(levels, pa.int32())],
            names=["conv_id", "turn", "role", "content", "own", "quoted", "quote_levels"],
        )


def links(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, quotes, reply_to: the earlier message that the passages of each quote level point to most.

    Each passage, a whole quoted block or a line of it, points to the latest earlier message that has it and weighs as
    much as it is long; of several messages with the same weight it is the latest. The latest message is found by a
    running maximum over a passage's rows in turn order, so no pairs are made. Originals are first cut to passages
    that some message of the conversation quotes. quotes has (level, reply_to) of every level with a match; reply_to
    is that of the shallowest of them.
    """
    known = parsed.where("conv_id is not null and turn is not null")
    asked = known.select("conv_id", "turn", F.inline("quoted")).distinct()
    given = known.select("conv_id", "turn", F.explode("own").alias("h"))
    given = given.join(asked.select("conv_id", "h").distinct(), ["conv_id", "h"], "left_semi").distinct()
    given = given.withColumns({"level": F.lit(None).cast("int"), "n": F.lit(0), "source": F.col("turn").cast("long")})
    both = asked.withColumn("source", F.lit(None).cast("long")).unionByName(given)
    earlier = Window.partitionBy("conv_id", "h").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("reply_to", F.max("source").over(earlier)).where("source is null and reply_to is not null")
    votes = found.groupBy("conv_id", "turn", "level", "reply_to").agg(F.sum("n").alias("n"))
    best = votes.groupBy("conv_id", "turn", "level").agg(F.max(F.struct("n", "reply_to")).reply_to.alias("reply_to"))
    quotes = F.array_sort(F.collect_list(F.struct("level", "reply_to"))).alias("quotes")
    return best.groupBy("conv_id", "turn").agg(quotes).withColumn("reply_to", F.col("quotes")[0].reply_to)


def threads(linked: DataFrame) -> DataFrame:
    """conv_id, turn, quotes, reply_to, thread, depth: each linked message's first ancestor and its distance.

    Every round doubles the distance that a row looks back, so a chain of n replies takes log2(n) rounds; a round is
    one written table.
    """
    now = written(linked.select("*", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")), "threads")
    while True:
        up = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("top"), F.col("depth").alias("more"))
        step = now.join(up, ["conv_id", "thread"], "left")
        then = written(
            step.select(
                "conv_id", "turn", "quotes", "reply_to",
                F.coalesce("top", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("top").isNotNull().alias("moved"),
            ),
            "threads",
        )
        now = then.drop("moved")
        if not then.where("moved").limit(1).count():
            return now


def ranks(chain: DataFrame) -> DataFrame:
    """conv_id, turn, rank: the place of each message of a chain of replies when it is read depth first, replies by turn.

    A tour enters and leaves every message once; each round doubles the distance that a step looks ahead, so a thread
    of n messages takes about log2(2 n) rounds. A step counts the messages entered from it to the tour's end.
    """
    roots = chain.select("conv_id", F.col("thread").alias("turn"), F.lit(None).cast("long").alias("up"), "thread").distinct()
    nodes = roots.unionByName(chain.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("reply_to").alias("up"), "thread"))
    heads = nodes.where("up is not null").groupBy("conv_id", F.col("up").alias("turn")).agg(F.min("turn").alias("child"))
    after = Window.partitionBy("conv_id", "up").orderBy("turn")
    beside = nodes.where("up is not null").select("conv_id", "turn", F.lead("turn").over(after).alias("beside"))
    nodes = nodes.join(heads, ["conv_id", "turn"], "left").join(beside, ["conv_id", "turn"], "left")

    def step(turn, leaves):
        return F.struct(turn.alias("turn"), leaves.alias("leaves"))

    no, yes = F.lit(False), F.lit(True)
    enter = F.when(F.col("child").isNull(), step(F.col("turn"), yes)).otherwise(step(F.col("child"), no))
    leave = F.when(F.col("beside").isNotNull(), step(F.col("beside"), no)).when(F.col("up").isNotNull(), step(F.col("up"), yes))
    now = written(
        nodes.select("conv_id", "thread", step(F.col("turn"), no).alias("at"), enter.alias("next"), F.lit(1).cast("long").alias("n")).unionByName(
            nodes.select("conv_id", "thread", step(F.col("turn"), yes).alias("at"), leave.alias("next"), F.lit(0).cast("long").alias("n"))
        ),
        "ranks",
    )
    while now.where("next is not null").limit(1).count():
        ahead = now.select("conv_id", F.col("at").alias("next"), F.col("next").alias("then"), F.col("n").alias("more"))
        both = now.join(ahead, ["conv_id", "next"], "left")
        now = written(both.select("conv_id", "thread", "at", F.col("then").alias("next"), (F.col("n") + F.coalesce("more", F.lit(0))).alias("n")), "ranks")
    entered = now.where("not at.leaves").select("conv_id", "thread", F.col("at.turn").alias("turn"), "n")
    total = entered.where("turn = thread").select("conv_id", "thread", F.col("n").alias("size"))
    return entered.join(total, ["conv_id", "thread"]).select("conv_id", "turn", (F.col("size") - F.col("n")).alias("rank"))


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with their position, from 0, within their conversation in the given order.

    Rows are dealt by ranges of the order, so that a long conversation lies in many tasks, numbered there, and the
    numbers of the parts before are added.
    """
    dealt = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    dealt = written(dealt.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33).alias("_part")
    parts = dealt.groupBy("conv_id", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    parts = parts.select(F.col("conv_id").alias("_conv"), F.col("_part").alias("_p"), "_first", "_before")
    at = dealt.withColumn("_part", part)
    at = at.join(parts, (F.col("conv_id").eqNullSafe(F.col("_conv"))) & (F.col("_part") == F.col("_p")))
    return at.withColumn("position", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_conv", "_p", "_first", "_before")


def _escaped(text: Column) -> Column:
    """A text in which no marker of a turn stands: the bar of what looks like one is set off by a blank."""
    return F.regexp_replace(text, r"(?i)<\|(?=\s*im_(?:start|end|sep)\b)", "< |")


def conversations(messages: DataFrame) -> DataFrame:
    """Every message once, without quotations, with its place in the reply order of its conversation.

    conv_id, turn, role, content, quote_levels (deepest), reply_to (turn of the quoted message or null), thread (turn
    of the first message of its chain of replies; its own turn if it replies to none), depth, formatted, quotes (level
    and turn of the quoted message, per quote level that has one), position. Reading a conversation by position, from
    0, goes through threads by their first turn, and through each thread depth first, replies by turn: every message
    stands after the one it replies to, with the replies to it behind it; without quotations that is the order of
    turns. The text of a conversation is left to the reader or writer to join, so that none has to pass through one task.

    Markers of a turn that a message or role has itself are set apart in `formatted`, so that no message can open a turn.
    A null text stays null and is formatted as empty; a message that only quotes has an empty content. Messages whose
    conv_id or turn is null, and quotations of what no earlier message of the conversation says, are not linked.
    Repeated rows are all kept and get the same link. Other columns are not looked at.
    """
    rows = messages.select("conv_id", "turn", "role", "text")
    kinds = dict(rows.dtypes)
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, content string, own array<long>, quoted array<struct<level: int, h: bigint, n: int>>, quote_levels int"
    parsed = written(mapped(rows, _parsed, schema), "parsed")  # read three times below
    chain = threads(links(parsed))
    out = parsed.drop("own", "quoted").join(chain, ["conv_id", "turn"], "left")
    out = out.join(ranks(chain), ["conv_id", "turn"], "left").withColumn("thread", F.coalesce("thread", F.col("turn").cast("long")))
    out = positions(out.withColumn("rank", F.coalesce("rank", F.lit(0))), ["thread", "rank", "turn", "role", "content"])
    role = F.regexp_replace(_escaped(F.coalesce("role", F.lit("user"))), r"\s+", " ")
    text = F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), _escaped(F.coalesce("content", F.lit(""))), F.lit("<|im_end|>\n"))
    return out.select(
        "conv_id", "turn", "role", "content", "quote_levels", "reply_to",
        "thread",
        F.coalesce("depth", F.lit(0)).alias("depth"),
        text.alias("formatted"),
        F.coalesce("quotes", F.array().cast("array<struct<level:int,reply_to:bigint>>")).alias("quotes"),
        "position",
    )
