"""Chat formatting into packs that share initial turns through a prefix tree.

Each turn becomes one string of the template ``<s>role, newline, body</s>``, the
body of roles other than assistant standing in ``[INST]`` marks. Control strings
inside roles and texts are escaped with a backslash, reversibly. Conversations
that begin with the same turns meet in one pack, in which every shared turn
stands once. A pack is a prefix tree laid out depth first: each segment has its
interval in the packed text, the position id of its first character on its own
path, the intervals of its ancestors (what it may attend to besides itself; those
that touch are one, so a long conversation has few) and whether it bears loss.
Units are code points; a tokenizer's units follow from the intervals.

A prefix that more than PACK conversations share is hot. A conversation goes to
its deepest hot prefix, and there into one of as many packs as the prefix needs,
by the hash of its next prefix, so that a first turn of a third of all
conversations fills many packs of bounded size, each holding that turn once.

Defined results: null role or text is empty; turns go by turn number (null
first), then role and text; a null conv_id is a conversation of its own; repeated
rows are turns; extra columns of any name are ignored; empty input gives no packs.
One conversation is one training sequence and stays whole, however many turns it
has; its packed text has to fit in a string, as any value does.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from .common import join_counted, map_batches, materialise

PACK = 128
OPEN, CLOSE, ASK, ASKED, LOSS_ROLE = "<s>", "</s>", "[INST] ", " [/INST]", "assistant"
CONTROL = re.compile(r"\\|<s>|</s>|\[INST\]|\[/INST\]")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<s>((?:\\.|[^\\\n])*)\n(.*?)</s>", re.DOTALL)

PACK_SCHEMA = (
    "pack string, text string, "
    "segments array<struct<start:int,end:int,position:int,ancestors:array<struct<start:int,end:int>>,loss_start:int,loss_end:int>>, "
    "conversations array<struct<conv_id:bigint,segment:int>>"
)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's string and the interval of it that bears loss."""
    head = OPEN + escape(role).replace("\n", "\\\n") + "\n"
    body = escape(text)
    if role == LOSS_ROLE:
        return head + body + CLOSE, len(head), len(head) + len(body)
    return head + ASK + body + ASKED + CLOSE, 0, 0


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    out = []
    for head, body in TURN.findall(formatted):
        role = unescape(head)
        out.append((role, unescape(body if role == LOSS_ROLE else body[len(ASK) : -len(ASKED)])))
    return out


class Node:
    __slots__ = ("children", "ends", "turn")

    def __init__(self, turn):
        self.turn, self.children, self.ends = turn, {}, []


def layout(conversations: list[tuple[int | None, list[tuple[str, str]]]]) -> tuple[str, list, list]:
    """Packed text, segments and (conv_id, last segment) of one pack."""
    root = Node(None)
    for conv_id, turns in conversations:
        node = root
        for turn in turns:
            node = node.children.setdefault(turn, Node(turn))
        node.ends.append(conv_id)
    parts, segments, owners, size = [], [], [], 0
    # depth first, children in order of their turns
    stack = [(root.children[t], 0, ()) for t in sorted(root.children, reverse=True)]
    while stack:
        node, position, above = stack.pop()
        text, loss_start, loss_end = format_turn(*node.turn)
        start, size = size, size + len(text)
        segments.append((start, size, position, above, start + loss_start, start + loss_end))
        owners += [(c, len(segments) - 1) for c in sorted(node.ends, key=lambda c: (c is not None, c or 0))]
        parts.append(text)
        # a first child stands right behind its parent, so the two are one interval
        below = (*above[:-1], (above[-1][0], size)) if above and above[-1][1] == start else (*above, (start, size))
        stack += [(node.children[t], position + len(text), below) for t in sorted(node.children, reverse=True)]
    return "".join(parts), segments, owners


def _pack_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    rows = zip(table["conv_id"].to_pylist(), table["turns"].to_pylist(), strict=True)
    text, segments, owners = layout([(c, [(t["role"], t["text"]) for t in turns]) for c, turns in rows])
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    segment = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("position", pa.int32()), ("ancestors", pa.list_(span)), ("loss_start", pa.int32()), ("loss_end", pa.int32())])
    names = ("start", "end", "position", "ancestors", "loss_start", "loss_end")
    shaped = [dict(zip(names, (a, b, p, [{"start": x, "end": y} for x, y in up], c, d), strict=True)) for a, b, p, up, c, d in segments]
    return pa.table({
        "pack": pa.array([key[0].as_py()], pa.string()), "text": pa.array([text], pa.string()), "segments": pa.array([shaped], pa.list_(segment)),
        "conversations": pa.array([[{"conv_id": c, "segment": s} for c, s in owners]], pa.list_(pa.struct([("conv_id", pa.int64()), ("segment", pa.int32())]))),
    })


def _with_prefixes(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """turns plus the names of the prefixes, each a digest of the one before and the
    next turn."""

    def run(batches):
        for batch in batches:
            names = []
            for conversation in batch.column("turns"):
                name, own = b"", []
                for t in conversation:
                    role, text = t["role"].as_py().encode(), t["text"].as_py().encode()
                    name = hashlib.md5(name + len(role).to_bytes(8) + role + text, usedforsecurity=False).hexdigest().encode()
                    own.append(name.decode())
                names.append(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.list_(pa.string()))], names=[*batch.schema.names, "prefixes"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema.fields)
    return map_batches(spark, turns, run, f"{shape}, prefixes array<string>")


def pack_conversations(spark: SparkSession, rows: DataFrame, pack: int = PACK) -> DataFrame:
    """One row per pack (PACK_SCHEMA) for rows of conv_id, turn, role, text."""
    clean = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    )
    turns = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    held = materialise(spark, _with_prefixes(spark, turns).withColumn("row_id", F.monotonically_increasing_id()), "chat-turns")
    total = held.count()
    nodes = held.select("row_id", F.posexplode("prefixes").alias("depth", "prefix"))
    hot = materialise(spark, nodes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > pack), "chat-hot")
    deepest = (
        join_counted(nodes, hot.withColumn("sharing", F.col("n")), "prefix", held.agg(F.sum(F.size("prefixes"))).first()[0] or 0)
        .groupBy("row_id")
        .agg(F.max(F.struct("depth", "prefix", "sharing")).alias("hot"))
    )
    next_prefix = F.try_element_at("prefixes", F.coalesce(F.col("hot.depth") + 2, F.lit(1)))
    spread = F.xxhash64(F.coalesce(next_prefix, F.col("row_id").cast("string")))
    bins = F.ceil(F.coalesce(F.col("hot.sharing"), F.lit(total)) / pack)
    placed = held.join(deepest, "row_id", "left").select(
        F.concat_ws("-", F.coalesce("hot.prefix", F.lit("root")), F.pmod(spread, bins).cast("string")).alias("pack"), "conv_id", "turns"
    )
    ship(spark)
    return placed.groupBy("pack").applyInArrow(_pack_group, PACK_SCHEMA)


def read_back(spark: SparkSession, packs: DataFrame) -> DataFrame:
    """What each conversation is, taken from the packs alone."""

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for i in range(batch.num_rows):
                text, segments = batch.column("text")[i].as_py(), batch.column("segments")[i].as_py()
                starts = [s["start"] for s in segments]
                for c in batch.column("conversations")[i].as_py():
                    own = segments[c["segment"]]
                    path = [*[(a["start"], a["end"]) for a in own["ancestors"]], (own["start"], own["end"])]
                    formatted = "".join(text[a:b] for a, b in path)
                    turns = parse(formatted)
                    on_path = [s for a, b in path for s in segments[bisect_left(starts, a) : bisect_left(starts, b)]]
                    learnt = unescape("".join(text[s["loss_start"] : s["loss_end"]] for s in on_path))
                    out["conv_id"].append(c["conv_id"])
                    out["n_turns"].append(len(turns))
                    out["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                    out["loss_chars"].append(len(learnt))
                    out["loss_sha256"].append(hashlib.sha256(learnt.encode()).hexdigest())
                    out["formatted_chars"].append(len(formatted))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return map_batches(spark, packs.select("text", "segments", "conversations"), run, schema)


def report(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The digests of all conversations, by way of packs in the shared folder."""
    return read_back(spark, materialise(spark, pack_conversations(spark, rows), "chat-packs"))
