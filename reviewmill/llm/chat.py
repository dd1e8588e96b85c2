"""Chat formatting as prefix trees: conversations that share their first turns share them in the output.

Conversations are ordered by the hashes of their turns, which puts those with equal beginnings next to
each other in depth-first order of the tree. A block holds consecutive conversations: its text has every
turn once that its conversations share, with the position of each turn in its own conversation (the
depth in the tree) and the intervals of the block's text its tokens may attend to, its ancestors. Blocks
have a bounded length, so a beginning that is shared by very many conversations is written once per block.

Positions and intervals count code points of the block's text by default; with an ``encode`` function
they count its tokens.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
LOSS_ROLES = ("assistant",)
BLOCK_CHARS = 1 << 18

_TURN = re.compile(r"<\|turn\|>((?:[^<\\]|\\.|<(?!\|))*)<\|text\|>((?:[^<\\]|\\.|<(?!\|))*)<\|end\|>", re.DOTALL)


def escape(text: str) -> str:
    """The text without control strings: a backslash stands before each backslash and inside each ``<|``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def rendered(role: str, text: str) -> str:
    return f"{BEGIN}{escape(role)}{BODY}{escape(text)}{END}"


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; everything in it has to be part of one."""
    turns, at = [], 0
    while at < len(text):
        match = _TURN.match(text, at)
        if match is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(match[1]), unescape(match[2])))
        at = match.end()
    return turns


def _node(parent: bytes, role: str, text: str) -> bytes:
    part = f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")
    return hashlib.blake2b(part, key=parent, digest_size=12).digest()


@dataclass(frozen=True)
class Step:
    """A node on the path of the last conversation, with what its followers need to know of it and its ancestors."""

    key: bytes
    node: int
    position: int  # of what comes after it
    intervals: tuple[tuple[int, int], ...]  # its own and its ancestors', those that touch as one


ROOT = Step(b"", -1, 0, ())


def _followed(step: Step, key: bytes, node: int, start: int, length: int) -> Step:
    """The next node of a path. Only the last interval changes, so a path costs as much as it has places to jump."""
    *before, last = step.intervals or ((start, start),)
    grown = (*before, (last[0], start + length)) if last[1] == start else (*before, last, (start, start + length))
    return Step(key, node, step.position + length, grown)


@dataclass
class Block:
    """The text of a block under construction, its nodes and its conversations."""

    text: list[str] = field(default_factory=list)
    length: int = 0
    nodes: list[dict] = field(default_factory=list)
    path: list[Step] = field(default_factory=list)  # nodes of the last conversation
    conversations: list[dict] = field(default_factory=list)


SCHEMA = pa.schema(
    {
        "block": pa.int64(),
        "text": pa.string(),
        "tokens": pa.list_(pa.int32()),
        "nodes": pa.list_(
            pa.struct(
                {
                    "start": pa.int64(),
                    "length": pa.int64(),
                    "position": pa.int64(),
                    "loss_start": pa.int64(),
                    "loss_length": pa.int64(),
                    "attend": pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()})),
                }
            )
        ),
        "conversations": pa.list_(pa.struct({"conv_id": pa.int64(), "nodes": pa.list_(pa.int32())})),
    }
)
SPARK_SCHEMA = (
    "block long, text string, tokens array<int>, nodes array<struct<start: long, length: long, position: long, "
    "loss_start: long, loss_length: long, attend: array<struct<start: long, end: long>>>>, "
    "conversations array<struct<conv_id: long, nodes: array<int>>>"
)


def _build(block_chars: int, encode: Callable[[str], list[int]] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        block, tokens = Block(), []

        def closed() -> pa.RecordBatch:
            row = {"block": number, "text": "".join(block.text), "tokens": tokens if encode else None, "nodes": block.nodes, "conversations": block.conversations}
            return pa.RecordBatch.from_pylist([row], schema=SCHEMA)

        def size(text: str) -> int:
            if encode is None:
                return len(text)
            found = encode(text)
            tokens.extend(found)
            return len(found)

        for batch in batches:
            for row in batch.to_pylist():
                turns, path = [(t["role"], t["text"]) for t in row["turns"]], row["path"]
                shared = 0
                while shared < min(len(path), len(block.path)) and path[shared] == block.path[shared].key:
                    shared += 1
                kept = block.path[:shared]
                for place in range(shared, len(path)):
                    role, text = turns[place]
                    before, start = kept[-1] if kept else ROOT, block.length
                    parts = [f"{BEGIN}{escape(role)}{BODY}", escape(text), END]
                    block.text += parts
                    first, second, third = (size(part) for part in parts)
                    length, loss = first + second + third, role in LOSS_ROLES
                    block.length += length
                    node = {
                        "start": start,
                        "length": length,
                        "position": before.position,
                        "loss_start": start + first if loss else None,
                        "loss_length": second if loss else None,
                        "attend": [{"start": a, "end": b} for a, b in before.intervals],
                    }
                    block.nodes.append(node)
                    kept.append(_followed(before, path[place], len(block.nodes) - 1, start, length))
                block.path = kept
                block.conversations.append({"conv_id": row["conv_id"], "nodes": [step.node for step in kept]})
                if block.length >= block_chars or len(block.conversations) >= block_chars:
                    yield closed()
                    number, block, tokens = number + 1, Block(), []
        if block.conversations:
            yield closed()

    return run


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = []
        for turns in batch.column(1).to_pylist():
            path, node = [], b""
            for turn in turns:
                node = _node(node, turn["role"], turn["text"])
                path.append(node)
            paths.append(path)
        yield pa.record_batch([*batch.columns, pa.array(paths, pa.list_(pa.binary()))], names=["conv_id", "turns", "path"])


def prefix_blocks(turns: DataFrame, block_chars: int = BLOCK_CHARS, encode: Callable[[str], list[int]] | None = None) -> DataFrame:
    """Blocks of formatted conversations from ``turns(conv_id, turn, role, text)``.

    Turns are ordered by ``turn``, equal ones by role and text; null roles and texts are empty. A row without a
    ``conv_id`` is a conversation by itself, so many of them meet nowhere. Each block has its ``text`` (and
    ``tokens`` with ``encode``), ``nodes`` (start, length, first position id, interval of the text under the loss,
    without the end mark, intervals of the ancestors it may attend to besides itself, those that touch as one) and
    ``conversations`` (the nodes of each). Conversations with equal turns share all nodes. Work and size are in
    proportion to the turns, also of a very long conversation, which is one row of the result.
    """
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", *text))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    )
    single = turns.filter("conv_id IS NULL").select("conv_id", F.array(F.struct(*text)).alias("turns"))
    conversations = turns.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(listed.alias("turns")).union(single)
    schema = "conv_id long, turns array<struct<role: string, text: string>>, path array<binary>"
    pathed = conversations.mapInArrow(_paths, schema)
    # The id comes last, so that very many equal conversations need not meet in one task.
    ordered = pathed.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return ordered.mapInArrow(_build(block_chars, encode), SPARK_SCHEMA)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.to_pylist():
            ids, formatted, loss = [], [], []
            for conversation in block["conversations"]:
                nodes = [block["nodes"][n] for n in conversation["nodes"]]
                ids.append(conversation["conv_id"])
                formatted.append("".join(block["text"][n["start"] : n["start"] + n["length"]] for n in nodes))
                masked = (block["text"][n["loss_start"] : n["loss_start"] + n["loss_length"]] for n in nodes if n["loss_start"] is not None)
                loss.append([unescape(m) for m in masked])
            turns = [[{"role": r, "text": t} for r, t in parsed(f)] for f in formatted]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array(formatted, pa.string()),
                pa.array(turns, pa.list_(pa.struct({"role": pa.string(), "text": pa.string()}))),
                pa.array(loss, pa.list_(pa.string())),
            ]
            yield pa.record_batch(columns, names=["conv_id", "formatted", "turns", "loss"])


def read_blocks(blocks: DataFrame) -> DataFrame:
    """Every conversation read back from blocks whose intervals count code points.

    ``formatted`` is its text along the path in the tree, ``turns`` are parsed from it, and ``loss`` has the
    texts under the loss mask, unescaped.
    """
    schema = "conv_id long, formatted string, turns array<struct<role: string, text: string>>, loss array<string>"
    return blocks.select("text", "nodes", "conversations").mapInArrow(_read, schema)
