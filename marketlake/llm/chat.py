"""Reply trees: root-to-leaf paths by self-joins, branches ranked by score, chat formatting."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, batch, stored

#: The template.  A turn is its opening mark, a space, its text, a space and its closing mark;
#: roles without marks of their own are named in the turn.  BOS and EOS enclose a conversation.
BOS, EOS = "<s>", "</s>"
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("[BOT]", "[/BOT]"), "system": ("[SYS]", "[/SYS]")}
NAMED = ("[ROLE]", "[TURN]", "[/TURN]")
CONTROL = [BOS, EOS, *(m for pair in MARKS.values() for m in pair), *NAMED]

_ANY = "|".join(map(re.escape, CONTROL))
_PLAIN = re.compile(rf"(\\*)({_ANY})")
_ESCAPED = re.compile(rf"\\(\\*)({_ANY})")
# A mark is a control string with no backslash before it.
_MARK = re.compile(rf"(?<!\\)(?:{_ANY})")
_ROLE_OF = {pair: role for role, pair in MARKS.items()}


def escape(text: str) -> str:
    """One more backslash before each control string, so that none reads as a mark."""
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def format_turns(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text and the spans of it under the loss mask (the assistant's texts)."""
    parts, at, spans = [BOS], len(BOS), []
    for role, text in turns:
        if role in MARKS:
            start, end = MARKS[role]
            start += " "
        else:
            start, end = f"{NAMED[0]} {escape(role)} {NAMED[1]} ", NAMED[2]
        body = escape(text)
        parts += [start, body, " " + end]
        if role == "assistant":
            spans.append((at + len(start), at + len(start) + len(body)))
        at += len(start) + len(body) + 1 + len(end)
    return "".join([*parts, EOS]), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    marks = [(m.group(), m.start(), m.end()) for m in _MARK.finditer(formatted)]
    if not marks or marks[0][0] != BOS or marks[-1][0] != EOS:
        raise ValueError("not a formatted conversation")
    turns, k = [], 1
    while k < len(marks) - 1:
        mark, _, end = marks[k]
        if mark == NAMED[0]:
            role = unescape(formatted[end + 1 : marks[k + 1][1] - 1])
            k += 1
            end = marks[k][2]
        else:
            role = _ROLE_OF[mark, marks[k + 1][0]]
        turns.append((role, unescape(formatted[end + 1 : marks[k + 1][1] - 1])))
        k += 2
    return turns


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, branch, leaf, score, pos, node): the root-to-leaf paths of each tree, best first.

    `messages` holds (tree, node, parent, score); parent is null or unknown at a root, and
    (tree, node) is unique.  A path's score is the sum over its messages (null: 0); ties go to the smaller leaf.
    `branches` paths of each tree are kept; pos counts from the root, 0.

    The joins double the stride: after k of them each message knows its ancestor 2^k steps
    up, its depth and the score on the way, so a path of n messages takes log2(n) rounds.
    Leaves are then carried up along the strides, each ancestor reached exactly once.
    Messages on a cycle have no root and are left out.
    """
    here = stored(
        messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")), "messages"
    )
    known = here.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    parents = here.join(known, ["tree", "parent"], "left")
    jump = stored(
        parents.select(
            "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), "score",
            F.when(F.col("known"), 1).otherwise(0).cast("long").alias("steps"),
        ),
        "jump",
    )
    ended, active = [jump.where("up is null")], jump.where("up is not null")
    strides, total = [], here.count()
    while 2 ** len(strides) <= total and not active.isEmpty():
        strides.append(active.select("tree", "node", "up"))
        above = reduce(DataFrame.union, [*ended, active]).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("s2"), F.col("steps").alias("n2")
        )
        # messages whose way to the root is known take no further part
        jump = stored(
            active.join(above, ["tree", "up"]).select(
                "tree", "node", F.col("up2").alias("up"), (F.col("score") + F.col("s2")).alias("score"),
                (F.col("steps") + F.col("n2")).alias("steps"),
            ),
            "jump",
        )
        ended.append(jump.where("up is null"))
        active = jump.where("up is not null")
    jump = reduce(DataFrame.union, ended)
    replied = here.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = jump.join(replied, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.col("score").desc(), "node")
    leaves = leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= branches)
    path = leaves.select("tree", "branch", F.col("node").alias("leaf"), "score", F.col("steps").alias("pos"), "node")
    for k in range(len(strides) - 1, -1, -1):
        above = path.join(strides[k], ["tree", "node"]).select(
            "tree", "branch", "leaf", "score", (F.col("pos") - 2**k).alias("pos"), F.col("up").alias("node")
        )
        path = stored(path.union(above), "path")
    return path


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """(tree, branch, formatted, loss_spans): each chosen path as one formatted conversation.

    `messages` holds (tree, node, role, text).  Null texts and roles count as empty.  Spans are offsets in code points.
    """
    turns = paths.select("tree", "branch", "pos", "node").join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    turn = F.struct("pos", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    paths = turns.groupBy("tree", "branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def formatted(b: pa.RecordBatch) -> pa.RecordBatch:
        done = [format_turns((t["role"], t["text"]) for t in turns.as_py()) for turns in b.column("turns")]
        return batch(
            tree=b.column("tree"), branch=b.column("branch"), formatted=pa.array([t for t, _ in done], pa.string()),
            loss_spans=pa.array([[list(s) for s in spans] for _, spans in done], pa.list_(pa.list_(pa.int32()))),
        )

    kind = dict(paths.dtypes)["tree"]
    return arrow_map(paths, formatted, f"tree {kind}, branch int, formatted string, loss_spans array<array<int>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from each formatted conversation: turns, loss text, lengths."""

    def read_rows(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist(), strict=True):
            turns = read_back(text)
            loss = "".join(unescape(text[start:end]) for start, end in spans)
            rows.append((
                len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text),
            ))
        n, sha, chars, loss_sha, total = zip(*rows, strict=True)
        return batch(
            tree=b.column("tree"), n_turns=list(n), turns_sha256=list(sha), loss_chars=list(chars), loss_sha256=list(loss_sha),
            formatted_chars=list(total),
        )

    kind = dict(formatted.dtypes)["tree"]
    return arrow_map(
        formatted, read_rows,
        f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def conversation_trees(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: each turn replies to the one before it.

    Rows are ordered by turn (null last), then role and text, so repeated and tied turns
    all stay, in a fixed order.  Rows without conv_id are one conversation, whose id is null.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(
        F.struct("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"), "role", "text",
    )
