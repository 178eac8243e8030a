"""Conversations as prefix trees: shared initial turns are formatted and emitted once, depth first.

A node is a turn after a given sequence of turns; conversations with the same first turns share nodes. Nodes are laid out in
depth-first order in one long buffer (`start`, `length`), with the position of their first unit in each conversation
(`position`) and the intervals of the buffer that they attend to: their ancestors and themselves. Units are code points of the formatted text.

Turns are in the order of `turn`, then role, then text; repeated rows are turns of their own. Null role and null text are empty, and rows
without conv_id form one conversation. An empty table gives empty results; extra columns are ignored.

The order of the buffer comes from a range partition of paths and a sum per partition, so a tree with any share of all nodes is spread over
tasks. A conversation is read in order by one task, which holds one batch of it.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideway.llm.common import written

# Strings that mark turns, here and in another widespread template; inside texts they are broken by a backslash.
CONTROL = re.compile(r"<\||\|>|</?s>|\[/?INST\]")
BEGIN, MIDDLE, END = "<|", "|>\n", "<|end|>\n"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def form(role: str, text: str) -> tuple[str, int, int]:
    """The marked turn and where in it the escaped text lies."""
    head = f"{BEGIN}{escape(role)}{MIDDLE}"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def read(turn: str) -> tuple[str, str]:
    """Role and text of a marked turn; a role's escaped form holds no marker, so the first one ends it."""
    head, _, rest = turn[len(BEGIN):].partition(MIDDLE)
    return unescape(head), unescape(rest[:-len(END)])


def trees(conversations: DataFrame, *, learn_from: tuple[str, ...] = ("assistant",)) -> tuple[DataFrame, DataFrame]:
    """(nodes, leaves).

    nodes: node, parent, depth, text (formatted), loss_from, loss_to (part of text under the loss mask; empty where nothing is learned), start,
    length, position, attends (array of (from, to)), path (its ancestors and itself, as ids). leaves: conv_id, n_turns, node.
    """
    ordered = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))

    def walk(batches):
        conv, path, depth = object(), b"", 0
        for batch in batches:
            rows = []
            for conv_id, role, text in zip(batch["conv_id"].array, batch["role"], batch["text"], strict=True):
                conv_id = None if pd.isna(conv_id) else int(conv_id)
                if conv_id != conv:
                    conv, path, depth = conv_id, b"", 0
                own = hashlib.sha256(b"%b %d " % (path[-16:], len(role)) + role.encode() + text.encode()).digest()[:16]
                path, depth = path + own, depth + 1
                formatted, a, b = form(role, text)
                learned = role in learn_from
                rows.append((conv_id, depth, path, formatted, a if learned else 0, b if learned else 0))
            out = pd.DataFrame(rows, columns=["conv_id", "depth", "path", "text", "loss_from", "loss_to"])
            yield out.astype({"conv_id": "Int64"})

    turns = written(
        ordered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInPandas(walk, "conv_id long, depth int, path binary, text string, loss_from int, loss_to int"), "turns")
    node = F.expr("substring(path, -16, 16)")
    nodes = turns.withColumn("node", node).groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("path", "depth", "text", "loss_from", "loss_to")]).withColumn("length", F.length("text").cast("long"))

    def lay(batches):
        at = 0
        for batch in batches:
            ends = batch["length"].cumsum() + at
            yield batch.assign(start=ends - batch["length"])
            at = int(ends.iloc[-1]) if len(ends) else at

    placed = nodes.repartitionByRange("path").sortWithinPartitions("path")
    placed = placed.mapInPandas(lay, T.StructType([*placed.schema.fields, T.StructField("start", T.LongType())])).withColumn("part", F.spark_partition_id())
    placed = written(placed, "nodes")
    # one row per partition
    parts = placed.groupBy("part").agg(F.sum("length").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    placed = placed.join(parts, "part").withColumn("start", F.col("start") + F.col("before")).drop("part", "before")
    step = F.expr("transform(sequence(1, depth), i -> substring(path, 16 * i - 15, 16))")
    above = (placed.select("node", F.posexplode(step).alias("k", "ancestor"))
             .join(placed.select(F.col("node").alias("ancestor"), "start", "length"), "ancestor")
             .groupBy("node").agg(
                 F.array_sort(F.collect_list(F.struct("k", F.col("start").alias("from"), (F.col("start") + F.col("length")).alias("to")))).alias("all"),
                 F.sum("length").alias("until")))
    nodes = placed.join(above, "node").select(
        "node", F.expr("case when depth > 1 then substring(path, -32, 16) end").alias("parent"), "depth", "text", "loss_from", "loss_to", "start", "length",
        (F.col("until") - F.col("length")).alias("position"), F.transform("all", lambda x: F.struct(x["from"], x["to"])).alias("attends"),
        step.alias("path"))
    leaves = turns.groupBy("conv_id").agg(F.max("depth").cast("long").alias("n_turns"), F.expr("substring(max_by(path, depth), -16, 16)").alias("node"))
    return nodes, leaves


def read_back(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """Digests of each conversation, from the formatted nodes on the way to its leaf."""
    ways = leaves.join(nodes.select("node", "path"), "node").select("conv_id", F.posexplode("path").alias("k", "node"))
    told = ways.join(nodes.select("node", "text", "loss_from", "loss_to"), "node").repartition("conv_id").sortWithinPartitions("conv_id", "k")

    def digest(batches):
        conv, begun = None, False
        state: list = []

        def row():
            turns, loss, n, learned, size = state
            return (conv, n, turns.hexdigest(), learned, loss.hexdigest(), size)

        for batch in batches:
            rows = []
            for conv_id, text, a, b in zip(batch["conv_id"].array, batch["text"], batch["loss_from"], batch["loss_to"], strict=True):
                conv_id = None if pd.isna(conv_id) else int(conv_id)
                if not begun or conv_id != conv:
                    if begun:
                        rows.append(row())
                    conv, begun, state = conv_id, True, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                role, said = read(text)
                state[0].update(f"{role}\n{said}\n".encode())
                learned = unescape(text[a:b])
                state[1].update(learned.encode())
                state[2] += 1
                state[3] += len(learned)
                state[4] += len(text)
            yield frame(rows)
        if begun:
            yield frame([row()])

    def frame(rows):
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})

    return told.mapInPandas(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
