"""Chat formatting into a prefix tree.

Conversations are written in a template that marks the turns and escapes control strings inside them.
Those that share initial turns share the nodes of a tree; a node holds the turns between two branchings. Nodes
are emitted once, in depth-first order, each with the position its first token has in its conversations and the
intervals of the emission that its tokens may attend to besides themselves: its ancestors. Tokens are code
points here; the offsets hold for any tokeniser that cuts at the template's marks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.session import cut_lineage

BEGIN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
_OPENED = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left; ``<|`` becomes ``<\\|``, and what looks like that gets one more backslash."""
    return _OPENED.sub(lambda m: "<\\" + m[1] + "|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "<" + m[1] + "|", text)


def escape_role(role: str) -> str:
    """Roles end at the first line end, so line ends inside them are spelled too."""
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text begins and ends."""
    head = f"{BEGIN}{escape_role(role)}\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """Read (role, text) back from a formatted conversation."""
    found = []
    for part in formatted.split(BEGIN)[1:]:
        role, body = part.split("\n", 1)
        found.append((unescape_role(role), unescape(body.removesuffix(CLOSE))))
    return found


def _key(before: str, role: str, text: str) -> str:
    raw = f"{len(role)} {len(text)} {role}{text}".encode("utf-8", "surrogatepass")
    return hashlib.sha256(before.encode() + raw).hexdigest()[:32]


@dataclass
class Chats:
    """``nodes``: node, parent, depth, start and length in the emission, position of its first token, text,
    loss (intervals of the text that count as targets), attends (intervals of the emission).
    ``paths``: conv_id, place, node; the nodes of every conversation in order."""

    nodes: DataFrame
    paths: DataFrame


def format_chats(
    spark: SparkSession,
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Chats:
    """Format conversations given as one row per turn.

    Null roles and texts count as empty. Turns are ordered by number (null first), then role and text, and
    repeated rows are turns of their own. Rows without a conversation id form one conversation. The texts of
    the assistant's turns, as they stand escaped in the node, are under the loss mask. A conversation is one
    record and has to fit in memory; first turns, branches and whole conversations that many share do not meet
    in one task: they are counted by partial aggregation, and joins split large keys.
    """
    turns = F.sort_array(
        F.collect_list(
            F.struct(
                F.col(turn_col).alias("turn"),
                F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                F.coalesce(F.col(text_col), F.lit("")).alias("text"),
            )
        )
    )
    chats = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(turns.alias("turns"))

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv_id, turns in zip(batch["conv_id"].array, batch["turns"]):
                key = ""
                for place, t in enumerate(turns):
                    key = _key(key, t["role"], t["text"])
                    out.append((conv_id, place, key, t["role"], t["text"]))
            frame = pd.DataFrame(out, columns=["conv_id", "place", "prefix", "role", "text"])
            frame["conv_id"] = frame["conv_id"].astype("Int64")
            yield frame

    steps = chats.mapInPandas(prefixes, "conv_id long, place int, prefix string, role string, text string")
    steps = cut_lineage(spark, steps, "turns")
    through = cut_lineage(spark, steps.groupBy("prefix").agg(F.count("*").alias("through")), "prefixes")
    joined = steps.join(through, "prefix")
    whole = joined.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "prefix", "role", "text", "through"))).alias("steps")
    )

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv_id, steps in zip(batch["conv_id"].array, batch["steps"]):
                path, above, position, at = "", [], 0, 0
                while at < len(steps):
                    end = at + 1
                    while end < len(steps) and steps[end]["through"] == steps[at]["through"]:
                        end += 1
                    pieces, loss, length = [], [], 0
                    for s in steps[at:end]:
                        piece, begin, stop = turn(s["role"], s["text"])
                        if s["role"] == ASSISTANT:
                            loss.append({"begin": length + begin, "end": length + stop})
                        pieces.append(piece)
                        length += len(piece)
                    node = steps[end - 1]["prefix"]
                    path += node
                    out.append((conv_id, len(above), node, path, list(above), position, length, "".join(pieces), loss))
                    above.append(node)
                    position += length
                    at = end
            frame = pd.DataFrame(
                out, columns=["conv_id", "place", "node", "path", "above", "position", "length", "text", "loss"]
            )
            frame["conv_id"] = frame["conv_id"].astype("Int64")
            yield frame

    schema = (
        "conv_id long, place int, node string, path string, above array<string>, position long, length long, "
        "text string, loss array<struct<begin:long,end:long>>"
    )
    pieces = cut_lineage(spark, whole.mapInPandas(split, schema), "pieces")
    columns = ["path", "above", "position", "length", "text", "loss"]
    distinct = pieces.groupBy("node").agg(*[F.first(c).alias(c) for c in columns])

    # Paths sort depth first. The order is laid out in ranges; each begins where the ones before it end.
    ranges = distinct.repartitionByRange("path").withColumn("range", F.spark_partition_id())
    ranges = cut_lineage(spark, ranges, "ranges")
    before = F.sum("size").over(Window.orderBy("range")) - F.col("size")  # one row a range
    offsets = ranges.groupBy("range").agg(F.sum("length").alias("size")).select("range", before.alias("offset"))
    inside = Window.partitionBy("range").orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranges.withColumn("within", F.sum("length").over(inside) - F.col("length")).join(offsets, "range")
    placed = placed.withColumn("start", F.col("offset") + F.col("within")).drop("range", "within", "offset")
    placed = cut_lineage(spark, placed, "placed")

    spans = placed.select(F.col("node").alias("ancestor"), F.col("start").alias("begin"), (F.col("start") + F.col("length")).alias("end"))
    spans = cut_lineage(spark, spans, "spans")
    attends = (
        placed.select("node", F.posexplode("above").alias("place", "ancestor"))
        .join(spans, "ancestor")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("place", "begin", "end"))).alias("found"))
        .select("node", F.transform("found", lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"))).alias("attends"))
    )
    nodes = placed.join(attends, "node", "left").select(
        "node", F.get("above", F.size("above") - 1).alias("parent"), F.size("above").alias("depth"),
        "start", "length", "position", "text", "loss",
        F.coalesce("attends", F.array().cast("array<struct<begin:bigint,end:bigint>>")).alias("attends"),
    )
    return Chats(cut_lineage(spark, nodes, "nodes"), pieces.select("conv_id", "place", "node"))


def digests(chats: Chats) -> DataFrame:
    """Read every conversation back from the emitted nodes: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars and nodes (how many it is made of)."""
    parts = chats.paths.join(chats.nodes.select("node", "text", "loss"), "node")
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "text", "loss"))).alias("parts"))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "nodes"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv_id, parts in zip(batch["conv_id"].array, batch["parts"]):
                formatted = "".join(p["text"] for p in parts)
                turns = turns_of(formatted)
                spoken = "".join(f"{role}\n{text}\n" for role, text in turns)
                loss = "".join(unescape(p["text"][s["begin"] : s["end"]]) for p in parts for s in p["loss"])
                digest = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (spoken, loss)]
                out.append((conv_id, len(turns), digest[0], len(loss), digest[1], len(formatted), len(parts)))
            frame = pd.DataFrame(out, columns=names)
            frame["conv_id"] = frame["conv_id"].astype("Int64")
            yield frame

    return whole.mapInPandas(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, nodes long",
    )
