"""The trie of conversation prefixes, rolled up by centroid decomposition.

Every distinct sequence of first turns is a node; a conversation is a member of the nodes of its prefixes. A node
is known by a sum of position-bound turn digests, so prefixes come from one running sum over each conversation.

Totals over subtrees are rolled up along the parent edges. The forest below the empty prefix is split again and
again: each component is cut at its centroid, the deepest node whose subtree holds more than half of it. The
total of the centroid's subtree is added to all nodes on the path from the centroid to the component's top, and
what remains above and every subtree below are components of their own. A component loses at
least half of its load in a round, so rounds grow with the logarithm of the forest, however deep it is.

Components too large for one task are cut in rounds over DataFrames, with the number of conversation turns below
a node as its load, which the grouping of the prefixes gives at once. The nodes on the path from the
centroid to the top are then just those that hold more than half of the component's load. Components of at
most ``bound`` nodes are cut to the end inside tasks, many in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.session import cut_lineage

SPACES = "[\\x20\\x09-\\x0D]+"
#: The node of the empty prefix.
ROOT = hashlib.md5(b"").digest()


def _word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, SPACES), lambda w: w != ""))


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, content, words): the turns of each conversation in order, counted from 1, as digests.

    Order is by turn, null first; turns with the same number go by role, then by the digest of the text. Null roles and
    texts count as empty. Rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.md5(text.cast("binary"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn", role.alias("role"), said.alias("said"), _word_count(text).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "said")
    content = F.md5(F.concat_ws("|", "said", "role").cast("binary"))
    return turns.select("conv_id", F.row_number().over(order).alias("at"), content.alias("content"), "words")


def share_openings(turns: DataFrame, every: int = 20, longest: int = 4) -> DataFrame:
    """Rebuild each conversation c: the first h turns of conversation c - c % ``every`` in place of its own first h,
    with h = crc32(decimal c) % ``longest``. The columns stay; ``at`` counts the new turns, and a conversation
    without any keeps one row with ``at`` 0.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    convs = turns.select("conv_id").distinct().withColumn("h", h)
    own = turns.withColumn("h", h).filter("at > h").select("conv_id", F.lit(2).alias("part"), "at", "content", "words")
    first = turns.filter((F.col("conv_id") % every == 0) & (F.col("at") < longest))
    first = first.select(F.col("conv_id").alias("base"), "at", "content", "words")
    given = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(first, "base")
    given = given.filter("at <= h").select("conv_id", F.lit(1).alias("part"), "at", "content", "words")
    bare = convs.select(
        "conv_id", F.lit(0).alias("part"), F.lit(0).alias("at"), F.lit("").alias("content"), F.lit(0).cast("long").alias("words")
    )
    order = Window.partitionBy("conv_id").orderBy("part", "at")
    return bare.unionByName(given).unionByName(own).withColumn("at", F.row_number().over(order) - 1)


def steps(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, next, top, words, length): every prefix of every conversation, the empty one
    included. ``turns`` holds a row with ``at`` 0 for each conversation, and its turns from 1 on."""
    bound = F.md5(F.concat_ws("|", F.col("at").cast("string"), "content").cast("binary"))
    parts = [F.conv(F.substring(bound, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    turns = turns.select("conv_id", "at", "words", *[F.when(F.col("at") > 0, p).otherwise(0).alias(f"s{i}") for i, p in enumerate(parts)])
    order = Window.partitionBy("conv_id").orderBy("at")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = [F.sum(f"s{i}").over(order).cast("string") for i in range(4)]
    node = F.unhex(F.md5(F.concat_ws("|", F.col("at").cast("string"), *sums).cast("binary")))
    named = turns.select(
        "conv_id", F.col("at").alias("depth"), F.when(F.col("at") == 0, F.lit(ROOT)).otherwise(node).alias("node"), "words"
    )
    order = Window.partitionBy("conv_id").orderBy("depth")
    return named.select(
        "conv_id", "depth", "node",
        F.lag("node").over(order).alias("parent"),
        F.lead("node").over(order).alias("next"),
        F.max(F.when(F.col("depth") == 1, F.col("node"))).over(whole.orderBy("depth")).alias("top"),
        "words",
        F.max("depth").over(whole.orderBy("depth")).alias("length"),
    )


def ends_digest(walked: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of the conversations that end at each node, in rising order.

    A digest takes its text in order, so a node's ids pass through one task, one batch at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for at, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != node:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = at, hashlib.sha256(b"%d" % conv)
                else:
                    digest.update(b",%d" % conv)
            yield _two(done)
        if node is not None:
            yield _two([(node, digest.hexdigest())])

    def _two(rows) -> pa.RecordBatch:
        found = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())]
        return pa.RecordBatch.from_arrays(found, ["node", "ends_sha256"])

    ends = walked.filter("depth = length").select("node", "conv_id")
    dealt = ends.repartition("node").sortWithinPartitions("node", "conv_id")
    return dealt.mapInArrow(run, "node binary, ends_sha256 string")


def build(walked: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, node, parent, top, n_convs, words and load, the number of
    prefixes of its members that are at least as long."""
    return walked.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.min("top").alias("top"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).cast("long").alias("load"),
    )


def decompose(parent: list[int], values: np.ndarray) -> np.ndarray:
    """Subtree totals of a forest by centroid decomposition. ``parent`` holds each node's parent, which stands before
    it, or -1; ``values`` a row per node."""
    totals = np.zeros_like(values)
    size, group = [1] * len(parent), list(range(len(parent)))
    for i, p in enumerate(parent):
        group[i] = i if p < 0 else group[p]
    trees: dict[int, list[int]] = {}
    for i, top in enumerate(group):
        trees.setdefault(top, []).append(i)
    waiting = list(trees.values())
    while waiting:
        nodes = waiting.pop()
        if len(nodes) == 1:
            totals[nodes[0]] += values[nodes[0]]
            continue
        for i in nodes:
            size[i] = 1
        for i in reversed(nodes[1:]):
            size[parent[i]] += size[i]
        centroid = next(i for i in reversed(nodes) if 2 * size[i] > len(nodes))
        above, below = [], {centroid: [centroid]}
        inside = {centroid: centroid}  # node: the component it goes to
        for i in nodes:
            if i == centroid:
                continue
            to = inside.get(parent[i]) if i != nodes[0] else None
            if to is None:
                above.append(i)
            else:
                inside[i] = to = i if parent[i] == centroid else to
                below.setdefault(to, []).append(i)
        total = values[list(inside)].sum(axis=0)
        at = centroid
        while True:
            totals[at] += total
            if at == nodes[0]:
                break
            at = parent[at]
        del below[centroid]
        waiting += below.values()
        if above:
            waiting.append(above)
    return totals


def _small(components: DataFrame, names: list[str]) -> DataFrame:
    """(node, top, *names) of components that fit into a task, added to what the nodes already have."""
    has = [f"has_{n}" for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # All but the last component of what has arrived are complete.
            tops = batch.column(0)
            last = tops[-1]
            cut = len(batch)
            while cut and tops[cut - 1] == last:
                cut -= 1
            if cut or (held and held[-1].column(0)[-1] != last):
                yield roll(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield roll(pa.Table.from_batches(held))

    def roll(rows: pa.Table) -> pa.RecordBatch:
        nodes, parents = rows["node"].to_pylist(), rows["parent"].to_pylist()
        tops = rows["comp"].to_pylist()
        place = {n: i for i, n in enumerate(nodes)}
        parent = [-1 if n == top else place[p] for n, p, top in zip(nodes, parents, tops)]
        values = np.stack([rows[n].to_numpy().astype(np.int64) for n in names], axis=1).reshape(-1, len(names))
        start = np.stack([rows[n].to_numpy().astype(np.int64) for n in has], axis=1).reshape(-1, len(names))
        totals = start + decompose(parent, values)
        columns = [pa.array(nodes, pa.binary()), *(pa.array(totals[:, i], pa.int64()) for i in range(len(names)))]
        return pa.RecordBatch.from_arrays(columns, ["node", *names])

    dealt = components.select("comp", "depth", "node", "parent", *names, *has)
    dealt = dealt.repartition("comp").sortWithinPartitions("comp", "depth")
    return dealt.mapInArrow(run, "node binary, " + ", ".join(f"{n} long" for n in names))


def roll_up(spark: SparkSession, nodes: DataFrame, walked: DataFrame, names: list[str], bound: int = 50_000) -> DataFrame:
    """(node, *names): the totals of the columns ``names`` over every node's subtree.

    ``nodes`` are rows of ``build``, ``walked`` those of ``steps``. Components above ``bound`` nodes are cut in rounds.
    """
    has = [f"has_{n}" for n in names]
    state = nodes.filter("depth > 0").select(
        "node", "conv_id", "depth", "parent", F.col("top").alias("comp"), "load", *names,
        *[F.lit(0).cast("long").alias(n) for n in has],
    )
    ready, finished = [], []
    while True:
        sizes = state.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.max("load").alias("whole"))
        large = cut_lineage(spark, sizes.filter(F.col("n") > bound).select("comp", "whole"), "large")
        ready.append(state.join(large, "comp", "left_anti"))
        if large.isEmpty():
            break
        state = state.join(large, "comp")
        heavy = state.filter(2 * F.col("load") > F.col("whole"))
        cuts = heavy.groupBy("comp").agg(F.min_by(F.struct("node", "depth", "load"), "load").alias("cut"))
        cuts = cut_lineage(spark, cuts, "centroids")
        below = walked.join(cuts.select("comp", F.col("cut.node").alias("node")), "node")
        below = below.select("comp", "conv_id", F.lit(True).alias("member"), F.col("next").alias("child"))
        state = state.join(cuts, "comp").join(below, ["comp", "conv_id"], "left")
        inside = F.coalesce("member", F.lit(False)) & (F.col("depth") >= F.col("cut.depth"))
        state = cut_lineage(spark, state.withColumn("inside", inside), "split")
        totals = state.filter("inside").groupBy("comp").agg(*[F.sum(n).alias(f"add_{n}") for n in names])
        state = state.join(cut_lineage(spark, totals, "totals"), "comp")
        path = (2 * F.col("load") > F.col("whole")) & (~F.col("inside") | (F.col("node") == F.col("cut.node")))
        state = state.withColumns(
            {h: F.col(h) + F.when(path, F.col(f"add_{n}")).otherwise(0) for h, n in zip(has, names)}
            | {
                "load": F.col("load") - F.when(path & ~F.col("inside"), F.col("cut.load")).otherwise(0),
                "comp": F.when(F.col("inside") & (F.col("depth") > F.col("cut.depth")), F.col("child")).otherwise(F.col("comp")),
            }
        )
        kept = ["node", "conv_id", "depth", "parent", "comp", "load", *names, *has]
        done = F.col("node") == F.col("cut.node")
        state = cut_lineage(spark, state.select(*kept, done.alias("done")), "components")
        finished.append(state.filter("done").select("node", *[F.col(h).alias(n) for h, n in zip(has, names)]))
        state = state.filter("NOT done").drop("done")
    rest = ready[0]
    for more in ready[1:]:
        rest = rest.unionByName(more)
    rolled = _small(rest, names)
    for more in finished:
        rolled = rolled.unionByName(more)
    return rolled


def prefix_trie(spark: SparkSession, conversations: DataFrame, rebuild: bool = True, bound: int = 50_000) -> DataFrame:
    """One row per prefix: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    saved_tokens counts, over the subtree, the words of each node's last turn that all members but one need not
    repeat. With ``rebuild``, conversations first get shared openings (``share_openings``). Conversations without
    a turn belong to the empty prefix only; an empty table has no nodes. Repeated rows are turns of
    their own. Columns of the input other than conv_id, turn, role and text are not looked at.
    """
    turns = turn_digests(conversations)
    if rebuild:
        turns = share_openings(turns)
    else:
        bare = turns.select("conv_id").distinct()
        turns = turns.unionByName(
            bare.select("conv_id", F.lit(0).alias("at"), F.lit("").alias("content"), F.lit(0).cast("long").alias("words"))
        )
    walked = cut_lineage(spark, steps(turns), "steps")
    nodes = cut_lineage(spark, build(walked), "nodes")
    kids = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    described = (
        nodes.join(kids, "node", "left")
        .join(above, "parent", "left")
        .join(ends_digest(walked), "node", "left")
        .withColumns({
            "n_children": F.coalesce("n_children", F.lit(0)),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())),
            "n_leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("words"),
        })
    )
    described = cut_lineage(spark, described, "described")
    names = ["n_leaves", "saved_tokens"]
    rolled = cut_lineage(spark, roll_up(spark, described, walked, names, bound), "rolled")
    # The empty prefix: its own values and the totals of the trees below.
    tops = rolled.join(described.filter("depth = 1").select("node"), "node", "left_semi").select(*names)
    whole = tops.unionByName(described.filter("depth = 0").select(*names))
    root = whole.agg(*[F.sum(n).alias(n) for n in names]).filter("n_leaves IS NOT NULL")
    rolled = rolled.unionByName(root.select(F.lit(ROOT).alias("node"), *names))
    return described.drop(*names).join(rolled, "node").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    )
