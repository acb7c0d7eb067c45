"""Trie of conversation prefixes; subtree totals by time-forward processing in shards, then across their roots."""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.llm.common import split_words, text_or_empty
from strataflow.operators.ordered import HOT_LIMIT, SLICE, group_sizes, range_slices, row_number_by
from strataflow.session import cut_lineage

FAMILY = 20  # conversations that may share the head of the first of them
NODE, PARENT = ["id1", "id2"], ["p1", "p2"]


@dataclass(frozen=True)
class Shards:
    """A shard is a piece of the trie whose nodes have about the same number of members: between two powers of ``members``.

    A piece is then at most ``members`` nodes wide, however many conversations share its top. ``queue_rows`` messages
    of a task wait in memory, more are spilled.
    """

    members: int = 1024
    queue_rows: int = 200_000
    hot_limit: int = HOT_LIMIT


class SpillingQueue:
    """A priority queue of tuples; beyond ``room`` of them it writes sorted runs and merges them when read.

    The runs are the task's own overflow, in Spark's spill folder of the executor; no other task reads them, and a lost
    executor takes its task with it.
    """

    def __init__(self, room: int):
        self.room, self.heap, self.heads, self.runs = room, [], [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.room:
            folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
            file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
            self.heap.sort()
            for k in range(0, len(self.heap), 1000):
                pickle.dump(self.heap[k : k + 1000], file)
            file.seek(0)
            self.heap = []
            self.runs.append(self._read(file))
            self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        item = next(self.runs[run], None)
        if item is not None:
            heapq.heappush(self.heads, (item, run))

    def take(self, key: tuple) -> Iterator[tuple]:
        """All items that begin with ``key``, which no later item may precede."""
        while self.heap and self.heap[0][: len(key)] == key:
            yield heapq.heappop(self.heap)
        while self.heads and self.heads[0][0][: len(key)] == key:
            item, run = heapq.heappop(self.heads)
            self._advance(run)
            yield item


def _forward(room: int):
    """Nodes arrive deepest first; each takes the messages sent to it and sends its totals on to its parent."""

    def forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue = SpillingQueue(room)
        for batch in batches:
            leaves, saved = batch["n_leaves"].to_numpy().copy(), batch["saved_tokens"].to_numpy().copy()
            names = ("depth", "id1", "id2", "p1", "p2", "is_root")
            for i, (depth, id1, id2, p1, p2, is_root) in enumerate(zip(*(batch[c].tolist() for c in names))):
                for message in queue.take((-depth, id1, id2)):
                    leaves[i] += message[3]
                    saved[i] += message[4]
                if not is_root:
                    queue.push((1 - depth, p1, p2, int(leaves[i]), int(saved[i])))
            yield batch[["id1", "id2", "p1", "p2", "is_root"]].assign(n_leaves=leaves, saved_tokens=saved)

    return forward


def numbered_turns(conversations: DataFrame, shape: Shards = Shards(), conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos`` (from 1), two digests ``a, b`` of role and text, ``words`` of the text; stored, without the texts.

    Turns are ordered by number, null first; turns of one number by role, then by a digest of the text.
    """
    spoken, said = text_or_empty(role), text_or_empty(text)
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("_turn"),
        spoken.alias("_role"),
        F.xxhash64(spoken, said).alias("a"),
        F.xxhash64(F.lit("again"), said, spoken).alias("b"),
        F.size(split_words(said)).cast("long").alias("words"),
    )
    order = [F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("a"), F.col("b")]
    return cut_lineage(row_number_by(turns, ["conv_id"], order, "pos", shape.hot_limit).drop("_turn", "_role"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Every conversation with the first turns of its family's first one before its own: ``conv_id, depth, length, a, b, words``.

    Of ``h`` (a hash of the id, 0 to 3) turns at most as many are taken as there are; a conversation left without any
    turn is one row of depth and length 0.
    """
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = convs.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(4))).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    bases = convs.where("conv_id = base").select(F.col("conv_id").alias("_b"), F.col("n").alias("_n"))
    convs = convs.join(bases, F.col("base") == F.col("_b"), "left").withColumn("head", F.least("h", F.coalesce("_n", F.lit(0))))
    convs = cut_lineage(convs.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    opening = turns.where("pos <= 3 AND conv_id % 20 = 0").select(F.col("conv_id").alias("_c"), "pos", "a", "b", "words")
    heads = convs.join(opening, (F.col("base") == F.col("_c")) & (F.col("pos") <= F.col("h")))
    own = turns.withColumnRenamed("conv_id", "_c").join(convs, F.col("_c") == F.col("conv_id")).where("pos > h")
    columns = ["conv_id", "length", "a", "b", "words"]
    empty = convs.where("length = 0").select("conv_id", "length", *[F.lit(0).cast("long").alias(c) for c in columns[2:]], F.lit(0).cast("long").alias("depth"))
    parts = [heads.select(*columns, F.col("pos").alias("depth")), own.select(*columns, (F.col("pos") - F.col("h") + F.col("head")).alias("depth")), empty]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _running(df: DataFrame, terms: dict[str, Column], hot_limit: int) -> DataFrame:
    """Exclusive-or of the terms down each conversation; a conversation above the limit is spread over slices."""
    df = df.withColumns({f"_{name}": term for name, term in terms.items()})
    most, rows = group_sizes(df, ["conv_id"])
    if most <= hot_limit:
        down = W.partitionBy("conv_id").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
        return df.select("*", *[F.bit_xor(f"_{n}").over(down).alias(n) for n in terms])
    sliced = range_slices(df, [F.col("conv_id"), F.col("depth")], rows)
    within = W.partitionBy(SLICE, "conv_id").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("_c").orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    # A slice continues at most one conversation, so this has at most one row per slice.
    before = (
        sliced.groupBy(F.col(SLICE).alias("_s"), F.col("conv_id").alias("_c")).agg(*[F.bit_xor(f"_{n}").alias(n) for n in terms])
        .select("_s", "_c", *[F.bit_xor(n).over(earlier).alias(f"_before_{n}") for n in terms]).where(" OR ".join(f"_before_{n} IS NOT NULL" for n in terms))
    )
    local = sliced.select("*", *[F.bit_xor(f"_{n}").over(within).alias(f"_local_{n}") for n in terms])
    joined = local.join(F.broadcast(before), (F.col(SLICE) == F.col("_s")) & (F.col("conv_id") == F.col("_c")), "left")
    whole = [F.col(f"_local_{n}").bitwiseXOR(F.coalesce(f"_before_{n}", F.lit(0).cast("long"))).alias(n) for n in terms]
    return joined.select(*df.columns, *whole)


def paths(turns: DataFrame, hot_limit: int = HOT_LIMIT) -> DataFrame:
    """Each prefix of each conversation: ``conv_id, depth, length, words``, its 128-bit name and that of its parent; stored.

    A name is the exclusive-or of digests of place, role and text, so it can be summed up in any grouping, and a
    parent's name is the node's own without the last turn. Depth 0 is named 0.
    """
    terms = {"id1": F.xxhash64("depth", "a", "b"), "id2": F.xxhash64(F.lit("again"), "b", "depth", "a")}
    terms = {n: F.when(F.col("depth") > 0, t).otherwise(F.lit(0).cast("long")) for n, t in terms.items()}
    named = _running(turns, terms, hot_limit)
    parents = [F.col(n).bitwiseXOR(F.col(f"_{n}")).alias(p) for n, p in zip(NODE, PARENT)]
    return cut_lineage(named.select("conv_id", "depth", "length", "words", *NODE, *parents))


def _digest_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's ids, which arrive in order; what is kept is the state of one digest."""
    at, digest = None, None
    for batch in batches:
        done = []
        for id1, id2, conv in zip(*(batch[c].tolist() for c in ("id1", "id2", "conv_id"))):
            if (id1, id2) != at:
                if digest:
                    done.append((*at, digest.hexdigest()))
                at, digest = (id1, id2), hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        yield pd.DataFrame(done, columns=["id1", "id2", "ends_sha256"]).astype({"id1": "int64", "id2": "int64"})
    if digest:
        yield pd.DataFrame([(*at, digest.hexdigest())], columns=["id1", "id2", "ends_sha256"])


def _ends(walked: DataFrame) -> DataFrame:
    last = walked.where("depth = length").select(*NODE, "conv_id")
    return last.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInPandas(_digest_ends, "id1 long, id2 long, ends_sha256 string")


def _level(members: int) -> Column:
    """How many powers of ``members`` a node's members reach; nodes of fewer than two are of level -1."""
    steps = [members**k for k in range(1, 7) if members**k < 2**62]
    reached = sum((F.when(F.col("n_convs") >= s, 1).otherwise(0) for s in steps), F.lit(0))
    return F.when(F.col("n_convs") < 2, F.lit(-1)).otherwise(reached)


def _totals(nodes: DataFrame, walked: DataFrame, shape: Shards) -> DataFrame | None:
    """``id1, id2, n_leaves, saved_tokens`` of every node with two members or more.

    Below a node of one member lies a single line, so such nodes have one leaf and save nothing: they need no
    processing, and their parents only count them. The others go level by level: the pieces of a level are dealt to
    tasks by their top node, sorted deepest first, and totals travel up in queues; what a top passes on is a row that
    the next level starts from. There are as many rounds as powers of ``members``, five for 10**15 conversations.
    """
    highest = nodes.agg(F.max("level")).first()[0]
    if highest is None or highest < 0:
        return None
    # Members of a node only fall on the way down, so a level is one stretch of a conversation; its top names the piece.
    # The highest level is one piece, that of the root.
    below = nodes.where((F.col("level") >= 0) & (F.col("level") < highest))
    on_path = walked.select("conv_id", "depth", *NODE).join(below.select(*NODE, "level"), NODE)
    tops = on_path.groupBy("conv_id", "level").agg(F.min_by(F.struct(*NODE), "depth").alias("top"))
    zero = F.lit(0).cast("long")
    top = F.coalesce("top", F.struct(zero.alias("id1"), zero.alias("id2")))
    placed = nodes.where("level >= 0").join(tops, ["conv_id", "level"], "left").withColumn("top", top)
    placed = placed.withColumn("is_root", (F.col("top.id1") == F.col("id1")) & (F.col("top.id2") == F.col("id2")))
    placed = cut_lineage(placed.select(*NODE, *PARENT, "depth", "level", "top", "is_root", "n_convs", "words", "n_children", "n_single"))
    done, sent = [], None
    for level in range(highest + 1):
        own = placed.where(F.col("level") == level)
        leaves = F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_single"))
        saved = (F.col("n_convs") - 1) * F.col("words")
        if sent is not None:
            arriving = sent.groupBy(F.col("p1").alias("id1"), F.col("p2").alias("id2")).agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
            own = own.join(arriving, NODE, "left")
            leaves, saved = leaves + F.coalesce("_leaves", F.lit(0)), saved + F.coalesce("_saved", F.lit(0))
        fed = own.select(*NODE, *PARENT, "depth", "is_root", "top", leaves.cast("long").alias("n_leaves"), saved.cast("long").alias("saved_tokens"))
        ordered = fed.repartition("top").sortWithinPartitions(F.col("depth").desc(), *NODE).drop("top")
        found = cut_lineage(ordered.mapInPandas(_forward(shape.queue_rows), "id1 long, id2 long, p1 long, p2 long, is_root boolean, n_leaves long, saved_tokens long"))
        done.append(found.select(*NODE, "n_leaves", "saved_tokens"))
        passed = found.where("is_root").select(*PARENT, "n_leaves", "saved_tokens")
        # A top's parent may lie several levels up, so what one round does not take the next ones do.
        sent = passed if sent is None else sent.join(own.select(F.col("id1").alias("p1"), F.col("id2").alias("p2")), PARENT, "left_anti").unionByName(passed)
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def prefix_trie(conversations: DataFrame, shape: Shards = Shards(), conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of rebuilt conversations, a row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    A null role or text is an empty one; rows without ``conv_id`` belong to no conversation and are left out; turns of
    one number have a fixed order (see :func:`numbered_turns`), repeated rows are turns of their own. A text of any
    length is hashed and counted once, where it lies, and never shuffled. An empty table has no root and gives no rows.
    Other columns of the input are not touched.

    A long conversation is numbered and hashed by many tasks, a prefix that a third of all conversations share is
    counted map-side and stands in a piece of its level alone. The ids of conversations that end in one node pass
    through one task, as a digest can only be taken in order: sorted by Spark, one at a time.
    """
    walked = paths(rebuilt(numbered_turns(conversations, shape, conv_id, turn, role, text)), shape.hot_limit)
    inner = (
        walked.where("depth > 0").groupBy(*NODE)
        .agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    )
    zero = F.lit(0).cast("long")
    root = (
        walked.where("depth <= 1").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
        .select(zero.alias("id1"), zero.alias("id2"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("words"), zero.alias("p1"), zero.alias("p2"))
    )
    counted = cut_lineage(inner.unionByName(root))
    children = counted.where("depth > 0").groupBy(F.col("p1").alias("id1"), F.col("p2").alias("id2")).agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("n_single"))
    nodes = cut_lineage(
        counted.join(children, NODE, "left")
        .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_children", "n_single")})
        .withColumn("level", _level(shape.members))
    )
    totals = _totals(nodes, walked, shape)
    found = nodes if totals is None else nodes.join(totals, NODE, "left")
    leaves, saved = (F.lit(None).cast("long") if totals is None else F.col(c) for c in ("n_leaves", "saved_tokens"))
    parents = nodes.select(F.col("id1").alias("_1"), F.col("id2").alias("_2"), F.col("conv_id").alias("parent_conv_id"))
    return (
        found.join(_ends(walked), NODE, "left")
        .join(parents, (F.col("p1") == F.col("_1")) & (F.col("p2") == F.col("_2")), "left")
        .select(
            "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
            F.coalesce(leaves, F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce(saved, F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
