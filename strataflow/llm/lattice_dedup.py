"""Near-duplicate vectors by E8 lattice hashing with probes of neighbouring cells."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import in_blocks, packed, sorted_groups
from strataflow.llm.graph import components
from strataflow.session import cut_lineage

ROWS_AT_ONCE = 1024
PAIRS_AT_ONCE = 20_000


@dataclass(frozen=True)
class Lattice:
    """``tables`` tables, each of ``blocks`` E8 points of random projections, ``probes`` neighbours probed in each.

    With these numbers a pair of cosine 0.95 in 64 dimensions shares a cell of one table with probability
    0.43 and of any with 0.99999; two random vectors share one with less than 2e-4.
    More vectors ask for more blocks and more tables.
    """

    tables: int = 20
    blocks: int = 2
    probes: int = 2
    scale: float = 0.6
    block_rows: int = 2000  # rows of a cell that are compared at once; fuller cells are cut into such blocks


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates of even sum."""
    point = np.rint(x)
    off = x - point
    odd = np.flatnonzero(point.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: of D8, or of D8 moved by one half."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def e8_neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            row = np.zeros(8)
            row[i], row[j] = s, t
            pairs.append(row)
    halves = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(v < 0 for v in s) % 2 == 0]
    return np.array(pairs + halves)


def cell_keys(unit: np.ndarray, shape: Lattice) -> np.ndarray:
    """Keys of the cells of every unit vector: vectors x tables x (1 + probes), the own cell first.

    The table's number stands in a key's upper bits, and the dimension takes part in it.
    """
    n, d = unit.shape
    around = e8_neighbours()
    keys = np.empty((n, shape.tables, 1 + shape.probes), dtype=np.int64)
    for t in range(shape.tables):
        draw = np.random.default_rng([t, d])
        projected = unit @ (draw.normal(size=(d, 8 * shape.blocks)) * shape.scale)
        mix = draw.integers(1, 2**40, 8 * shape.blocks)
        points, gains = [], []
        for b in range(shape.blocks):
            part = projected[:, 8 * b : 8 * b + 8]
            points.append(nearest_e8(part))
            gains.append((part - points[-1]) @ around.T)
        point = np.rint(np.concatenate(points, 1) * 2).astype(np.int64)
        base = point @ mix + draw.integers(1, 2**40)  # else the point zero has one key in all dimensions
        gain = np.concatenate(gains, 1)
        best = np.argpartition(-gain, shape.probes, axis=1)[:, : shape.probes]
        step = np.rint(around * 2).astype(np.int64)
        moves = np.concatenate([step @ mix[8 * b : 8 * b + 8] for b in range(shape.blocks)])
        cells = np.concatenate([base[:, None], base[:, None] + moves[best]], 1)
        keys[:, t] = (cells * np.int64(0x1E3779B97F4A7C15) >> np.int64(8) & np.int64(2**48 - 1)) | np.int64(t) << np.int64(48)
    return keys


def unit_vector(values) -> np.ndarray | None:
    """The vector in double precision over its length; None if null, empty, zero or not finite throughout."""
    if values is None or not len(values):
        return None
    x = np.asarray(values, dtype=np.float64)  # a null component becomes NaN
    most = np.abs(x).max() if np.isfinite(x).all() else 0.0
    if not most:
        return None
    x = x / most
    return x / np.sqrt(x @ x)


def _signer(shape: Lattice):
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = [unit_vector(v) for v in batch]
            keys: list = [None] * len(units)
            for d in {len(u) for u in units if u is not None}:
                at = [i for i, u in enumerate(units) if u is not None and len(u) == d]
                for i, row in zip(at, cell_keys(np.stack([units[i] for i in at]), shape).reshape(len(at), -1)):
                    keys[i] = row
            prints = [None if u is None else hashlib.blake2b(np.asarray(v, dtype=np.float64).tobytes(), digest_size=16).digest() for u, v in zip(units, batch)]
            yield pd.DataFrame({"print": prints, "keys": keys, "unit": units})

    return F.pandas_udf(sign, "print binary, keys array<bigint>, unit array<double>")


def _first_common(keys: np.ndarray, a: np.ndarray, b: np.ndarray, key: int) -> np.ndarray:
    """Of pairs of rows that share the cell ``key``, which share no cell of a smaller key."""
    left, right = keys[a], keys[b]
    same = left[:, :, :, None] == right[:, :, None, :]
    least = np.where(same, left[:, :, :, None], np.iinfo(np.int64).max).reshape(len(a), -1).min(1)
    return least == key


def _compare(key: int, cross: bool, node: np.ndarray, weight: np.ndarray, unit: np.ndarray, keys: np.ndarray, block: np.ndarray, least: float):
    """Links within one cell: nodes, the smallest node each hangs together with, and their linked vectors."""
    n = len(node)
    links, label = np.zeros(n, dtype=np.int64), np.arange(n)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, n, ROWS_AT_ONCE):
        a, b = np.nonzero(unit[at : at + ROWS_AT_ONCE] @ unit.T >= least)
        a += at
        wanted = (a < b) & (block[a] != block[b]) if cross else a < b
        a, b = a[wanted], b[wanted]
        for k in range(0, len(a), PAIRS_AT_ONCE):
            x, y = a[k : k + PAIRS_AT_ONCE], b[k : k + PAIRS_AT_ONCE]
            here = _first_common(keys, x, y, key)
            x, y = x[here], y[here]
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
            found.append((x, y))
    if found:
        x, y = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        order = np.argsort(node, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        label = rank.copy()
        while len(x):
            low = np.minimum(label[x], label[y])
            before = label.copy()
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            label = np.minimum(label, label[order[label]])
            if (label == before).all():
                break
        label = order[label]
    hit = links > 0
    return node[hit], node[label[hit]], links[hit]


def _comparer(shape: Lattice, least: float):
    columns = ["key", "lo", "hi"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sorted_groups(batches, columns):
            code = batch[columns].to_numpy()
            starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]).any(1)])
            node, weight, block = (batch[c].to_numpy() for c in ("node", "weight", "block"))
            units, keys = batch["unit"].to_numpy(), batch["keys"].to_numpy()
            out = []
            for a, b in zip(starts, [*starts[1:], len(batch)]):
                sizes = np.array([len(u) for u in units[a:b]])
                for d in np.unique(sizes):  # vectors of other dimensions share a key by chance only
                    at = a + np.flatnonzero(sizes == d)
                    if len(at) < 2:
                        continue
                    own = np.stack(keys[at]).reshape(len(at), shape.tables, 1 + shape.probes)
                    out.append(_compare(code[a, 0], code[a, 1] != code[a, 2], node[at], weight[at], np.stack(units[at]), own, block[at], least))
            if out:
                yield pd.DataFrame({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("node", "label", "links"))})

    return compare


def near_vectors(vectors: DataFrame, carry: Sequence[str] = ("vec_id",), cosine: float = 0.95, shape: Lattice = Lattice(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Links between vectors of at least the given cosine: ``doc`` (carried columns), ``n_links`` (other vectors
    linked directly), ``component_id`` (smallest id that links reach), ``kept`` (the id is that one).

    Equal vectors form a class and are counted, not compared. Classes meet in lattice cells; a full cell is cut
    into blocks, so that no task holds more than two of them, and all cosines of a cell are computed where it
    lies. What leaves a task is a count and one label per vector and cell, never a pair. A pair that shares
    several cells counts in the first alone.

    Vectors that are null, empty, zero or not finite in some component link with nothing and are kept; so do
    vectors of different dimensions. Rows with one id are vectors of their own. Null ids never become a
    component's id unless it has no other. An empty table gives an empty result. Input columns travel in ``doc``.
    """
    rows = vectors.select(packed(carry).alias("doc"), F.col(vec_id).alias("_id"), F.col(embedding).alias("_v"))
    stored = cut_lineage(rows.withColumn("_s", _signer(shape)("_v")).select("doc", "_id", "_s.print", "_s.keys", "_s.unit"))
    classes = cut_lineage(
        stored.where("print IS NOT NULL").groupBy("print")
        .agg(F.min("_id").alias("least_id"), F.count(F.lit(1)).alias("weight"), F.first("keys").alias("keys"), F.first("unit").alias("unit"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    keys = classes.select("node", F.explode("keys").alias("key"))
    cells = cut_lineage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("_k"), F.ceil(F.col("n") / shape.block_rows).cast("int").alias("cuts")))
    dealt = in_blocks(keys, cells, "key", "node")
    rows = dealt.join(classes.select("node", "weight", "unit", "keys"), "node").select("key", "lo", "hi", "node", "weight", "block", "unit", "keys")
    grouped = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    found = cut_lineage(grouped.mapInPandas(_comparer(shape, cosine), "node long, label long, links long"))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("node").alias("a"), F.col("label").alias("b")))
    joined = cut_lineage(linked.join(label, "node").join(classes.select("node", "least_id"), "node"))
    least = joined.groupBy("label").agg(F.min("least_id").alias("_c"))
    reached = joined.join(least, "label").select(F.col("node").alias("_n"), "links", "_c")
    ids = cut_lineage(
        classes.select("print", "node", "least_id", "weight").join(reached, F.col("node") == F.col("_n"), "left")
        .select(F.col("print").alias("_p"), F.coalesce("_c", "least_id").alias("component_id"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    return (
        stored.select("doc", "_id", "print").join(ids, F.col("print") == F.col("_p"), "left")
        .withColumn("component_id", F.when(F.col("print").isNull(), F.col("_id")).otherwise(F.col("component_id")))
        .select("doc", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
