"""Near-duplicates by b-bit MinHash: banded candidates, estimates from packed low bits, links confirmed on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import ascii_lower, in_blocks, packed, sorted_groups, split_words, text_or_empty, unpacked, with_bitmap
from strataflow.llm.graph import components
from strataflow.session import cut_lineage

BITS = 4  # low bits kept of every minimum
BLOCK_ROWS = 2000  # rows of a bucket that are compared at once; fuller buckets are cut into such blocks
BLOCK_SHINGLES = 4_000_000  # shingles of rows whose full sets are compared at once; longer texts are cut into more blocks
SHINGLES_AT_ONCE = 2048


@dataclass(frozen=True)
class Bands:
    """``bands`` bands of ``rows`` minima each: at 80 % likeness a pair shares none with probability 3e-6."""

    bands: int = 32
    rows: int = 5

    @property
    def minima(self) -> int:
        return self.bands * self.rows


def shingle_hashes(text: Column, width: int) -> Column:
    """The set of a text's shingles of ``width`` words, as 64-bit hashes; of fewer words, the whole text is one.

    A text without words has an empty set. Expects ``_words`` to hold the words.
    """
    words = F.col("_words")
    each = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, width)]))
    whole = F.array(F.xxhash64(F.lit("all"), F.array_join(words, " ")))
    return (
        F.when(F.size(words) >= width, F.array_distinct(F.slice(each, F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(0)))))
        .when(F.size(words) > 0, whole)
        .otherwise(F.array().cast("array<bigint>"))
    )


def with_shingles(rows: DataFrame, width: int) -> DataFrame:
    """``shingles`` from ``_text``."""
    return rows.withColumn("_words", split_words(ascii_lower(F.col("_text")))).withColumn("shingles", shingle_hashes(F.col("_text"), width)).drop("_words")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _signer(shape: Bands):
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        draw = np.random.default_rng(20_26)
        factor = draw.integers(0, 2**63, shape.minima, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        shift = draw.integers(0, 2**63, shape.minima, dtype=np.uint64)
        place = np.arange(shape.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            prints, signatures, bands = [], [], []
            for hashes in batch:
                if not len(hashes):
                    prints.append(None), signatures.append(None), bands.append(None)
                    continue
                own = np.asarray(hashes).astype(np.int64).view(np.uint64)
                least = np.full(shape.minima, 2**64 - 1, dtype=np.uint64)
                for at in range(0, len(own), SHINGLES_AT_ONCE):
                    part = own[at : at + SHINGLES_AT_ONCE, None] * factor
                    part += shift
                    np.minimum(least, part.min(axis=0), out=least)
                least = _mixed(least)
                low = (least & np.uint64(2**BITS - 1)).reshape(-1, 64 // BITS) << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))
                key = place.copy()
                for row in least.reshape(shape.bands, shape.rows).T:
                    key = _mixed(key ^ row)
                prints.append(hashlib.blake2b(np.sort(own).tobytes(), digest_size=16).digest())
                signatures.append(np.bitwise_or.reduce(low, axis=1).view(np.int64))
                bands.append(key.view(np.int64))
            yield pd.DataFrame({"print": prints, "signature": signatures, "bands": bands})

    return F.pandas_udf(sign, "print binary, signature array<bigint>, bands array<bigint>")


def agreeing(a: Column, b: Column) -> Column:
    """How many of the packed low bits' groups are equal, by bit counts."""

    def differing(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        spread = z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseOR(F.shiftrightunsigned(z, 3))
        return F.bit_count(spread.bitwiseAND(F.lit(0x1111111111111111)))

    groups = F.size(a) * (64 // BITS)
    return groups - F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda n, d: n + d)


def estimated(a: Column, b: Column) -> Column:
    """Likeness from equal low bits, less those that are equal by chance."""
    chance = 2.0**-BITS
    return (agreeing(a, b) / (F.size(a) * (64 // BITS)) - chance) / (1 - chance)


def _worth(percent: int, shape: Bands, deviations: float = 5.0) -> float:
    """The estimate below which a pair of at least ``percent`` likeness falls with a probability of 3e-7."""
    chance = 2.0**-BITS
    p = chance + (1 - chance) * percent / 100
    return (p - deviations * (p * (1 - p) / shape.minima) ** 0.5 - chance) / (1 - chance)


class _Finder:
    """Links between classes of equal sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, text: str, doc_id: str, width: int, percent: int, shape: Bands):
        self.classes, self.width, self.percent = classes, width, percent
        self.worth, self.minima = _worth(percent, shape), shape.minima
        self.rows = docs.select(identity(doc_id, text).alias("row"), text_or_empty(text).alias("_text"))

    def texts(self, nodes: DataFrame) -> DataFrame:
        """``node, _text`` of the given classes, looked up by their rows' identities; other texts are not shuffled."""
        wanted = cut_lineage(self.classes.join(nodes, "node").select("node", F.col("row").alias("_row")))
        maybe = with_bitmap(self.rows, "row", wanted.select("_row"), "_maybe").where("_maybe").drop("_maybe")
        return cut_lineage(maybe.join(wanted, F.col("row") == F.col("_row")).select("node", "_text"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``a, b`` whose estimate is worth a look and whose full sets are alike enough.

        The sets are cut anew from the texts concerned, so that no table of all sets is ever stored.
        """
        named = lambda side: self.classes.select(F.col("node").alias(side), F.col("signature").alias(f"_{side}"))
        worth = cut_lineage(pairs.join(named("a"), "a").join(named("b"), "b").where(estimated(F.col("_a"), F.col("_b")) >= self.worth).select("a", "b"))
        if worth.isEmpty():
            return worth
        texts = self.texts(worth.select(F.col("a").alias("node")).unionByName(worth.select(F.col("b").alias("node"))).distinct())
        side = lambda n: with_shingles(texts.withColumnRenamed("node", n), self.width).withColumnRenamed("shingles", f"_{n}").drop("_text")
        both = worth.join(side("a"), "a").join(side("b"), "b").withColumn("_n", F.size(F.array_intersect("_a", "_b")))
        alike = 100 * F.col("_n") >= self.percent * (F.size("_a") + F.size("_b") - F.col("_n"))
        return cut_lineage(both.where(alike).select("a", "b").distinct())


def identity(doc_id: str, text: str) -> Column:
    """A row's id and text as one key; rows that are equal in both have equal keys."""
    return F.unhex(F.md5(F.concat_ws("\x1f", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), text_or_empty(text))))


def _suspects(worth: float, minima: int):
    """Rows of a bucket's blocks that some row of another component may be alike, by their low bits."""
    groups = minima
    least = (2.0**-BITS + (1 - 2.0**-BITS) * worth) * groups

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sorted_groups(batches, ["key", "lo", "hi"]):
            packed_bits = np.stack(batch["signature"].to_numpy()).astype(np.int64).view(np.uint64)
            shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
            low = ((packed_bits[:, :, None] >> shifts) & np.uint64(2**BITS - 1)).astype(np.uint8).reshape(len(batch), -1)
            code = batch[["key", "lo", "hi"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]).any(1)])
            label, other = batch["label"].to_numpy(), batch["label"].to_numpy() != batch["hub_label"].to_numpy()
            hit = np.zeros(len(batch), dtype=bool)
            for a, b in zip(starts, [*starts[1:], len(batch)]):
                for i in np.flatnonzero(other[a:b]) + a:
                    near = ((low[a:b] == low[i]).sum(1) >= least) & (label[a:b] != label[i])
                    if near.any():
                        hit[a:b] |= near
                        hit[i] = True
            yield batch.loc[hit, ["key", "lo", "hi", "node", "label", "hub_label"]]

    return find


def _verify(percent: int):
    """Links between rows of different components, from their full sets; a few per row, enough to join them up."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sorted_groups(batches, ["key", "lo", "hi"]):
            code = batch[["key", "lo", "hi"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]).any(1)])
            node, label = batch["node"].to_numpy(), batch["label"].to_numpy()
            other, sets = label != batch["hub_label"].to_numpy(), batch["shingles"].to_numpy()
            found = []
            for a, b in zip(starts, [*starts[1:], len(batch)]):
                if b - a < 2:
                    continue
                sizes = np.array([len(s) for s in sets[a:b]])
                at = np.cumsum(sizes) - sizes
                kinds, ids = np.unique(np.concatenate(sets[a:b]), return_inverse=True)
                mark = np.zeros(len(kinds), dtype=np.int32)
                for i in np.flatnonzero(other[a:b]):
                    own = ids[at[i] : at[i] + sizes[i]]
                    mark[own] = 1
                    both = np.add.reduceat(mark[ids], at)
                    mark[own] = 0
                    alike = (100 * both >= percent * (sizes + sizes[i] - both)) & (label[a:b] != label[a + i])
                    _, one = np.unique(label[a:b][alike], return_index=True)  # one link to each other component
                    found += [(node[a + i], node[a + j]) for j in np.flatnonzero(alike)[one]]
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return links


def _connect(find: _Finder, members: DataFrame) -> DataFrame:
    """``node, label`` of all classes that some link joins to another.

    Every bucket's members are compared with one of them, the hub, by joins. Only those that did not come to
    hang together with it are compared with the bucket's other members, within tasks: first by their low bits,
    then, where these leave it open, by their full sets. Pairs within a component need no comparison, so no
    link between components is lost, and no bucket ever yields all its pairs.
    """
    links = find.confirmed(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    label = cut_lineage(components(links))
    held = cut_lineage(_labelled(members, label))
    cut = F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int")
    cells = cut_lineage(
        held.groupBy("key").agg(cut.alias("cuts"), F.count_if(F.col("label") != F.col("hub_label")).alias("r")).where("r > 0").select(F.col("key").alias("_k"), "cuts")
    )
    if cells.isEmpty():
        return label
    signed = in_blocks(held.drop("hub"), cells, "key", "node").join(find.classes.select(F.col("node").alias("_n"), "signature"), F.col("node") == F.col("_n")).drop("_n", "block")
    dealt = lambda df: df.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    suspects = cut_lineage(dealt(signed).mapInPandas(_suspects(find.worth, find.minima), "key long, lo int, hi int, node long, label long, hub_label long"))
    if suspects.isEmpty():
        return label
    sets = with_shingles(find.texts(suspects.select("node").distinct()), find.width).select(F.col("node").alias("_n"), "shingles")
    # Blocks were cut by rows; full sets are as long as the texts, so they are cut anew by shingles.
    sizes = find.classes.select(F.col("node").alias("_n"), "n_shingles")
    apart = suspects.withColumn("cell", F.xxhash64("key", "lo", "hi")).drop("key", "lo", "hi")
    weighed = apart.join(sizes, F.col("node") == F.col("_n")).groupBy(F.col("cell").alias("_k")).agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("cuts"))
    blocks = in_blocks(apart, cut_lineage(weighed), "cell", "node").withColumnRenamed("cell", "key").drop("block")
    rows = blocks.join(sets, F.col("node") == F.col("_n")).drop("_n")
    more = dealt(rows).mapInPandas(_verify(find.percent), "a long, b long")
    return cut_lineage(components(links.unionByName(cut_lineage(more))))


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    own = label.select(F.col("node").alias("_m"), F.col("label").alias("_x"))
    hub = label.select(F.col("node").alias("_h"), F.col("label").alias("_y"))
    return (
        members.join(own, F.col("node") == F.col("_m"), "left")
        .join(hub, F.col("hub") == F.col("_h"), "left")
        .select("key", "node", "hub", F.coalesce("_x", "node").alias("label"), F.coalesce("_y", "hub").alias("hub_label"))
    )


def near_duplicates(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    width: int = 5,
    percent: int = 80,
    shape: Bands = Bands(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Groups of documents whose shingle sets are alike: ``doc`` (carried columns), ``row`` (identity of id and
    text), ``n_shingles``, ``component_id`` (smallest id that links reach), ``kept`` (the id is that one), ``survivor``
    (``row`` of the group's first by id, nulls last, then ``row``; null for a text without words).

    Equal sets form a class, found by a 128-bit print of the set and combined before any shuffle of theirs;
    only classes meet in buckets. Candidates share a band of minima; what their packed low bits rule out is
    dropped; the others are confirmed on full sets of 64-bit shingle hashes.

    A text without words, or null, is linked with nothing and kept. Null ids never become a component's id
    unless it has no other; then it is null and its documents are kept. Rows that are equal in id and text
    belong to one class. A text of any length is cut whole into its set, within its row; sets that are compared meet in
    blocks of a bounded number of shingles. An empty table gives an empty result. Input columns travel inside ``doc``.
    """
    rows = docs.select(packed(carry).alias("doc"), F.col(doc_id).alias("_id"), identity(doc_id, text).alias("row"), text_or_empty(text).alias("_text"))
    signed = with_shingles(rows, width).withColumn("_s", _signer(shape)("shingles"))
    stored = cut_lineage(signed.select("doc", "_id", "row", F.size("shingles").cast("long").alias("n_shingles"), "_s.print", "_s.signature", "_s.bands"))
    return grouped(docs, stored, width, percent, shape, doc_id, text)


def grouped(docs: DataFrame, stored: DataFrame, width: int, percent: int, shape: Bands, doc_id: str, text: str) -> DataFrame:
    """Classes, buckets, links and components of the stored signatures, back on the documents."""
    first = F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("row").alias("r")))
    named = stored.where("print IS NOT NULL").groupBy("print").agg(first.alias("f"), F.first("signature").alias("signature"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles"))
    classes = cut_lineage(named.select("print", F.col("f.i").alias("least_id"), F.col("f.r").alias("row"), "signature", "bands", "n_shingles").withColumn("node", F.monotonically_increasing_id()))
    keys = classes.select("node", F.explode("bands").alias("key"))
    buckets = cut_lineage(keys.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("_k"), "hub"))
    members = cut_lineage(keys.join(buckets, F.col("key") == F.col("_k")).select("key", "node", "hub"))
    label = _connect(_Finder(docs, classes, text, doc_id, width, percent, shape), members)
    joined = cut_lineage(label.join(classes.select("node", "least_id", "row"), "node"))
    least = joined.groupBy("label").agg(F.min(F.struct(F.col("least_id").isNull().alias("n"), F.col("least_id").alias("i"), F.col("row").alias("r"))).alias("_f"))
    linked = joined.join(least, "label").select(F.col("node").alias("_n"), F.col("_f.i").alias("_c"), F.col("_f.r").alias("_r"))
    ids = cut_lineage(
        classes.select("print", "node", "least_id", "row").join(linked, F.col("node") == F.col("_n"), "left")
        .select(F.col("print").alias("_p"), F.coalesce("_c", "least_id").alias("component_id"), F.coalesce("_r", "row").alias("survivor"))
    )
    return (
        stored.select("doc", "_id", "row", "n_shingles", "print").join(ids, F.col("print") == F.col("_p"), "left")
        .withColumn("component_id", F.when(F.col("print").isNull(), F.col("_id")).otherwise(F.col("component_id")))
        .select("doc", "row", "n_shingles", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"), "survivor")
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns as they came, less all but one of each group.

    A group's survivor is one row, also where ids are shared or null. The rows to go are a small table beside the texts;
    rows that are equal in id and text, if there are any, are looked at by themselves, and one of them stays. Documents
    without words, null texts among them, all stay but for such equal rows. An empty table stays empty.
    """
    found = cut_lineage(near_duplicates(docs, (), width, percent).select("row", "survivor"))
    gone = cut_lineage(found.where("row <> survivor").select(F.col("row").alias("_row")).distinct())
    again = cut_lineage(found.where("row = survivor").groupBy("row").count().where("count > 1").select("row"))
    keyed = docs.select(packed(docs.columns).alias("doc"), identity("doc_id", "text").alias("row"))
    marked = with_bitmap(keyed, "row", gone, "_maybe")
    left = marked.where("NOT _maybe").drop("_maybe").unionByName(marked.where("_maybe").drop("_maybe").join(gone, F.col("row") == F.col("_row"), "left_anti"))
    if again.isEmpty():
        return unpacked(left, docs.columns)
    repeated = left.join(again, "row", "left_semi").groupBy("row").agg(F.min("doc").alias("doc"))
    once = left.join(again, "row", "left_anti").select("row", "doc")
    return unpacked(once.unionByName(repeated.select("row", "doc")), docs.columns)
