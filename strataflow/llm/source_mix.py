"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.llm.common import packed, split_words, text_or_empty, unpacked
from strataflow.operators.ordered import dense_number
from strataflow.session import cut_lineage

WEIGHTS = (5, 2, 1)
BUDGET = 1.5  # of all sizes
MAX_EPOCHS = 2
ROWS_PER_SLICE = 5_000  # of one source, as long as there are no more than HASH_SLICES slices
HASH_SLICES = 65_536
ROWS_PER_TASK = 200_000  # of the merged queues


def word_count(text: str = "text") -> Column:
    return F.size(split_words(text_or_empty(text))).cast("long")


def _shuffle_key(doc_id: str, text: str) -> Column:
    """A document's place in its source's shuffle; equal documents with equal ids have equal places."""
    return F.md5(F.concat_ws("\x1f", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), text_or_empty(text)))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, most: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` for rows of ``source, size``.

    Sources in order of their code points, null last, take the weights in turn and share ``budget`` times all
    sizes; none gets more than ``most`` times its own size, and what is left over goes to the others by weight,
    again and again until none is above. Only two sums per round reach the driver, and they are whole numbers.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = dense_number(cut_lineage(totals), [F.col("source").asc_nulls_last()], "_n", start=0)
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int"))
    table = cut_lineage(numbered.select("source", "source_size", turn.cast("long").alias("weight")))
    want = (table.agg(F.sum("source_size")).first()[0] or 0) * budget
    level, capped = None, F.lit(False)
    while True:
        row = table.agg(F.sum(F.when(capped, F.col("source_size"))), F.sum(F.when(~capped, F.col("weight")))).first()
        full, open_weight = row[0] or 0, row[1] or 0
        now = (want - most * full) / open_weight if open_weight else level
        if now is None or now == level:
            break
        level = now
        capped = F.col("source_size") * most <= F.lit(level) * F.col("weight")
    share = F.lit(0.0 if level is None else float(level)) * F.col("weight")
    return table.select("source", "source_size", F.least((F.col("source_size") * most).cast("double"), share).alias("target"))


def _in_order(units: DataFrame, slices: DataFrame) -> DataFrame:
    """``before``: size of everything in the same source that comes first in its shuffle, the unit included.

    A source is cut into slices of its hash range, so that a large source is ordered by many tasks.
    """
    place = F.conv(F.substring("h", 1, 4), 16, 10).cast("long")
    sliced = units.join(slices.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).withColumn(
        "_slice", F.floor(place * F.col("n_slices") / HASH_SLICES)
    )
    sliced = cut_lineage(sliced.drop("_s", "n_slices"))
    earlier = W.partitionBy("source").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    sums = cut_lineage(
        sliced.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
        .select(F.col("source").alias("_s"), F.col("_slice").alias("_k"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    )
    own = F.sum("size").over(W.partitionBy("source", "_slice").orderBy("h"))
    return (
        sliced.withColumn("_own", own)
        .join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_k")))
        .withColumn("before", F.col("_own") + F.col("_offset"))
        .drop("_s", "_k", "_own", "_offset", "_slice")
    )


def _last_places(entries: DataFrame, budget: float, rows: int) -> DataFrame:
    """Per source and epoch, the last place in its shuffle that a mix of ``budget`` words still takes.

    Entries are sorted by virtual finish time over many tasks and stored; one sum per task tells in which
    slice the budget ends, and only that slice is summed row by row.
    """
    order = [F.col("finish"), F.col("epoch"), F.col("h"), F.col("source").asc_nulls_last()]
    slices = max(1, -(-rows * MAX_EPOCHS // ROWS_PER_TASK))
    ranged = cut_lineage(entries.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()))
    before, last = 0, -1
    for row in ranged.groupBy("_slice").agg(F.sum("size").alias("n")).orderBy("_slice").collect():  # one row per task
        last = row["_slice"]
        if before + row["n"] > budget:
            break
        before += row["n"]
    else:
        last += 1
    upto = F.sum("size").over(W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    taken = ranged.where(F.col("_slice") < last).drop("_slice").unionByName(
        ranged.where(F.col("_slice") == last).withColumn("_upto", upto + before).where(F.col("_upto") <= budget).drop("_upto", "_slice")
    )
    return taken.groupBy("source").agg(*[F.max(F.when(F.col("epoch") == e, F.col("h"))).alias(f"_last{e}") for e in range(MAX_EPOCHS)])


def mix_sources(docs: DataFrame, carry: Sequence[str] = ("doc_id",), doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """How often the mix takes every document: ``doc`` (carried columns), ``size, source_size, target, copies, taken``.

    Every source is a queue of its documents in the order of a hash, twice over; a document finishes at the
    words of its queue up to and with it over the queue's target. All queues are merged by finish time until
    the budget is used; equal finish times go by epoch, hash and source. As the merge takes a prefix of each queue, one hash per source and epoch tells for any
    document whether it is taken, so texts are never shuffled: what moves is a hash and a size per document.

    A null text has size 0; a document of size 0 takes no words and stays in (``copies`` 1) without using any
    budget. Null sources form one source, the last. Equal rows (id and text) are taken together or not at
    all. An empty table gives an empty result. Input columns travel inside ``doc``.
    """
    rows = docs.select(
        packed(carry).alias("doc"),
        F.col(source).cast("string").alias("source"),
        _shuffle_key(doc_id, text).alias("h"),
        word_count(text).alias("size"),
    )
    units = cut_lineage(rows.groupBy("source", "h").agg(F.sum("size").alias("size")))
    targets = cut_lineage(source_targets(units))
    slices = cut_lineage(units.groupBy("source").count().select("source", F.least(F.lit(HASH_SLICES), F.ceil(F.col("count") / ROWS_PER_SLICE)).cast("long").alias("n_slices")))
    row = targets.agg(F.sum("source_size")).first()
    budget, count = BUDGET * (row[0] or 0), units.count()
    named = targets.withColumnRenamed("source", "_s")
    same = F.col("source").eqNullSafe(F.col("_s"))
    entries = (
        _in_order(units.where("size > 0"), slices)
        .join(named, same)
        .withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(MAX_EPOCHS)])))
        .withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("before")) / F.col("target"))
        .select("source", "h", "size", "epoch", "finish")
    )
    places = cut_lineage(_last_places(entries, budget, count).withColumnRenamed("source", "_s"))
    taken = sum((F.coalesce((F.col("h") <= F.col(f"_last{e}")).cast("long"), F.lit(0).cast("long")) for e in range(MAX_EPOCHS)), F.lit(0).cast("long"))
    return (
        rows.join(named, same, "left").drop("_s")
        .join(places, same, "left")
        .withColumn("copies", F.when(F.col("size") == 0, F.lit(1).cast("long")).otherwise(taken))
        .withColumn("taken", F.col("size") * taken)
        .select("doc", "source", "size", "source_size", "target", "copies", "taken")
    )


def apply_mix(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, all columns as they came."""
    mixed = mix_sources(docs, docs.columns)
    again = mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return unpacked(again, docs.columns)
