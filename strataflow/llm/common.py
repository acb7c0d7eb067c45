"""Words, text and pass-through helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import cut_lineage

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Fixed by the contract of the queries: what stands between words.
BLANKS = "[\\x20\\x09-\\x0D]+"


#: Rows that go to Python at once; texts may be long, and executors hold a batch on both sides.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """Bound the rows of a batch that goes to Python, for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def text_or_empty(text: str | Column) -> Column:
    """The text; a null text reads as an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("string")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` is the fast way where a text holds nothing but ASCII."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_LOWER))


def split_words(text: Column, between: str = BLANKS) -> Column:
    """All words of the text, in order; no empty ones."""
    return F.array_remove(F.split(text, between, -1), "")


def fraction(hashed: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1, fine enough for any share of any table."""
    return hashed.cast("double") / F.lit(2.0**64) + 0.5


def packed(columns: Sequence[str]) -> Column:
    """The named columns as one struct, out of the way of the operator's own names.

    Without any, the struct holds one null, since Spark knows no empty struct in a file.
    """
    if not columns:
        return F.struct(F.lit(None).cast("string").alias("nothing"))
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def unpacked(df: DataFrame, columns: Sequence[str], *more: str | Column, struct: str = "doc") -> DataFrame:
    """The columns put away by ``packed``, and more of the operator's own."""
    return df.select(*[F.col(f"{struct}.`{c}`").alias(c) for c in columns], *more)


#: Bits of a key bitmap: 1 MB, whatever the number of keys.
BITMAP_BITS = 1 << 23


def with_bitmap(df: DataFrame, key: str, keys: DataFrame, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: false only if the row's key is surely none of ``keys`` (one binary column).

    The keys are hashed into a bitmap of fixed size, which is broadcast; so rows that surely have no partner
    need not be shuffled for a join.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAP_BITS)) + 1
    maps = cut_lineage(
        keys.select(place(F.col(keys.columns[0])).alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_map"))
    )
    bit = F.bitmap_bit_position(place(F.col(key)))
    byte = F.conv(F.hex(F.substring(F.col("_map"), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(_byte, _bit & 7) & 1") == 1
    return (
        df.withColumn("_b", F.bitmap_bucket_number(place(F.col(key))))
        .join(F.broadcast(maps), F.col("_b") == F.col("_bucket"), "left")
        .withColumn("_byte", F.coalesce(byte, F.lit(0)))
        .withColumn("_bit", bit.cast("int"))
        .withColumn(out, hit)
        .drop("_b", "_bucket", "_map", "_byte", "_bit")
    )


def sorted_groups(batches, columns: Sequence[str]):
    """Batches of rows sorted by some columns, cut anew so that rows of equal values stay together."""
    import numpy as np
    import pandas as pd

    held: list = []
    for batch in batches:
        if not len(batch):
            continue
        code = batch[list(columns)].to_numpy()
        if held and (held[-1][list(columns)].to_numpy()[-1] != code[0]).any():
            yield pd.concat(held)
            held = []
        change = np.flatnonzero((code[1:] != code[:-1]).any(1))
        if len(change):
            cut = change[-1] + 1
            yield pd.concat([*held, batch[:cut]])
            held, batch = [], batch[cut:]
        held.append(batch)
    if held:
        yield pd.concat(held)


def in_blocks(rows: DataFrame, cells: DataFrame, key: str, node: str) -> DataFrame:
    """``rows`` dealt out as pairs of blocks of their key: columns ``block, lo, hi`` are added.

    ``cells`` says into how many blocks (``cuts``) the rows of a key (``_k``) are cut; a row goes to every pair
    of blocks that its own is part of, so that no task needs more than two blocks of a key at once.
    """
    cut = rows.join(cells, F.col(key) == F.col("_k")).withColumn("block", F.pmod(F.xxhash64(node), F.col("cuts")).cast("int"))
    other = cut.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return other.withColumn("lo", F.least("block", "_o")).withColumn("hi", F.greatest("block", "_o")).drop("_k", "_o", "cuts")
