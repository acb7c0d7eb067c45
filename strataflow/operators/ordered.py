"""Ordered computations (numbering, frames over rows, carrying values forward).

Each comes in two shapes. Where no key holds more than ``hot_limit`` rows, it is one window over the
key. Beyond that the rows are range-partitioned by key *and* order, so a hot key spreads over many
tasks, and what a task needs from its predecessors is a few rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.session import cut_lineage

# Rows of one key that a single task may hold in a window.
HOT_LIMIT = 5_000_000

# Rows that are numbered by one task; more are spread over range slices first.
ONE_TASK_ROWS = 200_000

SLICE = "_slice"


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """NULL-safe equality of two key lists."""
    condition = F.lit(True)
    for i, (a, b) in enumerate(zip(left, right)):
        equal = F.col(a).eqNullSafe(F.col(b))
        condition = equal if i == 0 else condition & equal
    return condition


# Rows of a range slice, unless the shuffle setting asks for more slices than that.
SLICE_ROWS = 5_000_000


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the most frequent key and of all; only the key columns are scanned, counts combine map-side."""
    row = df.groupBy(*keys).count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    return row["most"] or 0, row["rows"] or 0


def range_slices(df: DataFrame, order_by: Sequence[Column], rows: int, numbered: str | None = None) -> DataFrame:
    """Spread so many rows over tasks by global order and store the task number with each row.

    The number of slices follows the rows. Range bounds come from a sample, so the result is stored once and
    never recomputed. ``numbered`` adds each row's place within its slice, from 1, without another exchange:
    the low 33 bits of Spark's increasing id count the rows of a task.
    """
    slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2, -(-rows // SLICE_ROWS))
    ranged = df.repartitionByRange(slices, *order_by)
    if numbered:
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
        ranged = ranged.sortWithinPartitions(*order_by).withColumn(numbered, place)
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))


def _rows_before(sliced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a key in earlier slices, for keys that continue from one slice into the next.

    A slice continues at most one key of its predecessors, so this has at most one row per slice.
    """
    earlier = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    return (
        sliced.groupBy(SLICE, *keys)
        .count()
        .withColumn("_before", F.sum("count").over(earlier))
        .where("_before > 0")
        .select(F.col(SLICE).alias("_s"), *renamed, "_before")
    )


def _number_slices(sliced: DataFrame, keys: Sequence[str], order_by: Sequence[Column], out: str) -> DataFrame:
    within = W.partitionBy(SLICE, *keys).orderBy(*order_by)
    local = sliced.withColumn("_local", F.row_number().over(within))
    before = F.broadcast(_rows_before(sliced, keys))
    on = (F.col(SLICE) == F.col("_s")) & same_keys(keys, [f"_k{i}" for i in range(len(keys))])
    kept = [c for c in sliced.columns if c != SLICE]
    number = (F.col("_local") + F.coalesce(F.col("_before"), F.lit(0))).cast("long")
    return local.join(before, on, "left").select(*kept, number.alias(out))


def dense_number(
    df: DataFrame,
    order_by: Sequence[Column],
    out: str,
    start: int = 1,
    rows: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Consecutive integers in global order; only a counted, small set passes through one task.

    ``order_by`` must be a total order; ``rows`` is the row count where the caller knows it.
    """
    rows = df.count() if rows is None else rows
    if rows <= one_task_rows:
        alone = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order_by))
        return df.withColumn(out, (alone + (start - 1)).cast("long"))
    sliced = range_slices(df, order_by, rows, numbered="_local")
    sizes = sliced.groupBy(SLICE).count().orderBy(SLICE).collect()  # one row per slice
    offsets, total = [], start - 1
    for row in sizes:
        offsets.append((row[SLICE], total))
        total += row["count"]
    table = F.broadcast(df.sparkSession.createDataFrame(offsets, "_s int, _offset long"))
    return (
        sliced.join(table, F.col(SLICE) == F.col("_s"))
        .select(*df.columns, (F.col("_local") + F.col("_offset")).cast("long").alias(out))
    )


def row_number_by(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    out: str,
    hot_limit: int = HOT_LIMIT,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Position of each row within its key. ``order_by`` must be a total order within a key.

    ``sizes`` are those of :func:`group_sizes`, where the caller knows them.
    """
    most, rows = sizes or group_sizes(df, keys)
    if most <= hot_limit:
        return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)).cast("long"))
    sliced = range_slices(df, [*[F.col(k).asc() for k in keys], *order_by], rows)
    return _number_slices(sliced, keys, order_by, out)


def _framed(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], reach: int, hot_limit: int
) -> tuple[DataFrame, list[str], list[Column]]:
    """Rows with the window partitioning that lets a frame look ``reach`` rows back.

    A hot key is cut into blocks of consecutive rows; the last ``reach`` rows of a block are repeated
    at the head of the next one and marked, to be dropped once the window has been computed.
    """
    sizes = group_sizes(df, keys)
    if sizes[0] <= hot_limit:
        plain = df.withColumn("_halo", F.lit(False))
        plain = plain.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)).cast("long"))
        return plain, list(keys), list(order_by)
    numbered = row_number_by(df, keys, order_by, "_rn", hot_limit, sizes)
    size = max(hot_limit, reach, 1)
    block = F.floor((F.col("_rn") - 1) / size)
    at = (F.col("_rn") - 1) % size
    own = F.struct(block.alias("b"), F.lit(False).alias("h"))
    onward = F.struct((block + 1).alias("b"), F.lit(True).alias("h"))
    copies = F.when(at >= size - reach, F.array(own, onward)).otherwise(F.array(own))
    cut = numbered.withColumn("_copy", F.explode(copies)).withColumn("_block", F.col("_copy.b"))
    cut = cut.withColumn("_halo", F.col("_copy.h")).drop("_copy")
    return cut, [*keys, "_block"], [F.col("_rn").asc()]


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    value: str,
    rows: int,
    out: str,
    count_out: str | None = None,
    number_out: str | None = None,
    hot_limit: int = HOT_LIMIT,
) -> DataFrame:
    """Mean of the last ``rows`` rows of a key, NULLs skipped, defined from the first row on.

    ``count_out`` receives the rows in the frame, ``number_out`` the position within the key.
    """
    framed, parts, order = _framed(df, keys, order_by, rows - 1, hot_limit)
    frame = W.partitionBy(*parts).orderBy(*order).rowsBetween(1 - rows, 0)
    extra = []
    if count_out:
        extra.append(F.least(F.col("_rn"), F.lit(rows)).cast("int").alias(count_out))
    if number_out:
        extra.append(F.col("_rn").alias(number_out))
    mean = framed.withColumn("_mean", F.avg(value).over(frame))
    return mean.where(~F.col("_halo")).select(*df.columns, F.col("_mean").alias(out), *extra)


def previous_value(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], value: str, out: str, hot_limit: int = HOT_LIMIT
) -> DataFrame:
    """The value one row earlier within the key."""
    framed, parts, order = _framed(df, keys, order_by, 1, hot_limit)
    lagged = framed.withColumn("_lag", F.lag(value).over(W.partitionBy(*parts).orderBy(*order)))
    return lagged.where(~F.col("_halo")).select(*df.columns, F.col("_lag").alias(out))


def carry_forward(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str, out: str, hot_limit: int = HOT_LIMIT
) -> DataFrame:
    """The latest non-NULL value of a key at or before each row, in ascending ``order_by``."""
    ascending = [F.col(c).asc() for c in order_by]
    most, rows = group_sizes(df, keys)
    if most <= hot_limit:
        seen = W.partitionBy(*keys).orderBy(*ascending).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(seen))
    sliced = range_slices(df, [*[F.col(k).asc() for k in keys], *ascending], rows)
    seen = W.partitionBy(SLICE, *keys).orderBy(*ascending).rowsBetween(W.unboundedPreceding, 0)
    local = sliced.withColumn("_local", F.last(value, ignorenulls=True).over(seen))

    # Last value of a key in a slice, handed on to the slices where the key continues: one row per slice.
    position = F.when(F.col(value).isNotNull(), F.struct(*order_by))
    earlier = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    handed = (
        sliced.groupBy(SLICE, *keys)
        .agg(F.max_by(value, position).alias("_tail"))
        .withColumn("_handed", F.last("_tail", ignorenulls=True).over(earlier))
        .where("_handed is not null")
        .select(F.col(SLICE).alias("_s"), *renamed, "_handed")
    )
    on = (F.col(SLICE) == F.col("_s")) & same_keys(keys, [f"_k{i}" for i in range(len(keys))])
    return local.join(F.broadcast(handed), on, "left").select(
        *df.columns, F.coalesce("_local", "_handed").alias(out)
    )


def greatest_before(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str, out: str, hot_limit: int = HOT_LIMIT
) -> DataFrame:
    """The greatest value of a key in the rows before each row, in ascending ``order_by``; NULL for the first."""
    ascending = [F.col(c).asc() for c in order_by]
    most, rows = group_sizes(df, keys)
    if most <= hot_limit:
        before = W.partitionBy(*keys).orderBy(*ascending).rowsBetween(W.unboundedPreceding, -1)
        return df.withColumn(out, F.max(value).over(before))
    sliced = range_slices(df, [*[F.col(k).asc() for k in keys], *ascending], rows)
    before = W.partitionBy(SLICE, *keys).orderBy(*ascending).rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    # Greatest value of a key in earlier slices, for the slices where the key continues: one row per slice.
    handed = (
        sliced.groupBy(SLICE, *keys)
        .agg(F.max(value).alias("_most"))
        .withColumn("_handed", F.max("_most").over(earlier))
        .where("_handed is not null")
        .select(F.col(SLICE).alias("_s"), *renamed, "_handed")
    )
    on = (F.col(SLICE) == F.col("_s")) & same_keys(keys, [f"_k{i}" for i in range(len(keys))])
    local = sliced.withColumn("_local", F.max(value).over(before))
    return local.join(F.broadcast(handed), on, "left").select(*df.columns, F.greatest("_local", "_handed").alias(out))
