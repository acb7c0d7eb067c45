"""Row-set operators with the null and ordering rules of the library's tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators.ordered import same_keys

BATCH_COLUMN = "batch_id"


def keep_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns the table has, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def drop_batch(df: DataFrame) -> DataFrame:
    """P12."""
    return df.drop(BATCH_COLUMN)


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    """P5: NULL never matches."""
    return df.where(F.col(column) == F.lit(value))


def filter_isin(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """P6."""
    return df.where(F.col(column).isin(list(values)))


def filter_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL or NaN."""
    return df.dropna(how="any", subset=list(columns))


def filter_range(df: DataFrame, column: str, ge=None, le=None) -> DataFrame:
    """Inclusive bounds, either optional; NULL and NaN fall outside any bound."""
    if ge is None and le is None:
        return df
    value = F.col(column)
    inside = F.lit(True)
    if ge is not None:
        inside = inside & (value >= F.lit(ge))
    if le is not None:
        inside = inside & (value <= F.lit(le))
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        inside = inside & ~F.isnan(value)
    return df.where(inside)


def derive(df: DataFrame, out: str, fn: Callable, inputs: Sequence[str], returns: T.DataType | str) -> DataFrame:
    """A column from an opaque Python function of a row, fed only the named inputs.

    For functions no column expression can state; rows travel to Python in Arrow batches.
    """
    names = list(inputs)

    def call(*values):
        return fn(dict(zip(names, values)))

    wrapped = F.udf(call, returns, useArrow=True)
    return df.withColumn(out, wrapped(*[F.col(c) for c in names]))


def filter_rows(df: DataFrame, fn: Callable, inputs: Sequence[str]) -> DataFrame:
    """Rows for which an opaque Python predicate holds."""
    return derive(df, "_keep", fn, inputs, T.BooleanType()).where("_keep").drop("_keep")


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, columns matched by name, missing ones NULL."""
    if not tables:
        raise ValueError("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order_by``, which must be a total order."""
    return top_per_key(df, keys, order_by, 1)


def top_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key.

    Spark limits every key to ``k`` rows before the exchange as well, so a hot key stays small.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """O2."""
    return df.orderBy(*order_by).limit(k)


def group_agg(df: DataFrame, by: Sequence[str], aggs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """A1: named aggregates ``{out: (column, function)}``; the NULL group is kept.

    ``first``/``last`` take ``column@order`` and pick by that order, skipping NULL values.

    Exact distinct counts are computed apart from the rest: together they would carry the state of every
    other aggregate through a shuffle of all distinct values.
    """
    def part(items) -> DataFrame:
        return df.groupBy(*by).agg(*[_aggregate(column, fn).alias(out) for out, (column, fn) in items])

    distinct = [(out, spec) for out, spec in aggs.items() if spec[1] == "count_distinct"]
    others = [(out, spec) for out, spec in aggs.items() if spec[1] != "count_distinct"]
    if not distinct or not others:
        return part(aggs.items())
    joined = part(others)
    for item in distinct:
        keyed = part([item]).withColumnsRenamed({k: f"_k_{k}" for k in by})
        joined = joined.join(keyed, same_keys(by, [f"_k_{k}" for k in by]))
    return joined.select(*by, *aggs)


def _aggregate(column: str, fn: str) -> Column:
    if fn in ("first", "last"):
        value, _, order = column.partition("@")
        if not order:
            raise ValueError(f"{fn} needs an order, as in 'value@order'")
        pick = F.min_by if fn == "first" else F.max_by
        return pick(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))
    functions = {
        "sum": F.sum,
        "count": F.count,
        "count_distinct": F.count_distinct,
        "avg": F.avg,
        "min": F.min,
        "max": F.max,
    }
    if fn not in functions:
        raise ValueError(f"unknown aggregate {fn!r}; known: {sorted([*functions, 'first', 'last'])}")
    return functions[fn](F.col(column))


def occurrence_count(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Rows per key, one row per key, combined map-side."""
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def two_sides(df: DataFrame, sides: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One row per side of each input row, in a single scan."""
    rows = [F.struct(*[expr.alias(name) for name, expr in side.items()]) for side in sides]
    return df.select(F.inline(F.array(*rows)))
