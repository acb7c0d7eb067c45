"""Hashes used for change detection, identity and masking."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The digests depend on them.
HASH_SEPARATOR = "␟"
HASH_NULL = "<NULL>"
TOKEN_PREFIX = "pii_"
TOKEN_LENGTH = 8


def _hash_text(df: DataFrame, name: str) -> Column:
    """Text of a value inside a row hash; two different values never share a text."""
    value = F.col(f"`{name}`")
    text = value.cast("string")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        # Whole-number magnitudes that Spark would print with an exponent are printed plainly.
        plain = F.rtrim(value.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
        plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
        text = F.when((F.abs(value) >= 1e7) & (F.abs(value) < 1e16), plain).otherwise(text)
    return F.coalesce(text, F.lit(HASH_NULL))


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """md5 over the listed columns; NULL has its own marker, so it differs from the empty string."""
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[_hash_text(df, c) for c in columns]))


def with_row_hash(df: DataFrame, columns: Sequence[str], hash_column: str = "row_hash") -> DataFrame:
    """``df`` with the md5 of its tracked columns."""
    return df.withColumn(hash_column, row_hash(df, columns))


def token(value: Column, salt: str, length: int = TOKEN_LENGTH) -> Column:
    """salted token of a value; NULL and NaN stay NULL, the empty string does not."""
    if not salt:
        raise ValueError("an empty salt would make the tokens reversible")
    digest = F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)
    return F.when(value.isNotNull(), F.concat(F.lit(TOKEN_PREFIX), F.substring(digest, 1, length)))


def tokenize_columns(df: DataFrame, columns: Sequence[str], salt: str, length: int = TOKEN_LENGTH) -> DataFrame:
    """F8: replace the listed columns by tokens; columns the table lacks are passed over."""
    if not salt:
        raise ValueError("an empty salt would make the tokens reversible")
    replaced = {}
    for name in columns:
        if name not in df.columns:
            continue
        value = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        replaced[name] = token(value, salt, length)
    return df.withColumns(replaced) if replaced else df


def schema_hash(columns: DataFrame, by: Sequence[str] = (), out: str = "schema_hash") -> DataFrame:
    """md5 of the sorted ``name:type`` lines of a (name, type) table, per group if asked.

    A table has at most some thousand columns, so the list collected per group is small.
    """
    line = F.concat_ws(":", F.col("name"), F.col("type"))
    digest = F.md5(F.array_join(F.sort_array(F.collect_list(line)), "\n"))
    return columns.groupBy(*by).agg(digest.alias(out))


def content_fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """S8 at table grain: row count and a digest that ignores the order of rows and columns, in one aggregate.

    The sum is kept next to the xor so that a pair of equal rows does not cancel out.
    """
    names = sorted(c for c in df.columns if c not in by)
    values = [F.col(f"`{c}`") for c in names]
    # The hash passes over NULLs, so where they are is hashed along.
    row = F.xxhash64(*values, *[v.isNull() for v in values])
    return (
        df.select(*by, row.alias("_row"))
        .groupBy(*by)
        .agg(
            F.count("*").alias("row_count"),
            F.bit_xor("_row").alias("_xor"),
            F.sum(F.col("_row").cast("decimal(38,0)")).alias("_sum"),
        )
        .select(
            *by,
            "row_count",
            F.md5(
                F.concat_ws(
                    "|",
                    F.lit(",".join(names)),
                    F.col("row_count").cast("string"),
                    F.coalesce(F.col("_xor").cast("string"), F.lit("-")),
                    F.coalesce(F.col("_sum").cast("string"), F.lit("-")),
                )
            ).alias("fingerprint"),
        )
    )


def fingerprint_parts(names: Sequence[str], counted: Column) -> list[Column]:
    """The three aggregates of :func:`content_fingerprint` over the rows that are ``counted``: count, xor and sum."""
    values = [F.col(f"`{c}`") for c in sorted(names)]
    row = F.when(counted, F.xxhash64(*values, *[v.isNull() for v in values]))
    return [F.count_if(counted), F.bit_xor(row), F.sum(row.cast("decimal(38,0)"))]


def fingerprint_of(names: Sequence[str], count: int, xor: int | None, total) -> str:
    """The fingerprint that :func:`content_fingerprint` gives, from its aggregates."""
    parts = [",".join(sorted(names)), str(count), *("-" if x is None else str(x) for x in (xor, total))]
    return hashlib.md5("|".join(parts).encode()).hexdigest()
