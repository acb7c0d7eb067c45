"""Type tags and lenient coercion of text to declared types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.scalars import as_date

TYPE_TAGS: dict[str, T.DataType] = {
    "int": T.LongType(),
    "long": T.LongType(),
    "float": T.DoubleType(),
    "string": T.StringType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}

# Texts that stand for a missing value in delimited files.
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def struct_type(schema: Mapping[str, str]) -> T.StructType:
    """Spark schema of a column -> tag mapping."""
    return T.StructType([T.StructField(name, _type_of(tag)) for name, tag in schema.items()])


def _type_of(tag: str) -> T.DataType:
    if tag not in TYPE_TAGS:
        raise ValueError(f"unknown type tag {tag!r}; known: {sorted(TYPE_TAGS)}")
    return TYPE_TAGS[tag]


def coerce_value(value: Column, tag: str, source_type: T.DataType) -> Column:
    """``value`` in the type of ``tag``; what does not fit becomes NULL."""
    target = _type_of(tag)
    if source_type == target:
        return value
    if isinstance(target, T.LongType):
        # Exact for whole numbers of any size, then by way of a double for texts such as '1.0'.
        whole = value.try_cast("double")
        fits = (whole == F.floor(whole)) & (F.abs(whole) < 9.2e18)
        return F.coalesce(_whole_text(value, source_type), F.when(fits, whole.try_cast("long")))
    if isinstance(target, T.DateType) and isinstance(source_type, T.StringType):
        return as_date(value)
    return value.try_cast(target)


def _whole_text(value: Column, source_type: T.DataType) -> Column:
    if isinstance(source_type, (T.DoubleType, T.FloatType)):
        return F.lit(None).cast("long")
    return value.try_cast("long")


def coerce(df: DataFrame, schema: Mapping[str, str], na_values: Sequence[str] = ()) -> DataFrame:
    """Cast the declared columns the table has; keep the others as they are."""
    tokens = list(dict.fromkeys([*MISSING_TOKENS, *na_values]))
    for tag in schema.values():
        _type_of(tag)
    out = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            value = F.when(~value.isin(tokens), value)
        if field.name in schema:
            value = coerce_value(value, schema[field.name], field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)
