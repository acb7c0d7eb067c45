"""Scans of raw files and the load job of a declared source."""

from __future__ import annotations

import hashlib
import urllib.parse
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.hashing import content_fingerprint, fingerprint_of, fingerprint_parts
from strataflow.sources.catalogue import Source
from strataflow.sources.records import quoted_records, scan_quotes
from strataflow.sources.schema import coerce


MALFORMED = "_malformed"
_END = "\u0001end"  # stands behind the last value of a marked text
_FORM = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
CHUNK_BYTES = 8 << 20


def read_csv(spark: SparkSession, path: str, schema: Mapping[str, str] | None = None, na_values: Sequence[str] = (), multiline: bool = True) -> DataFrame:
    """A CSV with a header, read as text and coerced leniently.

    Rows with more values than the header are not among these; :func:`csv_parts` has them too.
    """
    return csv_parts(spark, path, schema, na_values, multiline)[0]


def csv_parts(
    spark: SparkSession, path: str, schema: Mapping[str, str] | None = None, na_values: Sequence[str] = (), multiline: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV, and apart from them the text of those rows that hold more values than the header."""
    return parted(csv_rows(spark, path, schema, na_values, multiline))


def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit, and the ``malformed`` text of those that do not."""
    return rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED), rows.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("malformed"))


def csv_rows(
    spark: SparkSession, path: str, schema: Mapping[str, str] | None = None, na_values: Sequence[str] = (), multiline: bool = True
) -> DataFrame:
    """The coerced columns of a CSV and ``_malformed``, the whole text of a row that holds more values than the header.

    A row with fewer values is filled with NULLs. No value is dropped: a row that does not fit is set aside whole.
    Line breaks inside quotes are part of the value, however large the file: where a scan for quotes finds any, records
    are cut by :mod:`strataflow.sources.records`, else Spark's own reader takes lines for records. ``multiline=False``
    saves that scan where the vendor warrants that no value holds a line break. A quote that the file never closes
    raises.
    """
    options = {"header": True, **_FORM}
    names = spark.read.options(multiLine=True, **options).csv(path).columns
    cells = [f"_{i}" for i in range(len(names))]
    scan = scan_quotes(spark, path) if multiline else None
    if scan is None or not scan.breaks:
        whole = T.StructType([T.StructField(c, T.StringType()) for c in (*cells, MALFORMED)])
        reader = spark.read.options(columnNameOfCorruptRecord=MALFORMED, enforceSchema=True, columnPruning=False, **options)
        raw = reader.schema(whole).csv(path)
    else:
        kinds = ", ".join(f"{c} string" for c in (*cells, MALFORMED))
        # A record is one value here, and `multiLine` leaves the line breaks inside it as they are.
        parsed = F.from_csv("value", kinds, {**_FORM, "multiLine": "true", "columnNameOfCorruptRecord": MALFORMED})
        raw = quoted_records(spark, path, scan).where("kind <> 'header'").select(parsed.alias("r")).select("r.*")
    # Spark also marks rows that are too short. A sign behind the last value tells them apart: where the row is too
    # long, it is found neither in the header's columns nor right behind them. Empty values at the end are no values.
    signed = F.concat(F.regexp_replace(MALFORMED, "[,\\r\\n]+$", ""), F.lit(f",{_END}"))
    again = F.from_csv(signed, ", ".join(f"_{i} string" for i in range(len(names) + 1)), {**_FORM, "multiLine": "true"})
    short = F.exists(F.array(*[again[f"_{i}"] for i in range(len(names) + 1)]), lambda c: F.coalesce(c.endswith(_END), F.lit(False)))
    # Spark refuses to read the marked text alone, so the condition looks at a column beside it, which changes nothing.
    beside = F.length(F.substring(F.coalesce(cells[0], F.lit("")), 1, 0)) == 0
    aside = F.when(F.col(MALFORMED).isNotNull() & ~F.coalesce(short, F.lit(False)) & beside, F.col(MALFORMED))
    named = raw.select(*[F.col(c).alias(n) for c, n in zip(cells, names)], aside.alias(MALFORMED))
    return coerce(named, schema or {}, na_values)  # a malformed text is none of the texts that stand for a missing value


def read_parquet(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    """S3: a Parquet file or directory; with ``base_path`` partition columns come along.

    Partition values stay text: a batch id that looks like a date must not turn into one.
    """
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    found = reader.parquet(path)
    stored = {f.name for f in spark.read.option("recursiveFileLookup", "true").parquet(path).schema}
    named = [f for f in found.schema if f.name not in stored]
    if all(isinstance(f.dataType, T.StringType) for f in named):
        return found
    texts = T.StructType([T.StructField(f.name, T.StringType()) if f in named else f for f in found.schema])
    return reader.schema(texts).parquet(path)


def read_raw(spark: SparkSession, source: Source, raw_root: str) -> DataFrame:
    """The declared source in its declared format, with ``_malformed``: the text of a row that does not fit, else NULL."""
    path = source.path(raw_root)
    if source.format == "csv":
        return csv_rows(spark, path, source.schema, multiline=source.multiline)
    if source.format == "parquet":
        rows = read_parquet(spark, path)
    elif source.format == "json":
        rows = spark.read.json(path)
    else:
        raise ValueError(f"source {source.name} has the unknown format {source.format!r}")
    return coerce(rows, source.schema).withColumn(MALFORMED, F.lit(None).cast("string"))


@dataclass(frozen=True)
class Identity:
    """Counts of a delivery's rows and of those set aside, and the fingerprint of all its content."""

    row_count: int
    malformed_count: int
    fingerprint: str


def identity_aggregates(rows: DataFrame) -> list[Column]:
    """What :func:`identity_of` needs, as aggregates that any pass over the rows can compute or observe."""
    fits = F.col(MALFORMED).isNull()
    names = [c for c in rows.columns if c != MALFORMED]
    return [
        *[a.alias(f"rows_{i}") for i, a in enumerate(fingerprint_parts(names, fits))],
        *[a.alias(f"aside_{i}") for i, a in enumerate(fingerprint_parts([MALFORMED], ~fits))],
    ]


def identity_of(names: Sequence[str], found: Mapping) -> Identity:
    """Without malformed rows the fingerprint is that of the rows."""
    rows, aside = ([found[f"{part}_{i}"] for i in range(3)] for part in ("rows", "aside"))
    fingerprint = fingerprint_of([n for n in names if n != MALFORMED], *rows)
    if aside[0]:
        fingerprint = hashlib.md5(f"{fingerprint}|{fingerprint_of(['malformed'], *aside)}".encode()).hexdigest()
    return Identity(rows[0], aside[0], fingerprint)


def store_observed(rows: DataFrame, path: str) -> Identity:
    """Write the rows that fit and return the identity of the whole delivery, both from one pass over the raw text."""
    seen = Observation()
    watched = rows.observe(seen, *identity_aggregates(rows))
    watched.where(F.col(MALFORMED).isNull()).drop(MALFORMED).write.parquet(path)
    return identity_of(rows.columns, seen.get)


@dataclass(frozen=True)
class Load:
    """Rows of a source with the count and content fingerprint that identify them, and what was set aside."""

    source: Source
    rows: DataFrame
    row_count: int
    fingerprint: str
    malformed: DataFrame
    malformed_count: int = 0


def load_source(spark: SparkSession, source: Source, raw_root: str) -> Load:
    whole = read_raw(spark, source, raw_root)
    identity = identity_of(whole.columns, whole.agg(*identity_aggregates(whole)).first().asDict())
    rows, malformed = parted(whole)
    return Load(source, rows, identity.row_count, identity.fingerprint, malformed, identity.malformed_count)


def _open(path: str):
    """A stream over a file of any file system Arrow knows."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_stream("/" + path[5:].lstrip("/"))
    system, inner = fs.FileSystem.from_uri(urllib.parse.quote(path, safe=":/@"))
    return system.open_input_stream(inner)


def _digests(chunk: int):
    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path in batch["file_path"]:
                digest = hashlib.md5()
                with _open(path) as stream:
                    while part := stream.read(chunk):
                        digest.update(part)
                found.append(digest.hexdigest())
            yield batch.assign(checksum_md5=found)

    return digests


def file_fingerprints(spark: SparkSession, path: str, chunk: int = CHUNK_BYTES) -> DataFrame:
    """S8 at file grain: name, path, size, modification time and md5 of every file under ``path``.

    Files are dealt out to tasks by name and streamed in chunks, so their size does not matter; one file is read by
    one task, since md5 can only be taken in order. Spark lists no empty files. Tables are identified by :func:`content_fingerprint`.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("path").alias("file_path"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").cast("timestamp_ntz").cast("string").alias("modified_at"),
    )
    kinds = "file_name string, file_path string, size_bytes long, modified_at string, checksum_md5 string"
    streamed = listed.repartition("file_path").mapInPandas(_digests(chunk), kinds)
    return streamed.select("file_name", "file_path", "size_bytes", "checksum_md5", F.col("modified_at").cast("timestamp_ntz").alias("modified_at"))
