"""Records of delimited text whose quoted values may hold line breaks, read by many tasks.

A line is a record only if it does not begin inside quotes, and whether it does depends on all lines before it. A first
pass works out for each range of a file how it would end, beginning outside and beginning inside quotes; strung together
these say how each range really begins. A second pass cuts records with that knowledge, each range by itself, and only
records that cross ranges are pieced together.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE = ["file", "start"]
# Fields up to the last one, which a quote opens and none closes. A quote opens a value only where the value begins;
# two quotes inside stand for one; what follows a closing quote up to the separator belongs to the value.
_OPEN = re.compile(r'(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+\Z')


class UnclosedQuote(ValueError):
    """A quote is opened and the file ends before it is closed."""


def ends_open(line: str, begins_open: bool) -> bool:
    """Whether the line ends inside quotes."""
    return _OPEN.match('"' + line if begins_open else line) is not None


@dataclass(frozen=True)
class Scan:
    """What the first pass knows: whether any line ends inside quotes, and by file the ranges after which that changes."""

    breaks: bool
    changes: dict[str, list[tuple[int, bool]]]

    def begins_open(self, file: str, start: int) -> bool:
        """Whether a range begins inside quotes: as the ranges before it have left it."""
        before = bisect.bisect_left(self.changes.get(file, []), (start, False))
        return self.changes[file][before - 1][1] if before else False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _ranges(batch: pd.DataFrame) -> Iterator[tuple[tuple[str, int], pd.DataFrame]]:
    """Runs of rows of one range, in the order of the file."""
    change = (batch["file"] != batch["file"].shift()) | (batch["start"] != batch["start"].shift())
    for _, rows in batch.groupby(change.cumsum(), sort=False):
        yield (rows["file"].iloc[0], int(rows["start"].iloc[0])), rows


def _compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per range: its end from outside and from inside quotes, and whether a line ends open, beginning outside."""
    at, ends, opened = None, (False, True), False
    for batch in batches:
        done = []
        for key, rows in _ranges(batch) if len(batch) else ():
            if key != at:
                if at:
                    done.append((*at, *ends, opened))
                at, ends, opened = key, (False, True), False
            for line in rows["value"]:
                ends = tuple(ends_open(line, e) for e in ends)
                opened |= ends[0]
        yield pd.DataFrame(done, columns=[*RANGE, "from_out", "from_in", "opened"])
    if at:
        yield pd.DataFrame([(*at, *ends, opened)], columns=[*RANGE, "from_out", "from_in", "opened"])


def scan_quotes(spark: SparkSession, path: str) -> Scan:
    """The first pass. Lines without a quote change nothing and stay in the JVM; the driver gets a row per range with quotes."""
    quoted = _lines(spark, path).where(F.col("value").contains('"'))
    found = quoted.mapInPandas(_compose, "file string, start long, from_out boolean, from_in boolean, opened boolean").collect()
    inside, changes, breaks = {}, {}, False
    for row in sorted(found, key=lambda r: (r["file"], r["start"])):
        file, before = row["file"], inside.get(row["file"], False)
        inside[file] = row["from_in"] if before else row["from_out"]
        breaks |= row["opened"] or before
        if inside[file] != before:
            changes.setdefault(file, []).append((row["start"], inside[file]))
    unclosed = sorted(f for f, is_open in inside.items() if is_open)
    if unclosed:
        raise UnclosedQuote(f"{unclosed[0]}: a quoted value does not end before the file does")
    return Scan(breaks, changes)


def _cutter(scan: Scan):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, is_open, parts, kind = None, False, [], "whole"
        for batch in batches:
            done = []
            for key, rows in _ranges(batch) if len(batch) else ():
                if key != at:
                    if parts:
                        done.append(("\n".join(parts), *at, "tail" if kind != "head" else "head"))
                    at, parts, is_open = key, [], scan.begins_open(*key)
                    kind = "head" if is_open else "header" if key[1] == 0 else "whole"
                for line in rows["value"]:
                    parts.append(line)
                    if '"' in line:
                        is_open = ends_open(line, is_open)
                    if not is_open:
                        done.append(("\n".join(parts), *at, kind))
                        parts, kind = [], "whole"
            yield pd.DataFrame(done, columns=["value", *RANGE, "kind"])
        if parts:
            yield pd.DataFrame([("\n".join(parts), *at, "tail" if kind != "head" else "head")], columns=["value", *RANGE, "kind"])

    return cut


def quoted_records(spark: SparkSession, path: str, scan: Scan) -> DataFrame:
    """``value, kind``: every record of the files, ``kind`` is ``header`` for the first one of a file. Blank lines are none.

    A carriage return at the end of a record belongs to the line break; one inside quotes stays.
    """
    cut = _lines(spark, path).mapInPandas(_cutter(scan), "value string, file string, start long, kind string")
    records = cut.where("kind IN ('whole', 'header')").select("value", "kind")
    if scan.changes:
        # A tail is followed by the heads of the ranges it reaches into: at most two pieces per range.
        pieces = cut.where("kind IN ('tail', 'head')")
        order = W.partitionBy("file").orderBy("start", F.col("kind"))
        numbered = pieces.withColumn("record", F.sum((F.col("kind") == "tail").cast("int")).over(order))
        whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "value"))), lambda x: x["value"]), "\n")
        records = records.unionByName(numbered.groupBy("file", "record").agg(whole.alias("value")).select("value", F.lit("whole").alias("kind")))
    return records.withColumn("value", F.regexp_replace("value", "\r$", "")).where(F.trim("value") != "")
