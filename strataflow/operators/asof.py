"""As-of joins: the version of a key that was valid when an event happened."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.operators.ordered import HOT_LIMIT, SLICE, carry_forward, greatest_before, range_slices
from strataflow.session import cut_lineage

# Versions of one key up to which each event may be compared with all of them.
FEW_VERSIONS = 64


def asof_join(
    events: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    event_time: str,
    valid_from: str,
    valid_to: str | None,
    take: dict[str, str],
    tie_break: str,
    few_versions: int = FEW_VERSIONS,
    hot_limit: int = HOT_LIMIT,
) -> DataFrame:
    """Left join to the newest version with ``valid_from <= event_time <= valid_to``.

    ``keys`` are named alike on both sides; ``take`` maps version columns to output names. A version that ends
    before it begins, or has no end where ends are asked for, matches nothing and hides nothing. Where a newer
    version ends before an older one does, the older one is valid again after it. Events that match no version
    keep NULLs; no event is ever repeated.
    """
    needed = [*keys, valid_from, *([valid_to] if valid_to else []), tie_break, *take]
    missing = [c for c in needed if c not in versions.columns]
    if missing:
        raise ValueError(f"versions lack the columns {missing}")
    # An event has no version without a key or a start, so such versions can never match.
    usable = versions.where(F.col(valid_from).isNotNull()).dropna(how="any", subset=list(keys))
    slim = usable.select(
        *[F.col(k).alias(f"_v_{k}") for k in keys],
        F.col(valid_from).alias("_from"),
        (F.col(valid_to) if valid_to else F.lit(None).cast(versions.schema[valid_from].dataType)).alias("_to"),
        F.col(tie_break).alias("_tie"),
        F.struct(*[F.col(c).alias(name) for c, name in take.items()]).alias("_take"),
    )
    version_keys = [f"_v_{k}" for k in keys]
    if valid_to:
        slim = slim.where(F.col("_to") >= F.col("_from"))
    slim = slim.withColumn("_after", F.lit(False))
    nested = None
    if valid_to:
        # One row per key that has a version inside another; where there is none, nothing below costs anything.
        seen = greatest_before(slim.select(*version_keys, "_from", "_to", "_tie"), version_keys, ["_from", "_tie"], "_to", "_older_end", hot_limit)
        keyed = seen.groupBy(*version_keys).agg(F.count("*").alias("n"), F.max(F.coalesce(F.col("_older_end") > F.col("_to"), F.lit(False))).alias("inside"))
        counted = cut_lineage(keyed.withColumn("n", F.col("n") * F.when(F.col("inside"), 2).otherwise(1)))
        most, any_inside = counted.agg(F.max("n"), F.max("inside")).first()
        nested = counted.where("inside").select(*version_keys) if any_inside else None
    else:
        most = slim.groupBy(*version_keys).count().agg(F.max("count")).first()[0]
    if nested is not None:
        slim = slim.join(nested, version_keys, "left_anti").unionByName(_unnested(slim.join(nested, version_keys, "left_semi"), version_keys))
    # Events that lack a key or a time cannot match; they are kept out of the shuffle, where they would be one hot key.
    lacking = F.col(event_time).isNull()
    for key in keys:
        lacking = lacking | F.col(key).isNull()
    unmatched = events.where(lacking).select("*", *_nulls(slim, list(take.values())))
    complete = events.where(~lacking)
    if (most or 0) <= few_versions:
        matched = _compare(complete, slim, keys, event_time, valid_to is not None, list(take.values()))
    else:
        matched = _merge(complete, slim, keys, event_time, valid_to is not None, list(take.values()), hot_limit)
    return matched.unionByName(unmatched)


def _sweep(only_open: bool):
    """Passes over the points of a slice in order and keeps the versions that are open, the newest on top.

    A row is a begin or an end of a version, or (``p`` below 0) a version handed on from earlier slices. Numbers stand
    for places in the order of all points (``p``, and ``p_end`` for the version's end) and of all versions (``v``, newer
    ones greater). Gives the newest open version at the last row of each point; or, with ``only_open``, the versions
    that are handed on: those still open, without any that a newer one outlasts.
    """

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, begun = None, [], []
        for batch in batches:
            found = []
            for part, p, v, p_end, last in zip(*(batch[c].tolist() for c in ("slice", "p", "v", "p_end", "last"))):
                if part != at:
                    if only_open and at is not None:
                        found += _outlasting(at, begun)
                    at, held, begun = part, [], []
                if v >= 0:
                    if only_open:
                        begun.append((v, p_end))
                    else:
                        heapq.heappush(held, (-v, p_end))
                if last and not only_open:
                    while held and held[0][1] <= p:
                        heapq.heappop(held)
                    found.append((part, p, -held[0][0] if held else -1, -1))
            yield pd.DataFrame(found, columns=["slice", "p", "v", "p_end"])
        if only_open and at is not None:
            yield pd.DataFrame(_outlasting(at, begun), columns=["slice", "p", "v", "p_end"])

    return sweep


def _outlasting(part: int, versions: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    kept, latest = [], -1
    for v, p_end in sorted(versions, reverse=True):
        if p_end > latest:
            kept.append((part, -1, v, p_end))
            latest = p_end
    return kept


def _unnested(slim, version_keys):
    """Versions of keys where one lies inside another, cut at every begin and end; the newest one holds between.

    ``_after``: the piece begins just after ``_from``, where a version ended. A piece without a version has a
    NULL ``_to`` and holds for no event.

    Begins and ends are laid in one order and cut into slices of it, whatever key they belong to; a slice is swept
    once, starting with the versions that earlier slices have left open. The work is a sort of the points, and what a
    slice hands on is only what may still become the newest.
    """
    rows = slim.count()
    ordered = range_slices(slim, [F.col(c) for c in (*version_keys, "_from", "_tie")], rows, numbered="_n")
    versions = ordered.withColumn("v", F.col(SLICE).cast("long") * F.lit(1 << 33) + F.col("_n")).drop(SLICE, "_n", "_after")
    begins = versions.select(*version_keys, F.col("_from").alias("_at"), F.lit(False).alias("_side"), "v")
    ends = versions.select(*version_keys, F.col("_to").alias("_at"), F.lit(True).alias("_side"), "v")
    place = [*version_keys, "_at", "_side"]
    # Rows of one point have one sort key, so they are never parted.
    points = range_slices(begins.unionByName(ends), [F.col(c) for c in place], 2 * rows, numbered="_n")
    points = points.withColumn("p", F.col(SLICE).cast("long") * F.lit(1 << 33) + F.col("_n"))
    last = points.groupBy(*place).agg(F.max("p").alias("p"))
    end_of = points.where("_side").select(F.col("v").alias("_v"), F.col("p").alias("p_end"), F.col(SLICE).alias("_end_slice"))
    begun = cut_lineage(points.where("NOT _side").join(end_of, F.col("v") == F.col("_v")).select(F.col(SLICE).alias("slice"), "p", "v", "p_end", "_end_slice"))
    kind = "slice int, p long, v long, p_end long"
    crossing = begun.where("_end_slice > slice").withColumn("last", F.lit(False))
    left_open = cut_lineage(crossing.repartition("slice").sortWithinPartitions("slice", "p").mapInPandas(_sweep(True), kind))
    # Where a version ends says which slices it reaches into.
    reach = left_open.select("slice", "v", "p_end", F.shiftright("p_end", 33).cast("int").alias("_to_slice"))
    handed = reach.withColumn("slice", F.explode(F.sequence(F.col("slice") + 1, F.col("_to_slice")))).select("slice", F.lit(-1).cast("long").alias("p"), "v", "p_end")
    marks = last.select(F.shiftright("p", 33).cast("int").alias("slice"), "p", F.lit(-1).cast("long").alias("v"), F.lit(-1).cast("long").alias("p_end"), F.lit(True).alias("last"))
    rows_of = handed.unionByName(begun.select("slice", "p", "v", "p_end")).withColumn("last", F.lit(False)).unionByName(marks)
    swept = rows_of.repartition("slice").sortWithinPartitions("slice", "p", "last").mapInPandas(_sweep(False), kind)
    newest = swept.select("p", F.col("v").alias("_v"))
    found = last.join(newest, "p").join(versions.select(F.col("v").alias("_w"), "_to", "_tie", "_take"), F.col("_v") == F.col("_w"), "left")
    return found.select(*version_keys, F.col("_at").alias("_from"), "_to", "_tie", "_take", F.col("_side").alias("_after"))


def _compare(events, slim, keys, event_time, bounded, names):
    """Few versions per key: equality on the key, the interval as a residual condition."""
    version_keys = [f"_v_{k}" for k in keys]
    line = W.partitionBy(*version_keys).orderBy("_from", "_after", "_tie")
    trimmed = slim.withColumn("_next", F.lead("_from").over(line)).withColumn("_next_after", F.lead("_after").over(line))
    at = F.col(event_time)
    begun = (at > F.col("_from")) | ((at == F.col("_from")) & ~F.col("_after"))
    condition = begun & (F.col("_next").isNull() | (at < F.col("_next")) | ((at == F.col("_next")) & F.col("_next_after")))
    if bounded:
        condition = condition & (at <= F.col("_to"))
    for key, version_key in zip(keys, version_keys):
        condition = condition & (F.col(key) == F.col(version_key))
    joined = events.join(trimmed, condition, "left")
    return joined.select(*events.columns, *[F.col(f"_take.{n}").alias(n) for n in names])


def _merge(events, slim, keys, event_time, bounded, names, hot_limit):
    """Many versions per key: lay versions and events in one order and carry the last version on.

    The work is a sort of both sides, whatever the number of versions of a key.
    """
    payload = F.struct("_to", "_take")
    all_events = events.select(
        *[F.col(k).alias(f"_v_{k}") for k in keys],
        F.col(event_time).alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(None).alias("_tie"),
        # Events of one key and one moment may lie in any order, so they may also be split between tasks.
        F.xxhash64(*[F.col(c) for c in events.columns]).alias("_spread"),
        F.lit(None).alias("_version"),
        F.struct(*events.columns).alias("_event"),
    )
    all_versions = slim.select(
        *[f"_v_{k}" for k in keys],
        F.col("_from").alias("_at"),
        F.when(F.col("_after"), 2).otherwise(0).alias("_kind"),
        "_tie",
        F.lit(0).cast("long").alias("_spread"),
        payload.alias("_version"),
        F.lit(None).alias("_event"),
    )
    line = all_versions.unionByName(all_events)
    order = ["_at", "_kind", "_tie", "_spread"]
    carried = carry_forward(line, [f"_v_{k}" for k in keys], order, "_version", "_held", hot_limit)
    valid = F.lit(True) if not bounded else F.col("_at") <= F.col("_held._to")
    return carried.where("_kind = 1").select(
        "_event.*", *[F.when(valid, F.col(f"_held._take.{n}")).alias(n) for n in names]
    )


def _nulls(slim, names):
    kinds = {f.name: f.dataType for f in slim.schema["_take"].dataType.fields}
    return [F.lit(None).cast(kinds[n]).alias(n) for n in names]


def nested_versions(versions: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str, tie_break: str) -> DataFrame:
    """Versions that end before an older version of the same key does; must be empty."""
    earlier = W.partitionBy(*keys).orderBy(valid_from, tie_break).rowsBetween(W.unboundedPreceding, -1)
    return versions.withColumn("_older_end", F.max(valid_to).over(earlier)).where(
        F.col("_older_end") > F.col(valid_to)
    ).drop("_older_end")
