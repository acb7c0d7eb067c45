"""Type 2 history: merge a snapshot into a dimension that keeps every version."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.hashing import row_hash
from strataflow.operators.ordered import dense_number, same_keys
from strataflow.session import cut_lineage

# The open ends of a version's validity.
FAR_FUTURE = dt.date(9999, 12, 31)
FAR_PAST = dt.date(1900, 1, 1)

# Keys of a delta that are counted to be few enough to ship to every executor.
BROADCAST_KEYS = 100_000

NEW, CHANGED, UNCHANGED, ABSENT = "NEW", "CHANGED", "UNCHANGED", "ABSENT"


@dataclass(frozen=True)
class MergeResult:
    """The merged dimension and a one-row table of counts."""

    dimension: DataFrame
    stats: DataFrame


def _check(incoming: DataFrame, natural_key: Sequence[str], tracked: Sequence[str]) -> None:
    if not natural_key:
        raise ValueError("the natural key is empty")
    if not tracked:
        raise ValueError("no column is tracked")
    for what, names in (("natural key", natural_key), ("tracked columns", tracked)):
        missing = [c for c in names if c not in incoming.columns]
        if missing:
            raise ValueError(f"incoming rows lack the {what} {missing}")


def classify(
    existing: DataFrame, incoming: DataFrame, natural_key: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Status of every natural key: one full outer join of key and hash, nothing wider is shuffled.

    ``arrivals`` is how often the key came in, 0 for absent keys; ``_since`` is when the version held began.
    """
    held = existing.where("is_current").select(
        *[F.col(k).alias(f"_h_{k}") for k in natural_key],
        row_hash(existing, tracked).alias("_h_hash"),
        F.lit(True).alias("_held"),
        F.col("effective_date").alias("_since"),
    )
    came = (
        incoming.select(*natural_key, row_hash(incoming, tracked).alias("_hash"))
        .groupBy(*natural_key)
        .agg(F.count("*").alias("_came"), F.max("_hash").alias("_hash"))
    )
    joined = came.join(held, same_keys(natural_key, [f"_h_{k}" for k in natural_key]), "full_outer")
    status = (
        F.when(F.col("_held").isNull(), NEW)
        .when(F.col("_came").isNull(), ABSENT)
        .when(F.col("_hash") == F.col("_h_hash"), UNCHANGED)
        .otherwise(CHANGED)
    )
    keys = [F.when(F.col("_came").isNotNull(), F.col(k)).otherwise(F.col(f"_h_{k}")).alias(k) for k in natural_key]
    return joined.select(*keys, status.alias("status"), F.coalesce("_came", F.lit(0)).alias("arrivals"), "_since")


def initial_load(
    incoming: DataFrame, natural_key: Sequence[str], surrogate_key: str, effective: dt.date, rows: int | None = None
) -> DataFrame:
    """D-5: every row is a first version, numbered from 1 in natural-key order."""
    order = [F.col(k).asc_nulls_last() for k in natural_key]
    return _opened(dense_number(incoming, order, surrogate_key, rows=rows), effective)


def _opened(rows: DataFrame, effective: dt.date) -> DataFrame:
    return rows.withColumns(
        {
            "effective_date": F.lit(effective),
            "end_date": F.lit(FAR_FUTURE),
            "is_current": F.lit(True),
        }
    )


def scd2_merge(
    existing: DataFrame | None,
    incoming: DataFrame,
    natural_key: Sequence[str],
    tracked: Sequence[str],
    surrogate_key: str,
    batch_date: dt.date,
    first_version_effective: dt.date | None = None,
    enrich: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> MergeResult:
    """D-4: open versions for new and changed keys, close what changed, keep everything else.

    Attributes outside ``tracked`` do not open a version and are not applied to an unchanged row. Keys
    absent from ``incoming`` stay current. ``first_version_effective`` dates the first version of keys
    that appear later; by default it is the batch date. A key that comes in twice is an error, and so is a
    batch date before the start of a version that the batch would close.
    ``enrich`` adds columns derived from a row; it is applied to the rows that open versions only.
    """
    _check(incoming, natural_key, tracked)
    if existing is None:
        sizes = incoming.groupBy(*natural_key).count().agg(F.sum("count").alias("rows"), F.max("count").alias("most"))
        size = sizes.first()
        _reject_repeats(size["most"])
        loaded = initial_load(enrich(incoming), natural_key, surrogate_key, batch_date, size["rows"] or 0)
        return MergeResult(loaded, _stats(incoming.sparkSession, {NEW: size["rows"] or 0}, 0))

    # Key and status only; the counts and the keys to number are both read from it.
    statuses = cut_lineage(classify(existing, incoming, natural_key, tracked))
    counted = statuses.groupBy("status").agg(F.count("*").alias("keys"), F.max("arrivals").alias("most"), F.max("_since").alias("since")).collect()
    _reject_repeats(max((r["most"] for r in counted), default=0))
    closing_since = max((r["since"] for r in counted if r["status"] == CHANGED and r["since"]), default=None)
    if closing_since and batch_date < closing_since:
        raise ValueError(f"the batch of {batch_date} would close a version that began on {closing_since}")
    counts = {r["status"]: r["keys"] for r in counted}
    held = existing.agg(F.max(surrogate_key).alias("sk"), F.count_if(~F.col("is_current")).alias("history")).first()

    order = [F.when(F.col("status") == CHANGED, 0).otherwise(1).asc()]
    order += [F.col(k).asc_nulls_last() for k in natural_key]
    delta = statuses.where(F.col("status").isin(CHANGED, NEW))
    size = counts.get(CHANGED, 0) + counts.get(NEW, 0)
    numbered = dense_number(delta, order, "_sk", start=(held["sk"] or 0) + 1, rows=size).select(
        *[F.col(k).alias(f"_d_{k}") for k in natural_key], F.col("status").alias("_status"), "_sk"
    )
    # A daily delta has been counted and is small; then no wide row is shuffled below. A large one is
    # written down, so that it is numbered once and Spark knows its size.
    small = size <= BROADCAST_KEYS
    numbered = numbered if small else cut_lineage(numbered)
    on = same_keys(natural_key, [f"_d_{k}" for k in natural_key])
    changed = numbered.where(F.col("_status") == CHANGED).withColumn("_changed", F.lit(True))
    if small:
        numbered, changed = F.broadcast(numbered), F.broadcast(changed)
    closing = F.col("is_current") & F.coalesce(F.col("_changed"), F.lit(False))
    closed = {
        "end_date": F.when(closing, F.lit(batch_date)).otherwise(F.col("end_date")),
        "is_current": F.col("is_current") & ~closing,
    }
    kept = existing.join(changed, on, "left").select(
        *[closed[c].alias(c) if c in closed else F.col(c) for c in existing.columns]
    )
    started = F.lit(batch_date)
    if first_version_effective is not None:
        started = F.when(F.col("_status") == NEW, F.lit(first_version_effective)).otherwise(started)
    arrived = incoming.join(numbered, on, "inner").select(
        *incoming.columns,
        F.col("_sk").alias(surrogate_key),
        started.alias("effective_date"),
        F.lit(FAR_FUTURE).alias("end_date"),
        F.lit(True).alias("is_current"),
    )
    opened = enrich(arrived)
    merged = kept.unionByName(opened, allowMissingColumns=True)
    return MergeResult(merged, _stats(existing.sparkSession, counts, held["history"]))


def _reject_repeats(most: int | None) -> None:
    if (most or 0) > 1:
        raise ValueError(f"a natural key comes in {most} times")


def _stats(spark: SparkSession, counts: dict[str, int], history: int) -> DataFrame:
    """D-6: one row of counts."""
    new, changed, unchanged, absent = (counts.get(s, 0) for s in (NEW, CHANGED, UNCHANGED, ABSENT))
    # A changed key gives two rows: the version closed and the version opened.
    total = new + 2 * changed + unchanged + absent + history
    return spark.createDataFrame(
        [(new, changed, unchanged, history, absent, total)],
        "new_versions long, changed_versions long, unchanged_versions long, historical_preserved long,"
        " absent_kept long, total_output_rows long",
    )
