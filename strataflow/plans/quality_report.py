"""Batch report of data quality, the gate that reads it, and the result history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.scalars import safe_ratio
from strataflow.operators.quality import CRITICAL, WARNING
from strataflow.sources.snapshots import path_exists

GATE_THRESHOLD_PCT = 5.0

REPORT_SCHEMA = (
    "batch_id string, total_rows_in long, total_rows_clean long, total_rows_quarantined long,"
    " critical_failure_count long, warning_count long, sources_with_critical_failures array<string>,"
    " sources array<struct<source_name: string, rows_in: long, rows_clean: long, rows_quarantined: long,"
    " rules: array<struct<rule_id: string, severity: string, rows_evaluated: long, rows_failed: long,"
    " pass_rate: double>>>>"
)


def batch_summary(totals: DataFrame, outcomes: DataFrame, batch_id: str) -> DataFrame:
    """Totals over all tables and the number of failing rules by severity, as one row."""
    sums = totals.agg(
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("total_rows_in"),
        F.coalesce(F.sum("rows_clean"), F.lit(0)).alias("total_rows_clean"),
        F.coalesce(F.sum("rows_quarantined"), F.lit(0)).alias("total_rows_quarantined"),
    )
    failed = F.col("rows_failed") > 0
    critical = failed & (F.col("severity") == CRITICAL)
    rules = outcomes.agg(
        F.count_if(critical).alias("critical_failure_count"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warning_count"),
        # As many entries as there are declared sources.
        F.sort_array(F.collect_set(F.when(critical, F.col("source_name")))).alias("sources_with_critical_failures"),
    )
    # Both sides are a single row.
    keyed = sums.withColumn("batch_id", F.lit(batch_id))
    return keyed.join(rules.withColumn("batch_id", F.lit(batch_id)), "batch_id")


def batch_report(totals: DataFrame, outcomes: DataFrame, batch_id: str) -> DataFrame:
    """The summary with its sources and rules nested, one row per batch."""
    rules = outcomes.groupBy("source_name").agg(
        F.sort_array(F.collect_list(F.struct("rule_id", "severity", "rows_evaluated", "rows_failed", "pass_rate"))).alias(
            "rules"
        )
    )
    sources = totals.join(rules, "source_name", "left").agg(
        F.sort_array(
            F.collect_list(F.struct("source_name", "rows_in", "rows_clean", "rows_quarantined", "rules"))
        ).alias("sources")
    )
    keyed = sources.withColumn("batch_id", F.lit(batch_id))
    return batch_summary(totals, outcomes, batch_id).join(keyed, "batch_id")


def write_report(report: DataFrame, root: str, batch_id: str) -> str:
    path = f"{root.rstrip('/')}/{batch_id}"
    report.coalesce(1).write.mode("overwrite").json(path)  # a single row
    return path


def read_report(spark: SparkSession, root: str, batch_id: str) -> DataFrame | None:
    """The report of a batch, None if it has none."""
    path = f"{root.rstrip('/')}/{batch_id}"
    return spark.read.schema(REPORT_SCHEMA).json(path) if path_exists(spark, path) else None


def gate(summary: DataFrame, threshold_pct: float = GATE_THRESHOLD_PCT) -> DataFrame:
    """Q11: fail only if a critical rule failed *and* more than the threshold was quarantined."""
    pct = safe_ratio(F.col("total_rows_quarantined"), F.col("total_rows_in")) * 100
    fails = (F.col("critical_failure_count") > 0) & (pct > threshold_pct)
    return summary.select(
        "batch_id",
        F.when(fails, "fail").otherwise("pass").alias("decision"),
        F.col("critical_failure_count").alias("critical_failures"),
        F.col("total_rows_quarantined").alias("rows_quarantined"),
        F.col("total_rows_in").alias("rows_in"),
        F.round(pct, 2).alias("quarantine_pct"),
        F.lit(float(threshold_pct)).alias("threshold_pct"),
    )


def gate_of_batch(spark: SparkSession, root: str, batch_id: str, threshold_pct: float = GATE_THRESHOLD_PCT) -> DataFrame:
    """The gate over the stored report; without a report the batch passes and says so."""
    report = read_report(spark, root, batch_id)
    if report is not None:
        return gate(report, threshold_pct)
    return spark.createDataFrame(
        [(batch_id, "pass_no_report", 0, 0, 0, 0.0, float(threshold_pct))],
        "batch_id string, decision string, critical_failures long, rows_quarantined long, rows_in long,"
        " quarantine_pct double, threshold_pct double",
    )


# --- History of results over batches ---


def latest_results(results: DataFrame) -> DataFrame:
    """Q12: of an append-only log, the last result per (batch, table, check)."""
    keys = ["batch_id", "table_name", "check_name"]
    rest = ["severity", "passed", "rows_checked", "rows_failed", "details"]
    return (
        results.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "recorded_at").alias("_last"), F.max("recorded_at").alias("recorded_at"))
        .select(*keys, "_last.*", "recorded_at")
    )


def report_for_batch(results: DataFrame, batch_id: str) -> DataFrame:
    return latest_results(results.where(F.col("batch_id") == batch_id)).orderBy("table_name", "check_name")


def any_errors(results: DataFrame) -> DataFrame:
    """Whether a check of severity ERROR failed, per batch."""
    failed = (F.col("severity") == "ERROR") & ~F.col("passed")
    return latest_results(results).groupBy("batch_id").agg((F.count_if(failed) > 0).alias("any_error"))
