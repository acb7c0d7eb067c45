"""Lineage as an append-only event log, its current state, and row-count reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.hashing import schema_hash
from strataflow.functions.scalars import clipped_text, literal_like
from strataflow.operators.ordered import HOT_LIMIT, previous_value

# Columns of the event log; every event fills those it knows.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("source_file_path", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("schema_hash", T.StringType()),
        T.StructField("data_batch_id", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("occurred_at", T.TimestampNTZType()),
    ]
)
RUN_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("occurred_at", T.TimestampNTZType()),
    ]
)

# The lifecycle of a file.
LEGAL_TRANSITIONS = [
    ("registered", "ingesting"),
    ("ingesting", "ingested"),
    ("ingested", "transforming"),
    ("transforming", "transformed"),
]
TERMINAL = ("transformed", "failed")
HIGH_REJECT_RATE = 0.05


# --- Runs ---


def run_states(runs: DataFrame) -> DataFrame:
    """L1: current state of each (batch, layer): its last attempt."""
    at = F.struct("occurred_at", F.when(F.col("status") == "running", 0).otherwise(1))
    done = F.col("status") != "running"
    return (
        runs.groupBy("batch_id", "layer")
        .agg(
            F.max_by("status", at).alias("status"),
            F.max(F.when(~done, F.col("occurred_at"))).alias("started_at"),
            F.max(F.when(done, F.col("occurred_at"))).alias("_done_at"),
            F.max_by("rows_in", at).alias("rows_in"),
            F.max_by("rows_out", at).alias("rows_out"),
            clipped_text(F.max_by("error", at)).alias("error"),
        )
        .select(
            "batch_id",
            "layer",
            "status",
            "started_at",
            # A run under way has not finished, whatever an earlier attempt did.
            F.when(F.col("status") != "running", F.col("_done_at")).alias("finished_at"),
            "rows_in",
            "rows_out",
            "error",
        )
    )


def unfinished(requested: DataFrame, states: DataFrame) -> DataFrame:
    """L2: requested (batch, layer) pairs that have not succeeded."""
    done = states.where(F.col("status") == "success").select("batch_id", "layer")
    return requested.join(done, ["batch_id", "layer"], "left_anti")


def run_history(states: DataFrame) -> DataFrame:
    """G-13."""
    return states.select("batch_id", "layer", "status", "rows_out", "started_at", "finished_at").orderBy(
        "started_at", "batch_id", "layer"
    )


# --- Files ---


def _last(value: str, kind: str, at: Column) -> Column:
    return F.max_by(value, F.when(F.col("event_type") == kind, at))


def file_states(events: DataFrame) -> DataFrame:
    """One row per (batch, file): state, content, and the row count of each stage.

    One aggregate over the log; the last event of a kind wins. Gold counts are kept per artifact by
    :func:`gold_counts`, since several artifacts may report to one source.
    """
    at = F.struct("occurred_at", "event_id")
    return events.groupBy("batch_id", "source_name", "source_file_path").agg(
        F.max_by("status", F.when(F.col("status").isNotNull(), at)).alias("status"),
        F.min(F.when(F.col("event_type") == "registered", F.col("occurred_at"))).alias("registered_at"),
        _last("fingerprint", "registered", at).alias("fingerprint"),
        _last("schema_hash", "registered", at).alias("schema_hash"),
        _last("data_batch_id", "ingest_finished", at).alias("data_batch_id"),
        _last("row_count", "ingest_started", at).alias("source_row_count"),
        _last("row_count", "malformed_set_aside", at).alias("malformed_row_count"),
        _last("row_count", "ingest_finished", at).alias("bronze_row_count"),
        _last("row_count", "dq_completed", at).alias("rejected_row_count"),
        _last("row_count", "silver_finished", at).alias("silver_row_count"),
        _last("row_count", "gold_finished", at).alias("gold_row_count"),
    )


def gold_counts(events: DataFrame) -> DataFrame:
    """Rows per (batch, source, artifact)."""
    artifact = F.get_json_object("payload", "$.artifact")
    at = F.struct("occurred_at", "event_id")
    return (
        events.where(F.col("event_type") == "gold_finished")
        .groupBy("batch_id", "source_name", artifact.alias("artifact"))
        .agg(F.max_by("row_count", at).alias("row_count"))
    )


def illegal_transitions(events: DataFrame, hot_limit: int = HOT_LIMIT) -> DataFrame:
    """L3: state changes the lifecycle does not allow, each next to the state it left.

    A file starts as registered and may fail from any state that is not terminal.
    """
    changes = events.where(F.col("status").isNotNull())
    keys = ["batch_id", "source_file_path"]
    order = [F.col("occurred_at").asc(), F.col("event_id").asc()]
    stepped = previous_value(changes, keys, order, "status", "previous_status", hot_limit)
    step = F.concat_ws(">", F.coalesce("previous_status", F.lit("")), "status")
    allowed = [f"{a}>{b}" for a, b in LEGAL_TRANSITIONS] + [">registered"]
    failing = (F.col("status") == "failed") & F.coalesce(~F.col("previous_status").isin(*TERMINAL), F.lit(False))
    return stepped.where(~(step.isin(*allowed) | failing)).select(
        "batch_id", "source_file_path", "event_id", "previous_status", "status"
    )


def content_conflicts(events: DataFrame) -> DataFrame:
    """L4: files registered more than once in a batch with different content."""
    return (
        events.where(F.col("event_type") == "registered")
        .groupBy("batch_id", "source_file_path")
        .agg(F.count_distinct("fingerprint").alias("contents"))
        .where("contents > 1")
    )


def event_timeline(events: DataFrame, payload_schema: str) -> DataFrame:
    """Events of each file in order, with the JSON payload decoded."""
    return events.select(
        "batch_id",
        "source_file_path",
        "event_id",
        "event_type",
        "occurred_at",
        F.from_json("payload", payload_schema).alias("payload"),
    ).orderBy("batch_id", "source_file_path", "occurred_at", "event_id")


def files_of_batch(files: DataFrame, batch_id: str, status: str | None = None) -> DataFrame:
    """L7."""
    chosen = files.where(F.col("batch_id") == batch_id)
    if status is not None:
        chosen = chosen.where(F.col("status") == status)
    return chosen.orderBy("source_name", "source_file_path")


def failed_since(files: DataFrame, moment) -> DataFrame:
    """L7."""
    return files.where((F.col("status") == "failed") & (F.col("registered_at") >= literal_like(files, "registered_at", moment)))


def latest_ingestion(files: DataFrame, as_of=None) -> DataFrame:
    """The last landed file per source, by registration time."""
    landed = files.where(F.col("status").isin("ingested", "transforming", "transformed"))
    if as_of is not None:
        landed = landed.where(F.col("registered_at") <= literal_like(files, "registered_at", as_of))
    rest = [c for c in landed.columns if c != "source_name"]
    return (
        landed.groupBy("source_name")
        .agg(F.max_by(F.struct(*rest), F.struct("registered_at", "batch_id")).alias("_last"))
        .select("source_name", "_last.*")
    )


def latest_schema_hashes(files: DataFrame) -> DataFrame:
    """Hash of the schema last seen per source; a failed file has been seen too."""
    seen = files.where(F.col("status").isin("ingested", "transforming", "transformed", "failed"))
    return seen.groupBy("source_name").agg(
        F.max_by("schema_hash", F.struct("registered_at", "batch_id")).alias("schema_hash")
    )


def schema_drift(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Per source, columns added, removed and retyped between two (source_name, name, type) tables.

    A source has at most some thousand columns, so the lists stay short.
    """
    before = previous.select("source_name", "name", F.col("type").alias("old_type"))
    after = current.select("source_name", "name", F.col("type").alias("new_type"))
    both = before.join(after, ["source_name", "name"], "full_outer")
    pick = lambda condition: F.array_join(
        F.sort_array(F.collect_list(F.when(condition, F.col("name")))), ","
    )
    drift = both.groupBy("source_name").agg(
        pick(F.col("old_type").isNull()).alias("columns_added"),
        pick(F.col("new_type").isNull()).alias("columns_removed"),
        pick(F.col("old_type") != F.col("new_type")).alias("columns_retyped"),
    )
    old = schema_hash(previous, ["source_name"], "previous_schema_hash")
    new = schema_hash(current, ["source_name"], "current_schema_hash")
    changed = F.concat("columns_added", "columns_removed", "columns_retyped") != ""
    return drift.where(changed).join(old, "source_name", "left").join(new, "source_name", "left")


# --- Reconciliation ---


def reconcile(files: DataFrame) -> DataFrame:
    """Findings over the row counts of each file; every rule is read off the same row."""
    source, bronze = F.col("source_row_count"), F.col("bronze_row_count")
    rejected, silver = F.col("rejected_row_count"), F.col("silver_row_count")
    malformed = F.coalesce(F.col("malformed_row_count"), F.lit(0))  # logged only where there are any
    expected = bronze - rejected
    rate = rejected.cast("double") / bronze.cast("double")

    def finding(condition: Column, severity: str, code: str, message: Column) -> Column:
        return F.when(
            condition, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), message.alias("message"))
        )

    findings = F.array(
        finding(
            bronze > source,
            "CRITICAL",
            "bronze_inflated",
            F.format_string("landed %d rows out of a delivery of %d", bronze, source),
        ),
        finding(
            silver != expected,
            "CRITICAL",
            "row_count_drift",
            F.format_string("refined %d rows, while %d landed and %d were set aside", silver, bronze, rejected),
        ),
        finding(
            (bronze > 0) & (silver == 0),
            "CRITICAL",
            "complete_silver_loss",
            F.format_string("of %d landed rows none was refined", bronze),
        ),
        finding(
            (bronze > 0) & (F.when(bronze > 0, rate) > HIGH_REJECT_RATE),
            "WARN",
            "high_reject_rate",
            F.format_string("%d rows set aside out of %d", rejected, bronze),
        ),
        finding(
            malformed > 0,
            "WARN",
            "malformed_rows",
            F.format_string("%d rows did not fit the header", malformed),
        ),
        finding(
            bronze < source - malformed,
            "CRITICAL",
            "bronze_loss",
            F.format_string("landed %d rows out of a delivery of %d, while %d did not fit", bronze, source, malformed),
        ),
        finding(bronze == 0, "WARN", "empty_source_file", F.lit("the delivery was empty")),
        finding(
            ~F.col("status").isin(*TERMINAL),
            "WARN",
            "non_terminal_status",
            F.format_string("the file stopped at %s", F.col("status")),
        ),
    )
    return (
        files.select(
            "batch_id", "source_name", "source_file_path", F.explode(F.filter(findings, lambda f: f.isNotNull())).alias("f")
        )
        .select("batch_id", "source_name", "source_file_path", "f.*")
    )


def reconciliation_events(files: DataFrame) -> DataFrame:
    """Per file, how many findings of each severity, with the JSON payload of its ``reconciled`` event."""
    key = ["batch_id", "source_name", "source_file_path"]
    found = reconcile(files).groupBy(*key).agg(
        F.count("*").alias("finding_count"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_count"),
        F.count_if(F.col("severity") == "WARN").alias("warn_count"),
    )
    counts = ["finding_count", "critical_count", "warn_count"]
    counted = files.select(*key).join(found, key, "left").fillna(0, counts)
    return counted.withColumn("payload", F.to_json(F.struct(*counts)))
