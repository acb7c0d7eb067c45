"""Lineage over event logs derived from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.plans import lineage
from strataflow.queries.inputs import Tables, registry

QUERIES, SQL, query = registry()

# --- Runs: every event is a change of some run; its id decides what happened ---

_RUNS_SQL = """
runs AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) || '-' || CAST(user_id % 40 AS VARCHAR) AS batch_id,
         CASE WHEN event_id % 2 = 0 THEN 'bronze' ELSE 'silver' END AS layer,
         CASE event_id % 5 WHEN 0 THEN 'running' WHEN 1 THEN 'running' WHEN 2 THEN 'failed' ELSE 'success' END AS status,
         event_id AS rows_out, CASE WHEN event_id % 5 = 2 THEN repeat('x', 5000) END AS error, ts AS occurred_at
  FROM events),
last_runs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, layer ORDER BY occurred_at DESC) AS rn FROM runs) WHERE rn = 1),
states AS (
  SELECT l.batch_id, l.layer, l.status, r.started_at, CASE WHEN l.status <> 'running' THEN r.done_at END AS finished_at, l.rows_out, left(l.error, 4000) AS error
  FROM last_runs l JOIN (SELECT batch_id, layer, max(occurred_at) FILTER (WHERE status = 'running') AS started_at,
                                max(occurred_at) FILTER (WHERE status <> 'running') AS done_at FROM runs GROUP BY batch_id, layer) r
    ON r.batch_id = l.batch_id AND r.layer = l.layer)"""


def _states(t: Tables) -> DataFrame:
    key = F.col("event_id")
    runs = t.events.select(
        F.concat_ws("-", F.col("ts").cast("date").cast("string"), (F.col("user_id") % 40).cast("string")).alias("batch_id"),
        F.when(key % 2 == 0, "bronze").otherwise("silver").alias("layer"),
        F.when(key % 5 < 2, "running").when(key % 5 == 2, "failed").otherwise("success").alias("status"),
        F.lit(None).cast("long").alias("rows_in"),
        key.alias("rows_out"),
        F.when(key % 5 == 2, F.repeat(F.lit("x"), 5000)).alias("error"),
        F.col("ts").alias("occurred_at"),
    )
    return lineage.run_states(runs)


@query(
    "run_state",
    f"""WITH {_RUNS_SQL} SELECT batch_id, layer, status, strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at, strftime(finished_at, '%Y-%m-%d %H:%M:%S.%f') AS finished_at, rows_out,
        length(error) AS error_length FROM states""",
    sparse=("error_length",),
)
def run_state(t: Tables) -> DataFrame:
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return _states(t).select(
        "batch_id",
        "layer",
        "status",
        text("started_at"),
        text("finished_at"),
        "rows_out",
        F.length("error").cast("long").alias("error_length"),
    )


@query(
    "run_unfinished",
    f"""WITH {_RUNS_SQL}, asked AS (SELECT DISTINCT batch_id, unnest(['bronze', 'silver', 'gold']) AS layer FROM runs)
        SELECT batch_id, layer FROM asked a WHERE NOT EXISTS (SELECT 1 FROM states s WHERE s.batch_id = a.batch_id AND s.layer = a.layer AND s.status = 'success')""",
)
def run_unfinished(t: Tables) -> DataFrame:
    states = _states(t)
    layers = F.explode(F.array(F.lit("bronze"), F.lit("silver"), F.lit("gold")))
    asked = states.select("batch_id").distinct().select("batch_id", layers.alias("layer"))
    return lineage.unfinished(asked, states)


@query("run_history", f"WITH {_RUNS_SQL} SELECT batch_id, layer, status, rows_out FROM states")
def run_history(t: Tables) -> DataFrame:
    return lineage.run_history(_states(t)).drop("started_at", "finished_at")


# --- Files: every order is a file of its day, its lines are what happened to it ---

_KINDS = ["registered", "ingest_started", "ingest_finished", "dq_completed", "silver_started", "silver_finished", "failed"]
_STATUS = {
    "registered": "registered",
    "ingest_started": "ingesting",
    "ingest_finished": "ingested",
    "silver_started": "transforming",
    "silver_finished": "transformed",
    "failed": "failed",
}
_EVENTS_SQL = f"""
log AS (
  SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id, 'src' || CAST(user_id % 8 AS VARCHAR) AS source_name,
         'file' || CAST(user_id % 16 AS VARCHAR) AS source_file_path,
         list_extract([{', '.join(f"'{k}'" for k in _KINDS)}], CAST(event_id % 7 AS BIGINT) + 1) AS event_type,
         CAST(floor(value) AS BIGINT) AS row_count, md5(CAST(event_id % 2 AS VARCHAR)) AS fingerprint, props AS payload, ts AS occurred_at
  FROM events),
typed AS (
  SELECT *, CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _STATUS.items())} END AS status FROM log),
files AS (
  SELECT batch_id, source_name, source_file_path,
         max_by(status, occurred_at) FILTER (WHERE status IS NOT NULL) AS status,
         min(occurred_at) FILTER (WHERE event_type = 'registered') AS registered_at,
         max_by(row_count, occurred_at) FILTER (WHERE event_type = 'ingest_started') AS source_row_count,
         max_by(row_count, occurred_at) FILTER (WHERE event_type = 'ingest_finished') AS bronze_row_count,
         max_by(row_count, occurred_at) FILTER (WHERE event_type = 'dq_completed') AS rejected_row_count,
         max_by(row_count, occurred_at) FILTER (WHERE event_type = 'silver_finished') AS silver_row_count
  FROM typed GROUP BY batch_id, source_name, source_file_path)"""


def _events(t: Tables) -> DataFrame:
    key = F.col("event_id")
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (key % 7 + 1).cast("int"))
    status = F.create_map(*[F.lit(x) for pair in _STATUS.items() for x in pair])
    rows = t.events.select(
        "event_id",
        F.col("ts").cast("date").cast("string").alias("batch_id"),
        F.concat(F.lit("src"), (F.col("user_id") % 8).cast("string")).alias("source_name"),
        F.concat(F.lit("file"), (F.col("user_id") % 16).cast("string")).alias("source_file_path"),
        kind.alias("event_type"),
        F.floor("value").cast("long").alias("row_count"),
        F.md5((key % 2).cast("string")).alias("fingerprint"),
        F.lit(None).cast("string").alias("schema_hash"),
        F.lit(None).cast("string").alias("data_batch_id"),
        F.col("props").alias("payload"),
        F.col("ts").alias("occurred_at"),
    )
    return rows.withColumn("status", F.try_element_at(status, F.col("event_type")))


_COUNTS = ["source_row_count", "bronze_row_count", "rejected_row_count", "silver_row_count"]


@query("stage_counts", f"WITH {_EVENTS_SQL} SELECT batch_id, source_name, source_file_path, status, {', '.join(_COUNTS)} FROM files", sparse=("source_row_count", "bronze_row_count", "rejected_row_count", "silver_row_count"))
def stage_counts(t: Tables) -> DataFrame:
    return lineage.file_states(_events(t)).select("batch_id", "source_name", "source_file_path", "status", *_COUNTS)


@query(
    "gold_counts",
    """SELECT batch_id, source_name, artifact, row_count FROM (
         SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id, 'src' || CAST(user_id % 8 AS VARCHAR) AS source_name,
                json_extract_string(props, '$.k') AS artifact, event_id AS row_count,
                row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id % 8, json_extract_string(props, '$.k') ORDER BY ts DESC) AS rn
         FROM events WHERE event_type = 'purchase') WHERE rn = 1""",
)
def gold_counts(t: Tables) -> DataFrame:
    """Several artifacts may report to one source; each keeps its own count."""
    events = t.events.select(
        "event_id",
        F.col("ts").cast("date").cast("string").alias("batch_id"),
        F.concat(F.lit("src"), (F.col("user_id") % 8).cast("string")).alias("source_name"),
        F.when(F.col("event_type") == "purchase", "gold_finished").otherwise(F.col("event_type")).alias("event_type"),
        F.col("event_id").alias("row_count"),
        F.concat(F.lit('{"artifact": "'), F.get_json_object("props", "$.k"), F.lit('"}')).alias("payload"),
        F.col("ts").alias("occurred_at"),
    )
    return lineage.gold_counts(events)


_TRANSITIONS_SQL = f"""WITH {_EVENTS_SQL},
steps AS (SELECT *, lag(status) OVER (PARTITION BY batch_id, source_file_path ORDER BY occurred_at, event_id) AS previous_status FROM typed WHERE status IS NOT NULL)
SELECT batch_id, source_file_path, event_id, previous_status, status FROM steps
WHERE NOT (coalesce(previous_status, '') || '>' || status IN ('>registered', 'registered>ingesting', 'ingesting>ingested', 'ingested>transforming', 'transforming>transformed')
           OR (status = 'failed' AND previous_status IS NOT NULL AND previous_status NOT IN ('transformed', 'failed')))"""


@query("lineage_transitions", _TRANSITIONS_SQL)
def lineage_transitions(t: Tables) -> DataFrame:
    return lineage.illegal_transitions(_events(t))


@query("lineage_transitions_hot_keys", _TRANSITIONS_SQL)
def lineage_transitions_hot_keys(t: Tables) -> DataFrame:
    return lineage.illegal_transitions(_events(t), hot_limit=5)


@query(
    "lineage_conflicts",
    f"""WITH {_EVENTS_SQL} SELECT batch_id, source_file_path, count(DISTINCT fingerprint) AS contents FROM typed
        WHERE event_type = 'registered' GROUP BY batch_id, source_file_path HAVING count(DISTINCT fingerprint) > 1""",
)
def lineage_conflicts(t: Tables) -> DataFrame:
    return lineage.content_conflicts(_events(t))


@query(
    "event_timeline",
    f"""WITH {_EVENTS_SQL} SELECT batch_id, source_file_path, event_id, event_type, CAST(json_extract(payload, '$.k') AS BIGINT) AS k FROM typed""",
)
def event_timeline(t: Tables) -> DataFrame:
    timeline = lineage.event_timeline(_events(t), "k bigint")
    return timeline.select("batch_id", "source_file_path", "event_id", "event_type", F.col("payload.k").alias("k"))


@query(
    "files_of_batch",
    f"""WITH {_EVENTS_SQL} SELECT source_name, source_file_path, status FROM files WHERE batch_id = '2024-01-10' AND status = 'failed'""",
)
def files_of_batch(t: Tables) -> DataFrame:
    files = lineage.files_of_batch(lineage.file_states(_events(t)), "2024-01-10", "failed")
    return files.select("source_name", "source_file_path", "status")


@query(
    "failed_since",
    f"""WITH {_EVENTS_SQL} SELECT batch_id, source_name, source_file_path FROM files WHERE status = 'failed' AND registered_at >= TIMESTAMP '2024-01-20'""",
)
def failed_since(t: Tables) -> DataFrame:
    moment = dt.datetime(2024, 1, 20)
    return lineage.failed_since(lineage.file_states(_events(t)), moment).select("batch_id", "source_name", "source_file_path")


@query(
    "latest_ingestion",
    f"""WITH {_EVENTS_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY registered_at DESC, batch_id DESC) AS rn
          FROM files WHERE status IN ('ingested', 'transforming', 'transformed') AND registered_at <= TIMESTAMP '2024-01-20')
        SELECT source_name, batch_id, source_file_path, bronze_row_count FROM ranked WHERE rn = 1""",
    sparse=("bronze_row_count",),
)
def latest_ingestion(t: Tables) -> DataFrame:
    moment = dt.datetime(2024, 1, 20)
    latest = lineage.latest_ingestion(lineage.file_states(_events(t)), moment)
    return latest.select("source_name", "batch_id", "source_file_path", "bronze_row_count")


_COLUMNS_SQL = """
cols AS (SELECT DISTINCT o_orderpriority AS source_name, 'c' || CAST(o_custkey % 60 AS VARCHAR) AS name, o_custkey % 60 AS n FROM orders),
before AS (SELECT source_name, name, 'bigint' AS type FROM cols WHERE n % 7 <> 0 OR source_name = '5-LOW'),
after AS (SELECT source_name, name, CASE WHEN n % 5 = 0 AND source_name <> '5-LOW' THEN 'string' ELSE 'bigint' END AS type FROM cols WHERE n % 11 <> 0 OR source_name = '5-LOW')"""


def _columns(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Columns of five sources before and after a change; one source does not change."""
    n, same = F.col("n"), F.col("source_name") == "5-LOW"
    columns = t.orders.select(F.col("o_orderpriority").alias("source_name"), (F.col("o_custkey") % 60).alias("n")).distinct()
    named = columns.withColumn("name", F.concat(F.lit("c"), n.cast("string")))
    before = named.where((n % 7 != 0) | same).select("source_name", "name", F.lit("bigint").alias("type"))
    after = named.where((n % 11 != 0) | same).select(
        "source_name", "name", F.when((n % 5 == 0) & ~same, "string").otherwise("bigint").alias("type")
    )
    return before, after


@query(
    "schema_drift",
    f"""WITH {_COLUMNS_SQL},
        drift AS (
          SELECT coalesce(b.source_name, a.source_name) AS source_name,
                 coalesce(string_agg(a.name, ',' ORDER BY a.name) FILTER (WHERE b.name IS NULL), '') AS columns_added,
                 coalesce(string_agg(b.name, ',' ORDER BY b.name) FILTER (WHERE a.name IS NULL), '') AS columns_removed,
                 coalesce(string_agg(a.name, ',' ORDER BY a.name) FILTER (WHERE a.type <> b.type), '') AS columns_retyped
          FROM before b FULL JOIN after a ON a.source_name = b.source_name AND a.name = b.name GROUP BY 1)
        SELECT d.*, (SELECT md5(string_agg(name || ':' || type, chr(10) ORDER BY name || ':' || type)) FROM before x WHERE x.source_name = d.source_name) AS previous_schema_hash,
               (SELECT md5(string_agg(name || ':' || type, chr(10) ORDER BY name || ':' || type)) FROM after x WHERE x.source_name = d.source_name) AS current_schema_hash
        FROM drift d WHERE columns_added || columns_removed || columns_retyped <> ''""",
)
def schema_drift(t: Tables) -> DataFrame:
    return lineage.schema_drift(*_columns(t))


@query(
    "latest_schema_hashes",
    f"""WITH {_EVENTS_SQL} SELECT source_name, schema_hash FROM (
          SELECT source_name, md5(batch_id) AS schema_hash, row_number() OVER (PARTITION BY source_name ORDER BY registered_at DESC NULLS LAST, batch_id DESC) AS rn
          FROM files WHERE status IN ('ingested', 'transforming', 'transformed', 'failed')) WHERE rn = 1""",
)
def latest_schema_hashes(t: Tables) -> DataFrame:
    files = lineage.file_states(_events(t)).withColumn("schema_hash", F.md5("batch_id"))
    return lineage.latest_schema_hashes(files)


def _events_with_malformed(t: Tables) -> DataFrame:
    """Every third event also says how many rows of the file did not fit its header."""
    events = _events(t)
    aside = events.where("event_id % 3 = 0").withColumns(
        {"event_type": F.lit("malformed_set_aside"), "status": F.lit(None).cast("string"), "row_count": F.col("row_count") % 50}
    )
    return events.unionByName(aside)


_FILES_SQL = f"""{_EVENTS_SQL},
aside AS (SELECT batch_id, source_name, source_file_path, max_by(row_count % 50, occurred_at) AS m FROM log WHERE event_id % 3 = 0 GROUP BY ALL),
whole AS (SELECT files.*, coalesce(m, 0) AS malformed FROM files LEFT JOIN aside USING (batch_id, source_name, source_file_path))"""


@query(
    "reconcile",
    f"""WITH {_FILES_SQL},
        findings AS (
          SELECT *, 'CRITICAL' AS severity, 'bronze_inflated' AS code, 'landed ' || bronze_row_count || ' rows out of a delivery of ' || source_row_count AS message
          FROM whole WHERE bronze_row_count > source_row_count
          UNION ALL SELECT *, 'CRITICAL', 'row_count_drift', 'refined ' || silver_row_count || ' rows, while ' || bronze_row_count || ' landed and ' || rejected_row_count || ' were set aside'
          FROM whole WHERE silver_row_count <> bronze_row_count - rejected_row_count
          UNION ALL SELECT *, 'CRITICAL', 'complete_silver_loss', 'of ' || bronze_row_count || ' landed rows none was refined'
          FROM whole WHERE bronze_row_count > 0 AND silver_row_count = 0
          UNION ALL SELECT *, 'WARN', 'high_reject_rate', rejected_row_count || ' rows set aside out of ' || bronze_row_count
          FROM whole WHERE bronze_row_count > 0 AND CAST(rejected_row_count AS DOUBLE) / bronze_row_count > 0.05
          UNION ALL SELECT *, 'WARN', 'malformed_rows', malformed || ' rows did not fit the header'
          FROM whole WHERE malformed > 0
          UNION ALL SELECT *, 'CRITICAL', 'bronze_loss', 'landed ' || bronze_row_count || ' rows out of a delivery of ' || source_row_count || ', while ' || malformed || ' did not fit'
          FROM whole WHERE bronze_row_count < source_row_count - malformed
          UNION ALL SELECT *, 'WARN', 'empty_source_file', 'the delivery was empty' FROM whole WHERE bronze_row_count = 0
          UNION ALL SELECT *, 'WARN', 'non_terminal_status', 'the file stopped at ' || status
          FROM whole WHERE status NOT IN ('transformed', 'failed'))
        SELECT batch_id, source_name, source_file_path, severity, code, message FROM findings""",
)
def reconcile(t: Tables) -> DataFrame:
    return lineage.reconcile(lineage.file_states(_events_with_malformed(t)))


@query(
    "reconcile_summary",
    f"""WITH {_FILES_SQL},
        counted AS (
          SELECT batch_id, source_name, source_file_path,
                 coalesce(CAST(bronze_row_count > source_row_count AS BIGINT), 0)
                   + coalesce(CAST(bronze_row_count < source_row_count - malformed AS BIGINT), 0)
                   + coalesce(CAST(silver_row_count <> bronze_row_count - rejected_row_count AS BIGINT), 0)
                   + coalesce(CAST(bronze_row_count > 0 AND silver_row_count = 0 AS BIGINT), 0) AS critical_count,
                 coalesce(CAST(bronze_row_count > 0 AND CAST(rejected_row_count AS DOUBLE) / nullif(bronze_row_count, 0) > 0.05 AS BIGINT), 0)
                   + CAST(malformed > 0 AS BIGINT) + coalesce(CAST(bronze_row_count = 0 AS BIGINT), 0)
                   + coalesce(CAST(status NOT IN ('transformed', 'failed') AS BIGINT), 0) AS warn_count
          FROM whole)
        SELECT *, critical_count + warn_count AS finding_count,
               '{{"finding_count":' || (critical_count + warn_count) || ',"critical_count":' || critical_count || ',"warn_count":' || warn_count || '}}' AS payload
        FROM counted""",
)
def reconcile_summary(t: Tables) -> DataFrame:
    return lineage.reconciliation_events(lineage.file_states(_events_with_malformed(t)))
