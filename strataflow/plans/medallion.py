"""The batch jobs of the lake: land raw files, refine them into the star schema, publish gold tables.

Each job is a handful of lazy plans ended by writes. What the driver sees is counts and statuses; the
rows stay in Spark. Batch ids, dates and times are given by the caller.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.hashing import schema_hash, tokenize_columns
from strataflow.functions.scalars import day_of, literal_like
from strataflow.operators import quality
from strataflow.operators.relational import union_by_name
from strataflow.plans import gold, lineage, quality_report, star
from strataflow.session import cut_lineage, job, together
from strataflow.sources import snapshots
from strataflow.sources.catalogue import ALL_SOURCES, QUALITY_RULES, Source, by_name, foreign_key_targets, rules_for
from strataflow.sources.manifest import checksum_mismatches, load_manifest, manifest_files
from strataflow.sources.readers import file_fingerprints, parted, read_raw, store_observed



@dataclass(frozen=True)
class Lake:
    """Where the layers and the lineage lie."""

    root: str

    def layer(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


#: Steps of a batch that write events, in their order.
STEPS = ("land", "refine", "publish", "reconcile")


class Ledger:
    """The append-only event and run logs; a job appends its events in one small write."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark = spark
        self.paths = {"events": lake.layer("meta/events"), "runs": lake.layer("meta/runs")}

    def _read(self, log: str, schema: T.StructType) -> DataFrame:
        path = self.paths[log]
        if snapshots.path_exists(self.spark, path):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.createDataFrame([], schema)

    def events(self) -> DataFrame:
        return self._read("events", lineage.EVENT_SCHEMA)

    def runs(self) -> DataFrame:
        return self._read("runs", lineage.RUN_SCHEMA)

    def _append(self, log: str, schema: T.StructType, rows: list[dict]) -> None:
        full = [tuple(row.get(name) for name in schema.names) for row in rows]
        self.spark.createDataFrame(full, schema).coalesce(1).write.mode("append").parquet(self.paths[log])

    def add_events(self, rows: list[dict], step: str) -> None:
        """Append events of one step of a batch. Their ids say batch, attempt, step and place, so events of one time are
        ordered by these, whatever clock the driver has."""
        if not rows:
            return
        batch_id = rows[0]["batch_id"]
        attempt = self.runs().where((F.col("batch_id") == batch_id) & (F.col("status") == "running")).count()
        first = _batch_number(batch_id) << 32 | min(attempt, 255) << 24 | STEPS.index(step) << 22
        self._append("events", lineage.EVENT_SCHEMA, [{"event_id": first + i, **row} for i, row in enumerate(rows)])

    def add_run(self, **row) -> None:
        self._append("runs", lineage.RUN_SCHEMA, [row])

    def succeeded(self, batch_id: str, layer: str) -> bool:
        asked = self.spark.createDataFrame([(batch_id, layer)], "batch_id string, layer string")
        return lineage.unfinished(asked, lineage.run_states(self.runs())).isEmpty()


def _batch_number(batch_id: str) -> int:
    """30 bits that tell batches apart."""
    return int.from_bytes(hashlib.md5(batch_id.encode()).digest()[:4], "big") >> 2


def _event(batch_id: str, source: Source, path: str, kind: str, at: dt.datetime, **more) -> dict:
    return {
        "batch_id": batch_id,
        "source_name": source.name,
        "source_file_path": path,
        "event_type": kind,
        "occurred_at": at,
        **more,
    }


class ConflictError(RuntimeError):
    """A file changed within a batch."""


def _schema_hashes(spark: SparkSession, loads: dict[str, DataFrame]) -> dict[str, str]:
    columns = [(name, f.name, f.dataType.simpleString()) for name, rows in loads.items() for f in rows.schema.fields]
    table = spark.createDataFrame(columns, "source_name string, name string, type string")
    return {r["source_name"]: r["schema_hash"] for r in schema_hash(table, ["source_name"]).collect()}


def _row_counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of stored tables, in one job that reads file footers only."""
    if not tables:
        return {}
    counts = union_by_name([t.agg(F.count("*").alias("n")).withColumn("name", F.lit(name)) for name, t in tables.items()])
    return {r["name"]: r["n"] for r in counts.collect()}


def _vendor_says(spark: SparkSession, raw_root: str) -> tuple[dict, dict[str, dict]]:
    """What the delivery's manifest says of itself, and by file name the sums of files that are not as listed."""
    manifest = load_manifest(spark, raw_root)
    if manifest is None:
        return {}, {}
    said = manifest.select("vendor", "dataset", "dataset_version", "vendor_last_updated").first().asDict()
    wrong = checksum_mismatches(manifest_files(manifest), file_fingerprints(spark, raw_root)).collect()  # at most a row per listed file
    return said, {r["file_name"]: {"listed_md5": r["listed_md5"], "computed_md5": r["computed_md5"]} for r in wrong}


def _drifts(spark: SparkSession, known: DataFrame, batch_id: str, bronze: str, rows: dict[str, DataFrame], digests: dict[str, str]) -> dict[str, str]:
    """For each source whose schema is not that of its last landing, the difference as JSON."""
    last = lineage.latest_ingestion(known.where(F.col("batch_id") != batch_id)).select("source_name", "schema_hash", "data_batch_id").collect()
    before, after = [], []
    for row in last:  # a row per source
        name, held = row["source_name"], row["data_batch_id"]
        changed = name in rows and row["schema_hash"] not in (None, digests[name])
        if changed and snapshots.path_exists(spark, snapshots.snapshot_path(bronze, name, held)):
            old = spark.read.parquet(snapshots.snapshot_path(bronze, name, held)).schema
            before += [(name, f.name, f.dataType.simpleString()) for f in old.fields]
            after += [(name, f.name, f.dataType.simpleString()) for f in rows[name].schema.fields]
    if not before:
        return {}
    tables = [spark.createDataFrame(t, "source_name string, name string, type string") for t in (before, after)]
    found = lineage.schema_drift(*tables).collect()
    return {r["source_name"]: json.dumps({k: v for k, v in r.asDict().items() if k != "source_name"}) for r in found}


@job
def land_batch(
    spark: SparkSession,
    lake: Lake,
    raw_root: str,
    batch_id: str,
    at: dt.datetime,
    sources: Iterable[Source] = ALL_SOURCES,
) -> dict[str, str]:
    """Land every source of a batch. Unchanged content is recorded, not kept again.

    A source is parsed once: its rows are written to staging while their count and fingerprint are observed, and the
    folder is then moved into place or dropped. So what lands is what was counted, even if the file is replaced
    meanwhile. Rows that do not fit the header go to the rejected sink as ``<source>_malformed``, and their count to
    the log. Where the delivery has a manifest, the vendor's version and time are logged, and so is every file whose
    md5 is not the listed one; the computed sum is the one that counts. A schema that differs from the last landing is
    logged with its difference. A source that fails does not keep the others from landing. Returns source ->
    written/skipped/failed.
    """
    ledger, bronze = Ledger(spark, lake), lake.layer("bronze")
    if ledger.succeeded(batch_id, "bronze"):
        return {}
    vendor, wrong_sums = _vendor_says(spark, raw_root)
    ledger.add_run(batch_id=batch_id, layer="bronze", status="running", occurred_at=at)
    declared = by_name(sources)
    staging = lake.layer(f"_staging/{uuid.uuid4().hex}")
    wholes, failures = together(spark, {n: lambda s=s: read_raw(spark, s, raw_root) for n, s in declared.items()})
    try:
        identities, more = together(spark, {n: lambda n=n, w=w: store_observed(w, f"{staging}/{n}") for n, w in wholes.items()})
        failures.update(more)
        loads = {n: parted(wholes[n])[0] for n in identities}

        known = cut_lineage(lineage.file_states(ledger.events()))
        own = {r["source_name"]: r["fingerprint"] for r in known.where(F.col("batch_id") == batch_id).collect()}
        for name in list(loads):
            if own.get(name) not in (None, identities[name].fingerprint):
                failures[name] = ConflictError(f"{name} was registered in batch {batch_id} with other content")
                del loads[name]

        held: dict[str, str | None] = {}
        if loads:
            arriving = spark.createDataFrame(
                [(batch_id, n, identities[n].fingerprint) for n in loads], "batch_id string, source_name string, fingerprint string"
            )
            found = snapshots.previously_landed(known, arriving).collect()  # a row per source
            held = {r["source_name"]: r["data_batch_id"] for r in found}

        def store(name: str) -> None:
            if identities[name].malformed_count:
                aside = parted(wholes[name])[1].withColumn("_dq_failure_reason", F.lit(f"malformed:{name}"))
                snapshots.write_rejected(aside, lake.root, f"{name}_malformed", batch_id)
            if held[name] is None:
                snapshots.publish_snapshot(spark, f"{staging}/{name}", bronze, name, batch_id)

        _, more = together(spark, {n: lambda n=n: store(n) for n in loads if held[n] is None or identities[n].malformed_count})
        failures.update(more)
    finally:
        snapshots.drop_folder(spark, staging)
    landed = [n for n in loads if n not in failures]
    digests = _schema_hashes(spark, loads) if loads else {}
    drifts = _drifts(spark, known, batch_id, bronze, loads, digests) if loads else {}
    counts = _row_counts({n: snapshots.read_snapshot(spark, bronze, n, held[n] or batch_id) for n in landed})

    events = []
    for name, source in declared.items():
        path = source.path(raw_root)
        wrong = wrong_sums.get(path.rsplit("/", 1)[-1])
        if name in loads:
            identity = identities[name]
            events += [
                _event(batch_id, source, path, "registered", at, status="registered", fingerprint=identity.fingerprint,
                       schema_hash=digests[name], payload=json.dumps(vendor) if vendor else None),
                _event(batch_id, source, path, "ingest_started", at, status="ingesting", row_count=identity.row_count + identity.malformed_count),
            ]
            if identity.malformed_count:
                events.append(_event(batch_id, source, path, "malformed_set_aside", at, row_count=identity.malformed_count))
            if wrong:
                events.append(_event(batch_id, source, path, "checksum_mismatch", at, payload=json.dumps(wrong)))
            if name in drifts:
                events.append(_event(batch_id, source, path, "schema_drift", at, payload=drifts[name]))
        if name in failures:
            events.append(_event(batch_id, source, path, "failed", at, status="failed"))
        else:
            events.append(
                _event(batch_id, source, path, "ingest_finished", at, status="ingested", row_count=counts[name],
                       data_batch_id=held[name] or batch_id)
            )
    ledger.add_events(events, "land")
    ledger.add_run(
        batch_id=batch_id,
        layer="bronze",
        status="failed" if failures else "success",
        rows_out=sum(counts[n] for n in landed if held[n] is None),
        error="; ".join(f"{n}: {e}" for n, e in failures.items())[:4000] or None,
        occurred_at=at,
    )
    return {n: "failed" if n in failures else "skipped" if held[n] else "written" for n in declared}


def bronze_tables(spark: SparkSession, lake: Lake, batch_id: str, sources: Iterable[Source]) -> dict[str, DataFrame | None]:
    """The snapshot of every source as of a batch, wherever it was written."""
    files = lineage.file_states(Ledger(spark, lake).events())
    asked = spark.createDataFrame([(s.name, batch_id) for s in sources], "source_name string, batch_id string")
    held = {r["source_name"]: r["data_batch_id"] for r in snapshots.resolve_snapshots(files, asked).collect()}
    bronze = lake.layer("bronze")
    there = {name: snapshots.existing_snapshot(spark, bronze, files, name, batch) for name, batch in held.items()}
    return {s.name: snapshots.read_snapshot(spark, bronze, s.name, there[s.name]) if there.get(s.name) else None for s in sources}


def register_lake(spark: SparkSession, lake: Lake) -> list[str]:
    """A temporary view over the latest snapshot of every refined and published table."""
    ledger = Ledger(spark, lake)
    first = ledger.runs().groupBy("layer", "batch_id").agg(F.min("occurred_at").alias("begun"))
    done = lineage.run_states(ledger.runs()).where("status = 'success'").select("layer", "batch_id").join(first, ["layer", "batch_id"])
    latest = {r["layer"]: r["b"] for r in done.groupBy("layer").agg(F.max_by("batch_id", F.struct("begun", "batch_id")).alias("b")).collect()}
    names = {"silver": ("dim_clubs", "dim_competitions", "dim_date", "dim_players", "fact_games", "fact_appearances"), "gold": tuple(a.name for a in gold.ARTIFACTS)}
    found = {}
    for layer, tables in names.items():
        for name in tables if layer in latest else ():
            there = snapshots.path_exists(spark, snapshots.snapshot_path(lake.layer(layer), name, latest[layer]))
            found[name] = snapshots.read_snapshot(spark, lake.layer(layer), name, latest[layer]) if there else None
    return snapshots.register_views(spark, found)


def batch_before(spark: SparkSession, lake: Lake, layer: str, batch_id: str) -> str | None:
    """The latest batch that was started before this one first was, and has succeeded in the layer."""
    ledger = Ledger(spark, lake)
    first = ledger.runs().where(F.col("layer") == layer).groupBy("batch_id").agg(F.min("occurred_at").alias("begun"))
    done = lineage.run_states(ledger.runs()).where((F.col("layer") == layer) & (F.col("status") == "success"))
    own = first.where(F.col("batch_id") == batch_id).first()
    candidates = done.join(first, "batch_id").where(F.col("batch_id") != batch_id)
    if own is not None:
        candidates = candidates.where(F.col("begun") < literal_like(first, "begun", own["begun"]))
    latest = candidates.orderBy(F.col("begun").desc(), F.col("batch_id").desc()).first()
    return latest["batch_id"] if latest else None


def _span(facts: Iterable[DataFrame], otherwise: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the facts."""
    days = []
    for table in facts:
        day = day_of(table, "date")
        days += [d for d in table.agg(F.min(day), F.max(day)).first() if d is not None]
    return (min(days), max(days)) if days else (otherwise, otherwise)


@job
def refine_batch(
    spark: SparkSession,
    lake: Lake,
    batch_id: str,
    batch_date: dt.date,
    at: dt.datetime,
    salt: str | None = None,
    sources: Iterable[Source] = ALL_SOURCES,
    rules: Iterable[quality.Rule] = QUALITY_RULES,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> dict[str, int]:
    """Check the batch, set failing rows aside, and build dimensions and facts. Returns rows per table.

    ``calendar`` is the range of ``dim_date``; by default it spans the facts of the batch.
    """
    ledger, silver = Ledger(spark, lake), lake.layer("silver")
    sources, rules = list(sources), list(rules)
    declared = by_name(sources)
    if ledger.succeeded(batch_id, "silver") and snapshots.path_exists(
        spark, snapshots.snapshot_path(silver, "dim_players", batch_id)
    ):
        return {}
    ledger.add_run(batch_id=batch_id, layer="silver", status="running", occurred_at=at)
    try:
        bronze = bronze_tables(spark, lake, batch_id, sources)
        clean, rejected, short = _check_batch(spark, lake, batch_id, bronze, sources, rules)

        def store(tables: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
            """Build and write tables side by side, and read back what was written."""
            _, errors = together(
                spark,
                {n: lambda n=n, build=build: snapshots.write_snapshot(build(), silver, n, batch_id) for n, build in tables.items()},
            )
            if errors:
                raise RuntimeError("; ".join(f"{n}: {e}" for n, e in errors.items()))
            return {n: snapshots.read_snapshot(spark, silver, n, batch_id) for n in tables}

        before = batch_before(spark, lake, "silver", batch_id)
        existing = snapshots.read_snapshot(spark, silver, "dim_players", before) if before else None
        merged = {}

        def players() -> DataFrame:
            merged["players"] = star.build_dim_players(clean["players"], existing, batch_date, declared["players"], salt)
            return merged["players"].dimension

        stored = store(
            {
                "dim_clubs": lambda: star.build_dim_clubs(clean["clubs"]),
                "dim_competitions": lambda: star.build_dim_competitions(clean["competitions"]),
                "dim_date": lambda: star.build_dim_date(spark, *(calendar or _span([clean["games"], clean["appearances"]], batch_date))),
                "dim_players": players,
                "fact_games": lambda: star.build_fact_games(clean["games"]),
            }
        )
        appearances = clean["appearances"]
        if salt is not None:
            appearances = tokenize_columns(appearances, declared["appearances"].pii_columns, salt)
        stored |= store({"fact_appearances": lambda: star.build_fact_appearances(appearances, stored["dim_players"])})
        rows = _row_counts(stored)
        counts = merged["players"].stats.first()
        silver_rows = {
            "clubs": rows["dim_clubs"],
            "competitions": rows["dim_competitions"],
            "games": rows["fact_games"],
            "appearances": rows["fact_appearances"],
            # History and absent keys are no rows of this batch.
            "players": counts["new_versions"] + counts["changed_versions"] + counts["unchanged_versions"],
        }

        events = []
        for name, path in _paths(ledger, batch_id):
            source = declared[name]
            events.append(_event(batch_id, source, path, "dq_completed", at, row_count=rejected.get(name)))
            if name in short:
                events.append(_event(batch_id, source, path, "below_minimum_rows", at, row_count=short[name]["rows_in"], payload=json.dumps(short[name])))
            if name in silver_rows:
                events.append(_event(batch_id, source, path, "silver_started", at, status="transforming"))
                events.append(
                    _event(batch_id, source, path, "silver_finished", at, status="transformed", row_count=silver_rows[name])
                )
        ledger.add_events(events, "refine")
    except Exception as error:
        ledger.add_run(batch_id=batch_id, layer="silver", status="failed", error=str(error)[:4000], occurred_at=at)
        raise
    ledger.add_run(batch_id=batch_id, layer="silver", status="success", rows_out=sum(rows.values()), occurred_at=at)
    return rows


def _paths(ledger: Ledger, batch_id: str) -> list[tuple[str, str]]:
    """(source, file) pairs of a batch; one per declared source."""
    files = lineage.files_of_batch(lineage.file_states(ledger.events()), batch_id)
    return [(r["source_name"], r["source_file_path"]) for r in files.select("source_name", "source_file_path").collect()]


def _check_batch(spark, lake, batch_id, bronze, sources, rules) -> tuple[dict[str, DataFrame], dict[str, int], dict[str, dict]]:
    """Annotate each table once, write what failed and the report.

    Returns clean rows, reject counts, and what is known of sources with fewer rows than declared (Q13).
    """
    targets = {
        (name, column): bronze[name].select(column)
        for name, column in foreign_key_targets(rules)
        if bronze.get(name) is not None and column in bronze[name].columns
    }

    def check(name: str):
        own = rules_for(name, rules)
        annotated = cut_lineage(quality.annotate(bronze[name].drop("batch_id"), own, targets))
        counts = quality.count_failures(annotated, own)
        row = counts.first()  # one row of numbers, from which the report is made without another pass
        counted, rejected = spark.createDataFrame([row], counts.schema), row["rows_quarantined"]
        if rejected:
            snapshots.write_rejected(quality.failing_rows(annotated, own), lake.root, name, batch_id)
        return annotated, counted, rejected

    done, failed = together(spark, {s.name: lambda n=s.name: check(n) for s in sources if bronze.get(s.name) is not None})
    if failed:
        raise RuntimeError("; ".join(f"quality of {n}: {e}" for n, e in failed.items()))
    short = {}
    if done:
        totals = union_by_name([quality.source_totals(c, n) for n, (_, c, _) in done.items()])
        minimums = {s.name: s.expected_min_rows for s in sources if s.expected_min_rows}
        if minimums:
            missed = quality.below_minimum(totals, minimums).collect()  # at most a row per source
            short = {r["source_name"]: {"rows_in": r["rows_in"], "expected_min_rows": r["expected_min_rows"], "severity": r["severity"]} for r in missed}
        outcomes = union_by_name([quality.outcomes(c, rules_for(n, rules), n) for n, (_, c, _) in done.items()])
        quality_report.write_report(quality_report.batch_report(totals, outcomes, batch_id), lake.layer("dq_reports"), batch_id)
    clean = {n: quality.clean_rows(a, rules_for(n, rules)) for n, (a, _, _) in done.items()}
    return clean, {n: rejected for n, (_, _, rejected) in done.items()}, short


class GateError(RuntimeError):
    """Too much of a batch was quarantined."""


def check_gate(spark: SparkSession, lake: Lake, batch_id: str, threshold_pct: float = quality_report.GATE_THRESHOLD_PCT) -> dict:
    """Q11: raise where the batch must not be published."""
    decision = quality_report.gate_of_batch(spark, lake.layer("dq_reports"), batch_id, threshold_pct).first().asDict()
    if decision["decision"] == "fail":
        raise GateError(
            f"batch {batch_id}: {decision['critical_failures']} critical rules failed and"
            f" {decision['quarantine_pct']:.2f}% of the rows are quarantined (threshold {threshold_pct}%)"
        )
    return decision


def _reconcile_batch(ledger: Ledger, batch_id: str, at: dt.datetime) -> None:
    """Close a batch with a ``reconciled`` event per file that counts the findings over its row counts."""
    files = lineage.files_of_batch(lineage.file_states(ledger.events().where(F.col("batch_id") == batch_id)), batch_id)
    keys = ("batch_id", "source_name", "source_file_path")
    found = lineage.reconciliation_events(files).collect()  # a row per source
    ledger.add_events([{**{k: r[k] for k in keys}, "event_type": "reconciled", "row_count": r["finding_count"], "payload": r["payload"], "occurred_at": at} for r in found], "reconcile")


@job
def publish_batch(spark: SparkSession, lake: Lake, batch_id: str, at: dt.datetime) -> dict[str, int]:
    """Build every gold table from the batch's own snapshot of the star schema."""
    ledger, silver = Ledger(spark, lake), lake.layer("silver")
    if ledger.succeeded(batch_id, "gold"):
        return {}
    ledger.add_run(batch_id=batch_id, layer="gold", status="running", occurred_at=at)
    declared = by_name()
    tables = {
        name: snapshots.read_snapshot(spark, silver, name, batch_id)
        for name in ("fact_appearances", "fact_games", "dim_players", "dim_clubs")
    }
    valuations = bronze_tables(spark, lake, batch_id, [declared["player_valuations"]])["player_valuations"]
    tables["bronze_player_valuations"] = valuations
    root = lake.layer("gold")
    written, errors = together(
        spark,
        {
            a.name: lambda a=a: snapshots.write_snapshot(gold.presented(a, a.build(*[tables[i] for i in a.inputs])), root, a.name, batch_id)
            for a in gold.ARTIFACTS
        },
    )
    rows = _row_counts({n: snapshots.read_snapshot(spark, root, n, batch_id) for n in written})
    events = [
        _event(batch_id, declared[name], path, "gold_finished", at, row_count=rows[a.name], payload=f'{{"artifact": "{a.name}"}}')
        for name, path in _paths(ledger, batch_id)
        for a in gold.ARTIFACTS
        if a.primary_source == name and a.name in rows
    ]
    ledger.add_events(events, "publish")
    if not errors:
        _reconcile_batch(ledger, batch_id, at)
    ledger.add_run(
        batch_id=batch_id,
        layer="gold",
        status="failed" if errors else "success",
        rows_out=sum(rows.values()),
        error="; ".join(f"{n}: {e}" for n, e in errors.items())[:4000] or None,
        occurred_at=at,
    )
    if errors:
        raise RuntimeError("; ".join(f"{n}: {e}" for n, e in errors.items()))
    return rows
