"""Rules, reports, gate, lineage and storage on hand-written rows."""

import datetime as dt
import hashlib
import json
import os
import random

import pandas as pd
import pytest

from strataflow.functions.hashing import content_fingerprint
from strataflow.operators import quality
from strataflow.operators.quality import CRITICAL, REASON, WARNING, ForeignKey, HasColumns, NotNull, Range, Unique
from strataflow.plans import lineage, quality_report
from strataflow.sources import catalogue, manifest, readers, records, snapshots


def failed(df, rule, references=None):
    annotated = quality.annotate(df, [rule], references)
    return sorted(r["id"] for r in annotated.where(quality.flag_name(rule, [rule])).collect())


def test_rules_on_nulls_and_odd_values(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, 5.0, "7", "a"), (2, None, None, None), (3, nan, "x", "a"), (4, 11.0, "-1", "b"), (5, 0.0, "7.5", None)], "id int, v double, t string, k string"
    )
    assert failed(df, NotNull("s", CRITICAL, ("v", "k"))) == [2, 3, 5]
    assert failed(df, NotNull("s", CRITICAL, ("absent",))) == [1, 2, 3, 4, 5]
    assert failed(df, Range("s", CRITICAL, "v", 0, 10)) == [4]
    assert failed(df, Range("s", CRITICAL, "t", 0, None)) == [3, 4]
    assert failed(df, Range("s", CRITICAL, "absent", 0, 1)) == []
    assert failed(df, Unique("s", CRITICAL, ("k",))) == [1, 2, 3, 5]
    assert failed(df, Unique("s", CRITICAL, ("k", "id"))) == []
    assert failed(df, Unique("s", CRITICAL, ("absent",))) == [1, 2, 3, 4, 5]
    assert failed(df, HasColumns("s", CRITICAL, ("id", "v"))) == []
    assert failed(df, HasColumns("s", CRITICAL, ("id", "w"))) == [1, 2, 3, 4, 5]


def test_foreign_key_targets(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "b")], "id int, k string")
    rule = ForeignKey("s", CRITICAL, "k", "t", "key")
    target = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    assert failed(df, rule, {("t", "key"): target}) == [2, 4]
    assert failed(df, rule, {("t", "key"): target.where("false")}) == [1, 2, 4]
    assert failed(df, rule, {}) == []
    assert rule.rule_id == "foreign_key:s.k->t.key"


def test_split_report_and_gate(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 50), (2, None, 50), (3, "c", 1)], "id int, k string, v int")
    rules = [Unique("s", CRITICAL, ("id",)), NotNull("s", CRITICAL, ("k",)), Range("s", WARNING, "v", 0, 10)]
    annotated = quality.annotate(df, rules)
    assert quality.clean_rows(annotated, rules).columns == df.columns
    assert [r["id"] for r in quality.clean_rows(annotated, rules).collect()] == [3]
    reasons = {(r["id"], r["k"]): r[REASON] for r in quality.failing_rows(annotated, rules).collect()}
    assert reasons == {(1, "a"): "unique:s:id", (1, "b"): "unique:s:id", (2, None): "not_null:s:k"}
    counted = quality.count_failures(annotated, rules)
    found = quality.outcomes(counted, rules, "s")
    assert {r["rule_id"]: (r["rows_failed"], r["pass_rate"]) for r in found.collect()} == {
        "unique:s:id": (2, 0.5), "not_null:s:k": (1, 0.75), "range:s:v": (2, 0.5),
    }
    summary = quality_report.batch_summary(quality.source_totals(counted, "s"), found, "b").first()
    assert (summary["total_rows_in"], summary["total_rows_quarantined"], summary["critical_failure_count"], summary["warning_count"]) == (4, 3, 2, 1)
    assert summary["sources_with_critical_failures"] == ["s"]


@pytest.mark.parametrize("critical,quarantined,threshold,decision", [(1, 6, 5.0, "fail"), (1, 5, 5.0, "pass"), (0, 50, 5.0, "pass"), (2, 6, 10.0, "pass")])
def test_gate_is_strict_and_needs_both(spark, critical, quarantined, threshold, decision):
    summary = spark.createDataFrame(
        [("b", critical, quarantined, 100)], "batch_id string, critical_failure_count long, total_rows_quarantined long, total_rows_in long"
    )
    assert quality_report.gate(summary, threshold).first()["decision"] == decision


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1,)], "id int")
    plain = quality.annotate(df, [])
    assert quality.clean_rows(plain, []).count() == 1 and quality.failing_rows(plain, []).count() == 0
    assert quality.outcomes(quality.count_failures(plain, []), [], "s").count() == 0
    rules = [NotNull("s", CRITICAL, ("id",))]
    empty = quality.annotate(df.where("false"), rules)
    assert quality.outcomes(quality.count_failures(empty, rules), rules, "s").count() == 0


def test_catalogue():
    assert len(catalogue.QUALITY_RULES) == 27
    count = {s.name: len(catalogue.rules_for(s.name)) for s in catalogue.ALL_SOURCES}
    assert count == {"competitions": 2, "clubs": 4, "players": 4, "games": 7, "appearances": 7, "player_valuations": 3}
    assert [s.name for s in catalogue.scd2_sources()] == ["players"]
    assert [s.name for s in catalogue.incremental_sources()] == ["games", "player_valuations"]
    assert {s.name for s in catalogue.pii_sources()} == {"players", "appearances"}
    assert len(catalogue.schema_rules()) == 6
    with pytest.raises(ValueError):
        catalogue.by_name([catalogue.CLUBS, catalogue.CLUBS])
    with pytest.raises(ValueError):
        catalogue.Source("s", ("absent",), {"a": "int"})


def test_csv_with_quotes_and_commas(spark, tmp_path):
    (tmp_path / "players.csv").write_text('id,country,note\n1,"England, United Kingdom","say ""hi"""\n2,NA,\n', encoding="utf-8")
    rows = readers.read_csv(spark, str(tmp_path / "players.csv"), {"id": "int"}).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "England, United Kingdom", 'say "hi"'), (2, None, None)]


def test_csv_with_line_breaks_and_rows_that_do_not_fit(spark, tmp_path):
    text = 'id,note,n\n1,"two\nlines",5\n2,short\n3,a,4,too many\n4,"x, ""y""",6\n'
    (tmp_path / "notes.csv").write_text(text, encoding="utf-8")
    rows, malformed = readers.csv_parts(spark, str(tmp_path / "notes.csv"), {"id": "int", "n": "int"})
    assert sorted(map(tuple, rows.collect())) == [(1, "two\nlines", 5), (2, "short", None), (4, 'x, "y"', 6)]
    assert [r["malformed"] for r in malformed.collect()] == ["3,a,4,too many"]
    assert (rows.count(), malformed.count()) == (3, 1)


def test_csv_rows_with_empty_values_before_a_stray_one(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,n\n1,2,,x\n2,3,\n3\n4,"5\n5,6\n6,7,"a, b",c\n', encoding="utf-8")
    rows, malformed = readers.csv_parts(spark, str(tmp_path / "a.csv"), {"id": "int"}, multiline=False)
    assert sorted((r["id"], r["n"]) for r in rows.where("id <> 4").collect()) == [(2, "3"), (3, None), (5, "6")]
    assert sorted(r["malformed"] for r in malformed.collect()) == ["1,2,,x", '6,7,"a, b",c']
    assert rows.count() + malformed.count() == 6


def test_load_counts_rows_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n1,2\n2,3,4\n", encoding="utf-8")
    source = catalogue.Source("a", ("id",), {"id": "int", "n": "int"})
    load = readers.load_source(spark, source, str(tmp_path))
    assert (load.row_count, load.malformed_count, [r["malformed"] for r in load.malformed.collect()]) == (1, 1, ["2,3,4"])
    (tmp_path / "a.csv").write_text("id,n\n1,2\n2,3,5\n", encoding="utf-8")
    assert readers.load_source(spark, source, str(tmp_path)).fingerprint != load.fingerprint


def test_files_of_any_size_are_streamed(spark, tmp_path):
    whole = os.urandom(1000)
    (tmp_path / "a b.csv").write_text("abc")
    (tmp_path / "b.csv").write_bytes(whole)
    (tmp_path / "empty").write_text("")
    got = {r["file_name"]: r["checksum_md5"] for r in readers.file_fingerprints(spark, str(tmp_path), chunk=7).collect()}
    assert got == {"a b.csv": "900150983cd24fb0d6963f7d28e17f72", "b.csv": hashlib.md5(whole).hexdigest()}  # Spark lists no empty files


@pytest.mark.parametrize("split", ["128m", "97b", "1000b"])
def test_hostile_csv_reads_as_pandas_does(spark, tmp_path, split):
    """Quoted line breaks, stray quotes, escaped quotes and carriage returns, in ranges of any size."""
    draw = random.Random(7)
    pieces = ["a", ",", '"', "\n", "\r\n", "é", " ", "x,y", '""', "line\nline\nline", "long " * 40]
    rows = []
    for i in range(300):
        value = "".join(draw.choices(pieces, k=draw.randint(1, 6)))
        plain = draw.choice(['5" pipe', "it's", 'a"b"c', "word", ""])
        rows.append((str(i), value, plain))
    quoted = "\n".join(f'{i},"{v.replace(chr(34), chr(34) * 2)}",{p}' for i, v, p in rows)
    (tmp_path / "a.csv").write_bytes(f"id,value,plain\n{quoted}\n\n".encode())
    want = pd.read_csv(tmp_path / "a.csv", dtype=str, keep_default_na=False, lineterminator="\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got, malformed = readers.csv_parts(spark, str(tmp_path / "a.csv"))
        got = {r["id"]: (r["value"], r["plain"]) for r in got.collect()}
        assert malformed.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert got == {r.id: (r.value, r.plain or None) for r in want.itertuples()}


def test_a_quote_that_never_closes_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,n\n1,"two\n3,4\n')
    with pytest.raises(records.UnclosedQuote):
        readers.csv_parts(spark, str(tmp_path / "a.csv"))


def test_one_pass_gives_rows_and_identity(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,n\n1,2\n2,3,4\n5,"a\nb"\n')
    whole = readers.csv_rows(spark, str(tmp_path / "a.csv"), {"id": "int"})
    identity = readers.store_observed(whole, str(tmp_path / "staged"))
    stored = spark.read.parquet(str(tmp_path / "staged"))
    assert sorted(map(tuple, stored.collect())) == [(1, "2"), (5, "a\nb")]
    own = content_fingerprint(stored).first()["fingerprint"]
    aside = content_fingerprint(readers.parted(whole)[1]).first()["fingerprint"]
    assert identity == readers.Identity(2, 1, hashlib.md5(f"{own}|{aside}".encode()).hexdigest())


def test_reading_parquet_leaves_the_session_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "a int, day string").write.partitionBy("day").parquet(path)
    before = dict(spark.sparkContext.getConf().getAll())
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        table = readers.read_parquet(spark, path, path)
        assert dict(table.dtypes) == {"a": "int", "day": "string"}
        assert sorted(map(tuple, table.collect())) == [(1, "2024-01-01"), (2, "2024-01-02")]
        assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    assert before == dict(spark.sparkContext.getConf().getAll())


def test_manifest(spark, tmp_path):
    assert manifest.load_manifest(spark, str(tmp_path)) is None
    good = {
        "manifest_version": 1, "vendor": "v", "dataset": "d", "dataset_version": 47, "vendor_last_updated": "t", "fetched_at": "t",
        "files": {"a.csv": {"size_bytes": 3, "checksum_md5": "900150983cd24fb0d6963f7d28e17f72"}, "b.csv": {"size_bytes": 1, "checksum_md5": "0"}},
    }
    path = tmp_path / manifest.MANIFEST_NAME
    path.write_text(json.dumps(good))
    (tmp_path / "a.csv").write_text("abc")
    (tmp_path / "b.csv").write_text("b")
    listed = manifest.manifest_files(manifest.load_manifest(spark, str(tmp_path)))
    computed = readers.file_fingerprints(spark, str(tmp_path))
    assert [r["file_name"] for r in manifest.checksum_mismatches(listed, computed).collect()] == ["b.csv"]
    sizes = {r["file_name"]: r["size_bytes"] for r in computed.collect()}
    assert sizes["a.csv"] == 3
    for broken in ("{", "[]", json.dumps({**good, "manifest_version": 2}), json.dumps({**good, "extra": 1}),
                   json.dumps({k: v for k, v in good.items() if k != "vendor"}), json.dumps({**good, "files": {"a": {"size_bytes": "x"}}})):
        path.write_text(broken)
        with pytest.raises(manifest.ManifestError):
            manifest.load_manifest(spark, str(tmp_path))


def test_batch_ids_name_folders(spark, tmp_path):
    with pytest.raises(ValueError):
        snapshots.snapshot_path(str(tmp_path), "t", "../x")
    with pytest.raises(ValueError):
        snapshots.write_table(spark.range(1), str(tmp_path / "x"), mode="replace")


def files(spark, *rows):
    return spark.createDataFrame(rows, "batch_id string, source_name string, fingerprint string, registered_at int, status string, data_batch_id string")


def test_resolution_goes_by_time_not_by_name(spark):
    known = files(
        spark,
        ("day-1", "clubs", "c1", 1, "ingested", None),
        ("2026-06-02", "clubs", "c1", 2, "ingested", "day-1"),
        ("manual", "clubs", "c2", 3, "failed", None),
        ("2026-06-02", "games", "g1", 2, "ingested", None),
        ("day-9", "games", "g2", 9, "transformed", None),
    )
    asked = spark.createDataFrame(
        [("clubs", "2026-06-02"), ("clubs", "manual"), ("games", "manual"), ("games", "day-1"), ("games", "unknown"), ("players", "day-1")],
        "source_name string, batch_id string",
    )
    got = {(r["source_name"], r["batch_id"]): r["data_batch_id"] for r in snapshots.resolve_snapshots(known, asked).collect()}
    assert got == {
        ("clubs", "2026-06-02"): "day-1", ("clubs", "manual"): "day-1", ("games", "manual"): "2026-06-02",
        ("games", "day-1"): None, ("games", "unknown"): "day-9", ("players", "day-1"): None,
    }
    arriving = spark.createDataFrame(
        [("day-10", "clubs", "c1"), ("day-1", "clubs", "c1"), ("day-10", "clubs", "c2"), ("day-10", "players", "c1")],
        "batch_id string, source_name string, fingerprint string",
    )
    held = {tuple(r)[:3]: r["data_batch_id"] for r in snapshots.previously_landed(known, arriving).collect()}
    assert held == {("day-10", "clubs", "c1"): "day-1", ("day-1", "clubs", "c1"): "day-1", ("day-10", "clubs", "c2"): None, ("day-10", "players", "c1"): None}


def event(i, kind, status=None, **more):
    row = {"event_id": i, "batch_id": "b", "source_name": "s", "source_file_path": "f", "event_type": kind, "status": status,
           "occurred_at": dt.datetime(2024, 1, 1, 0, i), **more}
    return tuple(row.get(n) for n in lineage.EVENT_SCHEMA.names)


def test_lifecycle_and_reconciliation(spark):
    events = spark.createDataFrame(
        [
            event(1, "registered", "registered", fingerprint="x"),
            event(2, "ingest_started", "ingesting", row_count=100),
            event(3, "ingest_finished", "ingested", row_count=101),
            event(4, "dq_completed", row_count=10),
            event(5, "silver_finished", "transformed", row_count=0),
            event(6, "registered", "registered", fingerprint="y"),
        ],
        lineage.EVENT_SCHEMA,
    )
    illegal = [(r["previous_status"], r["status"]) for r in lineage.illegal_transitions(events).orderBy("event_id").collect()]
    assert illegal == [("ingested", "transformed"), ("transformed", "registered")]
    assert lineage.content_conflicts(events).count() == 1
    found = {(r["severity"], r["code"]) for r in lineage.reconcile(lineage.file_states(events)).collect()}
    assert found == {
        ("CRITICAL", "bronze_inflated"), ("CRITICAL", "row_count_drift"), ("CRITICAL", "complete_silver_loss"),
        ("WARN", "high_reject_rate"), ("WARN", "non_terminal_status"),
    }


def test_a_retry_clears_the_end_of_a_run(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [("b", "silver", "running", None, None, None, at(1)), ("b", "silver", "failed", None, None, "x" * 5000, at(2)), ("b", "silver", "running", None, None, None, at(3)),
            ("c", "silver", "running", None, None, None, at(1)), ("c", "silver", "success", 5, 4, None, at(1))]
    states = {r["batch_id"]: r for r in lineage.run_states(spark.createDataFrame(rows, lineage.RUN_SCHEMA)).collect()}
    assert (states["b"]["status"], states["b"]["finished_at"], states["b"]["error"]) == ("running", None, None)
    assert (states["c"]["status"], states["c"]["rows_out"]) == ("success", 4)
