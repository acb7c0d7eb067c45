"""Three batches through all layers, against the values known for this data."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

import football
from strataflow.operators.asof import nested_versions
from strataflow.plans import gold, lineage, medallion
from strataflow.session import scratch_path
from strataflow.sources import snapshots
from strataflow.sources.snapshots import path_exists, read_snapshot, snapshot_path

DAYS = {
    1: ("day-1", dt.date(2016, 10, 15)),
    2: ("2016-11-10", dt.date(2016, 11, 10)),
    3: ("day-3", dt.date(2016, 12, 20)),
}


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("lake")
    lake = medallion.Lake(str(home / "lake"))
    out = {"lake": lake}
    for day, (batch, date) in DAYS.items():
        at = dt.datetime(2025, 3, day, 6)
        raw = football.deliver(home / f"raw{day}", day)
        out[day] = {
            "bronze": medallion.land_batch(spark, lake, raw, batch, at),
            "silver": medallion.refine_batch(spark, lake, batch, date, at),
            "gate": medallion.check_gate(spark, lake, batch),
            "gold": medallion.publish_batch(spark, lake, batch, at),
            "raw": raw,
        }
    return out


def silver(spark, runs, name, day):
    return read_snapshot(spark, runs["lake"].layer("silver"), name, DAYS[day][0])


def gold_table(spark, runs, name, day):
    return read_snapshot(spark, runs["lake"].layer("gold"), name, DAYS[day][0])


def test_first_day_row_counts(runs):
    assert set(runs[1]["bronze"].values()) == {"written"}
    assert runs[1]["silver"] == {
        "dim_clubs": 5,
        "dim_competitions": 2,
        "dim_date": 190,  # from the first to the last day of the facts
        "dim_players": 10,
        "fact_games": 5,
        "fact_appearances": 20,
    }
    assert [runs[1]["gold"][a.name] for a in gold.ARTIFACTS] == [18, 9, 10, 36, 5]


def test_orphan_is_set_aside_with_its_reason(spark, runs):
    rejected = read_snapshot(spark, runs["lake"].root + "/_rejected", "appearances", "day-1").collect()
    assert [(r["player_id"], r["_dq_failure_reason"]) for r in rejected] == [
        (football.UNKNOWN, "foreign_key:appearances.player_id->players.player_id")
    ]
    assert not path_exists(spark, snapshot_path(runs["lake"].root + "/_rejected", "games", "day-1"))


def test_gate_passes_on_a_single_orphan(runs):
    decision = runs[1]["gate"]
    assert (decision["decision"], decision["critical_failures"], decision["rows_quarantined"]) == ("pass", 1, 1)
    assert decision["quarantine_pct"] == round(100 / sum(len(rows) for rows in football.tables(1).values()), 2)


def test_gate_raises_over_the_threshold(spark, runs):
    with pytest.raises(medallion.GateError):
        medallion.check_gate(spark, runs["lake"], "day-1", threshold_pct=1.0)
    assert medallion.check_gate(spark, runs["lake"], "no-such-batch")["decision"] == "pass_no_report"


def test_gold_golden_values(spark, runs):
    scorers = gold_table(spark, runs, "top_scorers_by_season", 1)
    best = scorers.agg(F.max("total_goals").alias("m")).first()["m"]
    assert best == 3
    assert {r["player_id"] for r in scorers.where("total_goals = 3").collect()} == {302}
    lifetime = {r["player_id"]: r for r in gold_table(spark, runs, "top_players_all_time", 1).collect()}
    assert (lifetime[302]["total_goals"], lifetime[302]["appearance_count"]) == (4, 2)
    assert (lifetime[404]["total_goals"], lifetime[404]["seasons_played"]) == (2, 2)
    assert (lifetime[302]["country_of_citizenship_iso"], lifetime[306]["country_of_citizenship_iso"]) == ("SE", "XX")
    table = {(r["club_id"], r["season"]): r for r in gold_table(spark, runs, "club_season_summary", 1).collect()}
    got = {
        c: tuple(r[k] for k in ("matches_played", "wins", "draws", "losses", "goals_for", "goals_against", "points"))
        for c, r in table.items()
    }
    assert got == {
        (11, "2015-16"): (1, 1, 0, 0, 3, 1, 3),
        (12, "2015-16"): (2, 0, 1, 1, 1, 3, 1),
        (13, "2015-16"): (1, 0, 1, 0, 0, 0, 1),
        (11, "2016-17"): (1, 1, 0, 0, 4, 2, 3),
        (13, "2016-17"): (1, 0, 0, 1, 2, 4, 0),
        (21, "2015-16"): (1, 0, 0, 1, 1, 2, 0),
        (22, "2015-16"): (1, 1, 0, 0, 2, 1, 3),
        (21, "2016-17"): (1, 0, 0, 0, 0, 0, 0),  # a match without a score
        (22, "2016-17"): (1, 0, 0, 0, 0, 0, 0),
    }
    sheets = {r["club_id"]: r["clean_sheets"] for r in gold_table(spark, runs, "club_performance_metrics", 1).collect()}
    assert sheets == {11: 0, 12: 1, 13: 1, 21: 1, 22: 1}
    rolling = gold_table(spark, runs, "player_valuation_rolling_avg", 1)
    assert rolling.where("player_sk is null").count() == 0
    one = rolling.where("player_id = 301").orderBy("date").collect()  # 1, 4, 7 and 10 million
    assert [r["rolling_avg_90_rows"] for r in one] == [1e6, 2.5e6, 4e6, 5.5e6]
    assert [r["rolling_sample_count"] for r in one] == [1, 2, 3, 4]


def test_second_day_skips_what_did_not_change(spark, runs):
    assert runs[2]["bronze"] == {
        "competitions": "skipped",
        "clubs": "skipped",
        "players": "written",
        "games": "written",
        "appearances": "written",
        "player_valuations": "skipped",
    }
    bronze = runs["lake"].layer("bronze")
    assert not path_exists(spark, snapshot_path(bronze, "clubs", "2016-11-10"))
    assert runs[3]["bronze"]["games"] == "skipped"
    resolved = medallion.bronze_tables(spark, runs["lake"], "day-3", medallion.ALL_SOURCES)
    assert {r["batch_id"] for r in resolved["clubs"].select("batch_id").collect()} == {"day-1"}
    assert {r["batch_id"] for r in resolved["games"].select("batch_id").collect()} == {"2016-11-10"}


def test_second_day_versions(spark, runs):
    dim = silver(spark, runs, "dim_players", 2)
    assert dim.count() == 12
    versions = {r["player_id"]: r["count"] for r in dim.groupBy("player_id").count().collect()}
    assert {p for p, n in versions.items() if n == 2} == {football.MOVED, football.RELABELLED}
    moved = dim.where(F.col("player_id") == football.MOVED).orderBy("player_sk").collect()
    assert [(r["player_sk"], r["current_club_id"], str(r["effective_date"]), str(r["end_date"]), r["is_current"]) for r in moved] == [
        (4, 12, "1900-01-01", "2016-11-10", False),
        (11, 13, "2016-11-10", "9999-12-31", True),
    ]
    # A new raw label opens a version although the canonical position is the same.
    assert dim.where(F.col("player_id") == football.RELABELLED).select("position_canonical").distinct().count() == 1


def test_events_keep_the_version_of_their_day(spark, runs):
    played = {
        (str(r["date"]), r["player_sk"])
        for r in silver(spark, runs, "fact_appearances", 2).where(F.col("player_id") == football.MOVED).collect()
    }
    assert ("2016-03-06", 4) in played and ("2016-11-20", 11) in played


def test_every_fact_has_its_day(spark, runs):
    days = silver(spark, runs, "dim_date", 2)
    for name in ("fact_games", "fact_appearances"):
        assert silver(spark, runs, name, 2).join(days, "date_key", "left_anti").isEmpty()


def test_third_day_reads_one_snapshot_and_keeps_absent_players(spark, runs):
    dim = silver(spark, runs, "dim_players", 3)
    assert dim.count() == 13  # one more change; the absent player stays
    assert dim.where("is_current").count() == 10
    assert dim.where((F.col("player_id") == football.ABSENT) & F.col("is_current")).count() == 1
    assert dim.select("player_sk").distinct().count() == 13
    # Totals must not grow with the number of batches.
    lifetime = gold_table(spark, runs, "top_players_all_time", 3)
    goals = lifetime.agg(F.sum("total_goals").alias("s")).first()["s"]
    # The appearances of the player absent on day three fail their foreign key.
    expected = sum(g for *_, p, _, g, _, _ in football.appearances(3) if p not in (football.UNKNOWN, football.ABSENT))
    assert goals == expected


def test_history_never_changes(spark, runs):
    before = silver(spark, runs, "dim_players", 2).where("not is_current").drop("batch_id")
    after = silver(spark, runs, "dim_players", 3).where("not is_current").drop("batch_id")
    assert before.exceptAll(after.select(*before.columns)).isEmpty()
    assert nested_versions(silver(spark, runs, "dim_players", 3), ["player_id"], "effective_date", "end_date", "player_sk").isEmpty()


def test_rerun_is_a_no_op(spark, runs):
    lake = runs["lake"]
    assert medallion.land_batch(spark, lake, runs[2]["raw"], "2016-11-10", dt.datetime(2025, 4, 1)) == {}
    assert medallion.refine_batch(spark, lake, "2016-11-10", dt.date(2016, 11, 10), dt.datetime(2025, 4, 1)) == {}
    assert medallion.publish_batch(spark, lake, "2016-11-10", dt.datetime(2025, 4, 1)) == {}
    # The state to merge into is the one before the batch, not the latest.
    assert medallion.batch_before(spark, lake, "silver", "2016-11-10") == "day-1"
    assert medallion.batch_before(spark, lake, "silver", "day-1") is None


def test_lineage_reconciles(spark, runs):
    events = medallion.Ledger(spark, runs["lake"]).events()
    assert lineage.illegal_transitions(events).isEmpty()
    assert lineage.content_conflicts(events).isEmpty()
    files = lineage.file_states(events)
    findings = [(r["source_name"], r["code"]) for r in lineage.reconcile(lineage.files_of_batch(files, "day-1")).collect()]
    assert findings == [("player_valuations", "non_terminal_status")]
    row = files.where("batch_id = 'day-1' and source_name = 'appearances'").first()
    assert (row["source_row_count"], row["bronze_row_count"], row["rejected_row_count"], row["silver_row_count"]) == (21, 21, 1, 20)


def test_explorations_run(spark, runs):
    scorers = gold_table(spark, runs, "top_scorers_by_season", 3)
    assert gold.top_scorers(scorers).count() == 10
    assert gold.totals_by_position(scorers).where("position_canonical = 'Goalkeeper'").count() == 1
    best = {r["club"]: r["player_name"] for r in gold.best_scorer_per_club(gold_table(spark, runs, "top_scorers_by_season", 1)).collect()}
    assert (best["Fjordvik"], best["Portovelho"]) == ("Bo Lyng", "Jaime Rua")
    assert len(best) == 5
    assert gold.version_storage(silver(spark, runs, "dim_players", 3)).count() == 10
    assert gold.standings(gold_table(spark, runs, "club_season_summary", 1)).first()["club_name"] == "Fjordvik"
    assert gold.valuation_trend(gold_table(spark, runs, "player_valuation_rolling_avg", 3), silver(spark, runs, "dim_players", 3)).count() == 36


def test_jobs_leave_nothing_behind(spark, runs):
    root = scratch_path(spark, "x").rsplit("/", 1)[0]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    left = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    assert not [name for name in left if name.startswith("job-")]


def test_views_show_the_latest_snapshots(spark, runs):
    made = medallion.register_lake(spark, runs["lake"])
    assert {"dim_players", "fact_games", "club_season_summary"} <= set(made)
    assert spark.sql("SELECT count(*) FROM dim_players").first()[0] == 13


def test_a_missing_folder_is_looked_for_in_other_batches(spark, runs):
    files = lineage.file_states(medallion.Ledger(spark, runs["lake"]).events())
    bronze = runs["lake"].layer("bronze")
    assert snapshots.existing_snapshot(spark, bronze, files, "clubs", "day-3") == "day-1"
    assert snapshots.existing_snapshot(spark, bronze + "/elsewhere", files, "clubs", "day-3") is None


def test_gold_is_stored_in_its_order(spark, runs):
    summary = gold_table(spark, runs, "club_season_summary", 1).coalesce(1).collect()
    artifact = next(a for a in gold.ARTIFACTS if a.name == "club_season_summary")
    column, up = artifact.order[0]
    values = [r[column] for r in summary]
    assert values == sorted(values, reverse=not up)


def test_a_failing_source_does_not_stop_the_others(spark, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    raw = football.deliver(tmp_path / "raw", 1)
    (tmp_path / "raw" / "games.csv").unlink()
    at = dt.datetime(2025, 5, 1)
    wanted = [s for s in medallion.ALL_SOURCES if s.name in ("games", "clubs")]
    assert medallion.land_batch(spark, lake, raw, "b", at, wanted) == {"clubs": "written", "games": "failed"}
    ledger = medallion.Ledger(spark, lake)
    assert not ledger.succeeded("b", "bronze")
    assert "games" in lineage.run_states(ledger.runs()).first()["error"]
    assert lineage.file_states(ledger.events()).where("source_name = 'games'").first()["status"] == "failed"
    # The same batch again, with a file that changed in between: refused.
    clubs = tmp_path / "raw" / "clubs.csv"
    clubs.write_text(clubs.read_text(encoding="utf-8").replace("Solnes", "Changed"), encoding="utf-8")
    assert medallion.land_batch(spark, lake, raw, "b", dt.datetime(2025, 5, 2), wanted)["clubs"] == "failed"


def test_rows_that_do_not_fit_are_set_aside_and_counted(spark, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    raw = football.deliver(tmp_path / "raw", 1)
    clubs = tmp_path / "raw" / "clubs.csv"
    lines = clubs.read_text(encoding="utf-8").splitlines()
    stray = lines[1] + ",,stray"
    clubs.write_text("\n".join([*lines, stray]) + "\n", encoding="utf-8")
    wanted = [s for s in medallion.ALL_SOURCES if s.name == "clubs"]
    for batch, day in (("b", 1), ("again", 2)):  # written, then skipped as the same content
        medallion.land_batch(spark, lake, raw, batch, dt.datetime(2025, 5, day), wanted)
        aside = read_snapshot(spark, lake.root + "/_rejected", "clubs_malformed", batch).collect()
        assert [(r["malformed"], r["_dq_failure_reason"]) for r in aside] == [(stray, "malformed:clubs")]
        files = lineage.files_of_batch(lineage.file_states(medallion.Ledger(spark, lake).events()), batch)
        row, n = files.first(), len(lines) - 1
        assert (row["source_row_count"], row["malformed_row_count"], row["bronze_row_count"]) == (n + 1, 1, n)
        assert "malformed_rows" in {r["code"] for r in lineage.reconcile(files).collect()}


def test_manifest_drift_and_replaced_files(spark, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    raw = football.deliver(tmp_path / "raw", 1)
    wanted = [s for s in medallion.ALL_SOURCES if s.name in ("clubs", "competitions")]
    sums = {n: hashlib.md5((tmp_path / "raw" / f"{n}.csv").read_bytes()).hexdigest() for n in ("clubs", "competitions")}
    listed = {"clubs.csv": {"size_bytes": 1, "checksum_md5": sums["clubs"]}, "competitions.csv": {"size_bytes": 1, "checksum_md5": "0" * 32}}
    said = {"manifest_version": 1, "vendor": "v", "dataset": "d", "dataset_version": "47", "vendor_last_updated": "2016-10-14", "fetched_at": "t", "files": listed}
    (tmp_path / "raw" / "_manifest.json").write_text(json.dumps(said))
    assert set(medallion.land_batch(spark, lake, raw, "a", dt.datetime(2025, 5, 1), wanted).values()) == {"written"}
    events = medallion.Ledger(spark, lake).events()
    assert {json.loads(r["payload"])["vendor_last_updated"] for r in events.where("event_type = 'registered'").collect()} == {"2016-10-14"}
    wrong = events.where("event_type = 'checksum_mismatch'").collect()
    assert [(r["source_name"], json.loads(r["payload"])["computed_md5"]) for r in wrong] == [("competitions", sums["competitions"])]
    assert not path_exists(spark, lake.layer("_staging/none")) and not list((tmp_path / "lake" / "_staging").iterdir())

    clubs = tmp_path / "raw" / "clubs.csv"
    header, *rest = clubs.read_text(encoding="utf-8").splitlines()
    clubs.write_text("\n".join([f"{header},founded", *[f"{line},1900" for line in rest]]) + "\n", encoding="utf-8")
    assert medallion.land_batch(spark, lake, raw, "b", dt.datetime(2025, 5, 2), wanted) == {"clubs": "written", "competitions": "skipped"}
    drift = medallion.Ledger(spark, lake).events().where("event_type = 'schema_drift'").collect()
    assert [(r["batch_id"], r["source_name"], json.loads(r["payload"])["columns_added"]) for r in drift] == [("b", "clubs", "founded")]


def test_a_batch_ends_reconciled(spark, runs):
    events = medallion.Ledger(spark, runs["lake"]).events()
    closed = events.where("event_type = 'reconciled'").groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in closed} == {batch: 6 for batch, _ in DAYS.values()}
    short = events.where("event_type = 'below_minimum_rows' AND batch_id = 'day-1'").collect()
    assert {r["source_name"]: json.loads(r["payload"])["expected_min_rows"] for r in short}["clubs"] == 100


def test_bronze_loss_is_found_without_malformed_rows(spark):
    rows = [("b", "s", "f", "transformed", 10, None, 5, 0, 5, None), ("b", "t", "g", "transformed", 10, 2, 8, 0, 8, None)]
    files = spark.createDataFrame(
        rows,
        "batch_id string, source_name string, source_file_path string, status string, source_row_count long, malformed_row_count long,"
        " bronze_row_count long, rejected_row_count long, silver_row_count long, gold_row_count long",
    )
    assert {(r["source_name"], r["code"]) for r in lineage.reconcile(files).collect()} == {("s", "bronze_loss"), ("t", "malformed_rows")}
