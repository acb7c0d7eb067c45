"""The batch jobs over the given tables: landing, the dimension's prior state, views over the lake, stored order."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.relational import union_by_name
from strataflow.plans import gold, lineage, medallion
from strataflow.queries import inputs
from strataflow.queries.inputs import DIM_PLAYERS_SQL, Tables, registry
from strataflow.session import scratch_path
from strataflow.sources import snapshots
from strataflow.sources.catalogue import ALL_SOURCES

QUERIES, SQL, query = registry()

_SOURCES = tuple(dataclasses.replace(s, format="parquet") for s in ALL_SOURCES)
_AT = dt.datetime(2025, 3, 1, 6)
_DAYS = (("first", dt.date(1997, 1, 1)), ("second", inputs.BATCH_DATE))


def _delivered(t: Tables, players: DataFrame) -> dict[str, DataFrame]:
    """The six sources of a day: regions, nations, the players given, a match and an appearance per order, valuations."""
    key, home = F.col("o_orderkey"), F.col("c_nationkey").cast("long")
    played = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return {
        "competitions": t.region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("competition_id"), F.col("r_name").alias("name")),
        "clubs": inputs.clubs(t).drop("url"),
        "players": players,
        "games": played.select(
            key.alias("game_id"), F.col("o_orderdate").cast("date").alias("date"), home.alias("home_club_id"), ((home + key % 24 + 1) % 25).alias("away_club_id"),
            (key % 5).alias("home_club_goals"), (key % 4).alias("away_club_goals"), F.concat(F.lit("R"), (home % 5).cast("string")).alias("competition_id"),
        ),
        "appearances": inputs.appearances(t).withColumn("date", F.col("date").cast("date")),
        "player_valuations": t.events.select(F.col("user_id").alias("player_id"), F.col("ts").cast("date").alias("date"), F.col("value").alias("market_value_in_eur")),
    }


def _deliver(t: Tables, players: DataFrame, without: str | None = None) -> str:
    root = scratch_path(t.spark, "delivery")
    for name, rows in _delivered(t, players).items():
        if name != without:
            rows.write.parquet(f"{root}/{name}.parquet")
    return root


def _lake(t: Tables) -> medallion.Lake:
    return medallion.Lake(scratch_path(t.spark, "lake"))


@query(
    "lake_landing",
    """WITH n(source_name, rows) AS (
         SELECT 'competitions', count(*) FROM region UNION ALL SELECT 'clubs', count(*) FROM nation UNION ALL SELECT 'games', count(*) FROM orders
         UNION ALL SELECT 'appearances', count(*) FROM orders UNION ALL SELECT 'player_valuations', count(*) FROM events UNION ALL SELECT 'players', NULL)
       SELECT batch_id, source_name, CASE WHEN source_name = 'players' THEN 'failed' ELSE outcome END AS outcome,
              CASE WHEN source_name = 'players' THEN 'failed' ELSE 'ingested' END AS status, CAST(rows AS VARCHAR) AS bronze_row_count,
              CASE WHEN source_name <> 'players' THEN 'first' END AS data_batch_id
       FROM n, (VALUES ('first', 'written'), ('second', 'skipped')) AS b(batch_id, outcome)""",
)
def lake_landing(t: Tables) -> DataFrame:
    """Every declared source goes through one load; one that is missing fails alone, and the same content is not kept twice."""
    lake, raw = _lake(t), _deliver(t, inputs.players_day1(t), without="players")
    done = [(batch, name, how) for batch, _ in _DAYS for name, how in medallion.land_batch(t.spark, lake, raw, batch, _AT, _SOURCES).items()]
    outcomes = t.spark.createDataFrame(done, "batch_id string, source_name string, outcome string")
    files = lineage.file_states(medallion.Ledger(t.spark, lake).events())
    shown = outcomes.join(files, ["batch_id", "source_name"])
    return shown.select("batch_id", "source_name", "outcome", "status", F.col("bronze_row_count").cast("string").alias("bronze_row_count"), "data_batch_id")


def _two_days(t: Tables) -> medallion.Lake:
    """Both days landed and refined; the second begins from the dimension as the first has left it."""
    lake = _lake(t)
    for (batch, date), players in zip(_DAYS, (inputs.players_day1(t), inputs.players_day2(t))):
        at = _AT + (date - _DAYS[0][1])
        medallion.land_batch(t.spark, lake, _deliver(t, players), batch, at, _SOURCES)
        medallion.refine_batch(t.spark, lake, batch, date, at, sources=_SOURCES)
        if batch == _DAYS[0][0]:  # a repeated run begins from the state before its batch, not from its own
            medallion.Ledger(t.spark, lake).add_run(batch_id=batch, layer="silver", status="failed", occurred_at=at + dt.timedelta(hours=1))
            medallion.refine_batch(t.spark, lake, batch, date, at + dt.timedelta(hours=2), sources=_SOURCES)
    return lake


@query(
    "lake_views",
    f"""WITH {DIM_PLAYERS_SQL}
        SELECT 'dim_players' AS view_name, count(*) AS rows, count(*) FILTER (WHERE NOT is_current) AS closed FROM dim_players
        UNION ALL SELECT 'dim_clubs', count(*), 0 FROM nation UNION ALL SELECT 'dim_competitions', count(*), 0 FROM region
        UNION ALL SELECT 'fact_games', count(*), 0 FROM orders
        UNION ALL SELECT 'fact_appearances', count(*), 0 FROM orders
          WHERE CASE WHEN o_orderkey % 17 = 0 THEN o_custkey + 1000000 ELSE o_custkey END IN (SELECT player_id FROM players2)""",
)
def lake_views(t: Tables) -> DataFrame:
    """S17/D-10: views over the latest snapshots, after a day that was refined twice and one more."""
    medallion.register_lake(t.spark, _two_days(t))
    closed = {"dim_players": F.count_if(~F.col("is_current"))}
    names = ("dim_players", "dim_clubs", "dim_competitions", "fact_games", "fact_appearances")
    views = [t.spark.table(n).agg(F.lit(n).alias("view_name"), F.count(F.lit(1)).alias("rows"), closed.get(n, F.lit(0).cast("long")).alias("closed")) for n in names]
    return union_by_name(views)


@query(
    "gold_stored_in_order",
    f"""WITH {inputs.GAMES_SQL}, sides AS (
          SELECT season, home_club_id AS club_id, coalesce(CAST(home_club_goals > away_club_goals AS BIGINT), 0) * 3 + coalesce(CAST(home_club_goals = away_club_goals AS BIGINT), 0) AS points FROM fact_games
          UNION ALL SELECT season, away_club_id, coalesce(CAST(home_club_goals < away_club_goals AS BIGINT), 0) * 3 + coalesce(CAST(home_club_goals = away_club_goals AS BIGINT), 0) FROM fact_games),
        summary AS (SELECT season, club_id, CAST(sum(points) AS BIGINT) AS points FROM sides GROUP BY 1, 2)
        SELECT row_number() OVER (ORDER BY season DESC, points DESC) AS place, season, points FROM summary""",
)
def gold_stored_in_order(t: Tables) -> DataFrame:
    """O1: the rows of a stored artifact in the order in which its files hold them."""
    artifact = by_artifact("club_season_summary")
    lake = _lake(t)
    table = artifact.build(inputs.fact_games(t), inputs.clubs(t))
    snapshots.write_snapshot(gold.presented(artifact, table), lake.layer("gold"), artifact.name, "b")
    stored = snapshots.read_snapshot(t.spark, lake.layer("gold"), artifact.name, "b")
    # Files are numbered in the order of the sort; rows keep their order within a file.
    placed = stored.select("season", F.col("points").cast("long").alias("points"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = {r["_file"]: r["n"] for r in placed.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per file
    before, total = {}, 0
    for name in sorted(files):
        before[name], total = total, total + files[name]
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("_file")).cast("long")
    return placed.select((offset + F.col("_row") + 1).alias("place"), "season", "points")


def by_artifact(name: str) -> gold.Artifact:
    return next(a for a in gold.ARTIFACTS if a.name == name)
