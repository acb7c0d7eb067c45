"""The given tables, and the library's shapes derived from them, in Spark and in SQL side by side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.plans import star
from strataflow.session import cut_lineage, tune
from strataflow.sources.catalogue import Source

BATCH_DATE = dt.date(1998, 1, 1)

# Labels dealt out to rows by key, with the spellings a lookup has to cope with.
POSITION_LABELS = ["GK", " centre-back", "CAM", "striker ", "Left Winger", "Sweeper", None, "cdm"]
COUNTRY_LABELS = ["England", "brazil", " USA", "DEU", "fr", "Côte d'Ivoire", "Korea, South", "Atlantis", None, "Spain"]


def dealt(labels: list[str | None], key: Column) -> Column:
    """The label whose turn it is for an integer key."""
    values = F.array(*[F.lit(v).cast("string") for v in labels])
    return F.element_at(values, (key % len(labels) + 1).cast("int"))


def dealt_sql(labels: list[str | None], key: str) -> str:
    values = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in labels)
    return f"list_extract([{values}], CAST(({key}) % {len(labels)} + 1 AS BIGINT))"


def registry():
    """Two tables of queries and their SQL, and the decorator that fills them.

    ``sparse`` names whole-number columns with gaps; both sides show them as text, since tools disagree on
    whether a column of whole numbers with gaps still holds whole numbers.
    """
    queries, sqls = {}, {}

    def query(name: str, sql: str | None = None, sparse: tuple[str, ...] = ()):
        def register(fn):
            queries[name] = lambda spark, sf_dir: as_text(fn(Tables(spark, sf_dir)), *sparse)
            if sql is not None:
                shown = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in sparse)
                sqls[name] = f"SELECT * REPLACE ({shown}) FROM ({sql})" if sparse else sql
            return fn

        return register

    return queries, sqls, query


class Tables:
    """The given tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, table)
        return table


# --- Players: two daily snapshots of the customers ---


def players_day1(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("player_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("long").alias("current_club_id"),
        dealt(POSITION_LABELS, key).alias("position"),
        dealt(COUNTRY_LABELS, key).alias("country_of_citizenship"),
        F.col("c_acctbal").alias("market_value_in_eur"),
    )


def players_day2(t: Tables) -> DataFrame:
    """Some players gone, some moved to another club, some new; untracked names changed throughout."""
    first = players_day1(t).withColumn("name", F.upper("name"))
    key, club = F.col("player_id"), F.col("current_club_id")
    stayed = first.where(key % 11 != 0).withColumn("current_club_id", F.when(key % 7 == 0, (club + 1) % 25).otherwise(club))
    joined = first.where(key % 13 == 0).withColumn("player_id", key + 1000000)
    return stayed.unionByName(joined)


PLAYERS_SOURCE = Source(
    "players",
    ("player_id",),
    {
        "player_id": "int",
        "name": "string",
        "current_club_id": "int",
        "position": "string",
        "country_of_citizenship": "string",
        "market_value_in_eur": "float",
    },
    tracked_columns=("current_club_id", "position", "market_value_in_eur"),
    pii_columns=("name",),
)

PLAYERS_SQL = f"""
players1 AS (
  SELECT c_custkey AS player_id, c_name AS name, CAST(c_nationkey AS BIGINT) AS current_club_id,
         {dealt_sql(POSITION_LABELS, 'c_custkey')} AS position,
         {dealt_sql(COUNTRY_LABELS, 'c_custkey')} AS country_of_citizenship,
         c_acctbal AS market_value_in_eur
  FROM customer),
players2 AS (
  SELECT player_id, upper(name) AS name,
         CASE WHEN player_id % 7 = 0 THEN (current_club_id + 1) % 25 ELSE current_club_id END AS current_club_id,
         position, country_of_citizenship, market_value_in_eur
  FROM players1 WHERE player_id % 11 <> 0
  UNION ALL
  SELECT player_id + 1000000, upper(name), current_club_id, position, country_of_citizenship, market_value_in_eur
  FROM players1 WHERE player_id % 13 = 0)"""

POSITION_SQL = """
taxonomy(raw_key, canonical, category) AS (VALUES
  ('gk', 'Goalkeeper', 'goalkeeper'), ('centre-back', 'Centre-Back', 'defender'),
  ('cam', 'Attacking Midfield', 'midfielder'), ('striker', 'Striker', 'forward'),
  ('left winger', 'Left Winger', 'forward'), ('cdm', 'Defensive Midfield', 'midfielder')),
countries(raw_key, alpha2) AS (VALUES
  ('england', 'GB'), ('brazil', 'BR'), ('usa', 'US'), ('deu', 'DE'), ('fr', 'FR'), ('côte d''ivoire', 'CI'),
  ('korea, south', 'KR'), ('spain', 'ES'))"""


def dim_players(t: Tables, batch_date: dt.date = BATCH_DATE) -> DataFrame:
    """The dimension after both days; each day writes it and the next step reads what was written."""
    first = cut_lineage(star.build_dim_players(players_day1(t), None, batch_date, PLAYERS_SOURCE).dimension)
    return cut_lineage(star.build_dim_players(players_day2(t), first, batch_date, PLAYERS_SOURCE).dimension)


DIM_PLAYERS_SQL = f"""{PLAYERS_SQL}, {POSITION_SQL},
dim1 AS (SELECT row_number() OVER (ORDER BY player_id) AS player_sk, * FROM players1),
changed AS (
  SELECT n.*, row_number() OVER (ORDER BY n.player_id) AS rn
  FROM players2 n JOIN players1 o USING (player_id)
  WHERE n.current_club_id IS DISTINCT FROM o.current_club_id OR n.position IS DISTINCT FROM o.position
     OR n.market_value_in_eur IS DISTINCT FROM o.market_value_in_eur),
fresh AS (
  SELECT n.*, row_number() OVER (ORDER BY n.player_id) AS rn
  FROM players2 n WHERE NOT EXISTS (SELECT 1 FROM players1 o WHERE o.player_id = n.player_id)),
versions AS (
  SELECT d.player_id, d.name, d.current_club_id, d.position, d.country_of_citizenship, d.market_value_in_eur, d.player_sk,
         DATE '1900-01-01' AS effective_date,
         CASE WHEN c.player_id IS NOT NULL THEN DATE '1998-01-01' ELSE DATE '9999-12-31' END AS end_date,
         c.player_id IS NULL AS is_current
  FROM dim1 d LEFT JOIN changed c ON c.player_id = d.player_id
  UNION ALL
  SELECT player_id, name, current_club_id, position, country_of_citizenship, market_value_in_eur,
         (SELECT max(player_sk) FROM dim1) + rn, DATE '1998-01-01', DATE '9999-12-31', TRUE
  FROM changed
  UNION ALL
  SELECT player_id, name, current_club_id, position, country_of_citizenship, market_value_in_eur,
         (SELECT max(player_sk) FROM dim1) + (SELECT count(*) FROM changed) + rn, DATE '1998-01-01', DATE '9999-12-31', TRUE
  FROM fresh),
dim_players AS (
  SELECT v.*, coalesce(x.canonical, 'Unknown') AS position_canonical, coalesce(x.category, 'Unknown') AS position_category,
         coalesce(k.alpha2, 'XX') AS country_of_citizenship_iso
  FROM versions v
  LEFT JOIN taxonomy x ON x.raw_key = lower(trim(v.position))
  LEFT JOIN countries k ON k.raw_key = lower(trim(v.country_of_citizenship)))"""


# --- Clubs and competitions: nations and regions ---


def clubs(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").cast("long").alias("club_id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("domestic_competition_id"),
        F.lit("not kept").alias("url"),
    )


CLUBS_SQL = """
dim_clubs AS (
  SELECT CAST(n_nationkey AS BIGINT) AS club_id, n_name AS name, 'R' || CAST(n_regionkey AS VARCHAR) AS domestic_competition_id
  FROM nation)"""


# --- Appearances: orders; some belong to players who arrive only on the second day ---


def appearances(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        F.concat(F.lit("A"), key.cast("string")).alias("appearance_id"),
        key.alias("game_id"),
        F.when(key % 17 == 0, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey")).alias("player_id"),
        F.col("o_orderdate").alias("date"),
        F.when(key % 9 != 0, key % 4).alias("goals"),
        (key % 3).alias("assists"),
        (key % 91).alias("minutes_played"),
    )


SEASON_SQL = """
  CAST(year({0}) - CASE WHEN month({0}) < 8 THEN 1 ELSE 0 END AS VARCHAR) || '-' ||
  lpad(CAST((year({0}) - CASE WHEN month({0}) < 8 THEN 1 ELSE 0 END + 1) % 100 AS VARCHAR), 2, '0')"""
DATE_KEY_SQL = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INTEGER)"

APPEARANCES_SQL = """
appearances AS (
  SELECT 'A' || CAST(o_orderkey AS VARCHAR) AS appearance_id, o_orderkey AS game_id,
         CASE WHEN o_orderkey % 17 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS player_id,
         CAST(o_orderdate AS DATE) AS day,
         CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 4 END AS goals,
         o_orderkey % 3 AS assists, o_orderkey % 91 AS minutes_played
  FROM orders)"""

FACT_APPEARANCES_SQL = f"""{DIM_PLAYERS_SQL}, {APPEARANCES_SQL},
fact_appearances AS (
  SELECT a.*, {SEASON_SQL.format('a.day')} AS season, {DATE_KEY_SQL.format('a.day')} AS date_key,
         (SELECT max_by(v.player_sk, v.effective_date) FROM versions v
          WHERE v.player_id = a.player_id AND a.day >= v.effective_date AND a.day <= v.end_date) AS player_sk
  FROM appearances a)"""


def fact_appearances(t: Tables, players: DataFrame) -> DataFrame:
    return star.build_fact_appearances(appearances(t), players)


# --- Games: every line of an order is a match of the buyer's nation against the seller's ---


def games(t: Tables) -> DataFrame:
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("c_nationkey").cast("long").alias("home_club_id")
    )
    sellers = t.supplier.select("s_suppkey", F.col("s_nationkey").cast("long").alias("away_club_id"))
    unplayed = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1)
    return (
        t.lineitem.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("game_id"),
            F.lit(0).alias("season"),
            F.col("l_shipdate").alias("date"),
            "home_club_id",
            "away_club_id",
            F.when(~unplayed, F.col("l_quantity").cast("long") % 5).alias("home_club_goals"),
            F.when(~unplayed, F.col("l_partkey") % 4).alias("away_club_goals"),
        )
    )


GAMES_SQL = f"""
games AS (
  SELECT l_orderkey * 8 + l_linenumber AS game_id, CAST(l_shipdate AS DATE) AS day,
         CAST(c_nationkey AS BIGINT) AS home_club_id, CAST(s_nationkey AS BIGINT) AS away_club_id,
         CASE WHEN NOT (l_returnflag = 'N' AND l_linenumber = 1) THEN CAST(l_quantity AS BIGINT) % 5 END AS home_club_goals,
         CASE WHEN NOT (l_returnflag = 'N' AND l_linenumber = 1) THEN l_partkey % 4 END AS away_club_goals
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey),
fact_games AS (
  SELECT *, CASE WHEN home_club_goals IS NULL OR away_club_goals IS NULL THEN 'unknown'
                 WHEN home_club_goals > away_club_goals THEN 'home_win'
                 WHEN away_club_goals > home_club_goals THEN 'away_win' ELSE 'draw' END AS outcome,
         {SEASON_SQL.format('day')} AS season, {DATE_KEY_SQL.format('day')} AS date_key
  FROM games)"""


def fact_games(t: Tables) -> DataFrame:
    return star.build_fact_games(games(t))


# --- Valuations: the value of an event is what its user is worth at that moment ---


def valuations(t: Tables) -> DataFrame:
    """Values in whole hundredths, whose sums are exact in any order of addition."""
    return t.events.select(
        F.col("user_id").alias("player_id"),
        F.col("ts").alias("date"),
        F.when(F.col("event_type") != "error", F.round(F.col("value") * 100)).alias("market_value_in_eur"),
        "event_id",
    )


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and times as ISO text, so that every engine prints them alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns}) if columns else df
