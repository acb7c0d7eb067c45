"""The five analytical tables, and the explorations read from them.

Facts are aggregated before any dimension is joined: a busy player or club combines map-side and meets
the dimension as a single row. Order is a matter of reading, so the stored tables carry none; see
:func:`presented`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.scalars import day_of, safe_ratio, side_result, zero_if_null
from strataflow.operators.asof import asof_join
from strataflow.operators.ordered import rolling_mean
from strataflow.operators.relational import first_per_key, top_k, two_sides

ROLLING_ROWS = 90


def _totals() -> list[Column]:
    return [
        F.sum(zero_if_null(F.col("goals"))).alias("total_goals"),
        F.sum(zero_if_null(F.col("assists"))).alias("total_assists"),
        F.sum(zero_if_null(F.col("minutes_played"))).alias("total_minutes"),
        F.count("*").alias("appearance_count"),
    ]


def _club_names(dim_clubs: DataFrame, *extra: str) -> DataFrame:
    return dim_clubs.select(F.col("club_id").alias("_club"), F.col("name").alias("_club_name"), *extra)


def top_scorers_by_season(fact_appearances: DataFrame, dim_players: DataFrame, dim_clubs: DataFrame) -> DataFrame:
    """G-1: totals per season and player version, with the club of that version."""
    per_version = (
        fact_appearances.where(F.col("player_sk").isNotNull()).groupBy("season", "player_sk").agg(*_totals())
    )
    versions = dim_players.select("player_sk", "player_id", "name", "position_canonical", "current_club_id")
    return (
        per_version.join(versions, "player_sk")
        .join(_club_names(dim_clubs), F.col("current_club_id") == F.col("_club"), "left")
        .select(
            "season",
            "player_sk",
            "player_id",
            F.col("name").alias("player_name"),
            "position_canonical",
            F.col("current_club_id").alias("club_id_at_event"),
            F.col("_club_name").alias("club_name_at_event"),
            "total_goals",
            "total_assists",
            "total_minutes",
            "appearance_count",
        )
    )


def _perspectives(fact_games: DataFrame, *keep: str) -> DataFrame:
    """Two rows per match, one for each club, from one scan."""

    def side(own: str, other: str, home: bool) -> dict[str, Column]:
        return {
            **{c: F.col(c) for c in keep},
            "club_id": F.col(f"{own}_club_id"),
            "goals_for": F.col(f"{own}_club_goals"),
            "goals_against": F.col(f"{other}_club_goals"),
            "result": side_result(F.col("outcome"), F.lit(home)),
        }

    return two_sides(fact_games, [side("home", "away", True), side("away", "home", False)])


def _record() -> list[Column]:
    result = F.col("result")
    return [
        F.count("*").alias("matches_played"),
        F.count_if(result == "win").cast("int").alias("wins"),
        F.count_if(result == "draw").cast("int").alias("draws"),
        F.count_if(result == "loss").cast("int").alias("losses"),
        F.sum(zero_if_null(F.col("goals_for"))).alias("goals_for"),
        F.sum(zero_if_null(F.col("goals_against"))).alias("goals_against"),
    ]


def club_season_summary(fact_games: DataFrame, dim_clubs: DataFrame) -> DataFrame:
    """G-2: standings per season and club."""
    record = _perspectives(fact_games, "season").groupBy("season", "club_id").agg(*_record())
    clubs = _club_names(dim_clubs, "domestic_competition_id")
    return record.join(clubs, F.col("club_id") == F.col("_club"), "left").select(
        "season",
        "club_id",
        F.col("_club_name").alias("club_name"),
        "domestic_competition_id",
        "matches_played",
        "wins",
        "draws",
        "losses",
        "goals_for",
        "goals_against",
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        (3 * F.col("wins") + F.col("draws")).cast("int").alias("points"),
    )


def top_players_all_time(fact_appearances: DataFrame, dim_players: DataFrame, dim_clubs: DataFrame) -> DataFrame:
    """G-3: lifetime totals over all versions of a player, described by the current one."""
    per_version = (
        fact_appearances.where(F.col("player_sk").isNotNull()).groupBy("player_sk", "season").agg(*_totals())
    )
    names = ["total_goals", "total_assists", "total_minutes", "appearance_count"]
    totals = (
        per_version.join(dim_players.select("player_sk", "player_id"), "player_sk")
        .groupBy("player_id")
        .agg(*[F.sum(c).alias(c) for c in names], F.count_distinct("season").alias("seasons_played"))
    )
    current = dim_players.where("is_current").select(
        F.col("player_id").alias("_player"),
        "name",
        "position_canonical",
        "country_of_citizenship_iso",
        "current_club_id",
    )
    return (
        totals.join(current, F.col("player_id") == F.col("_player"))
        .join(_club_names(dim_clubs), F.col("current_club_id") == F.col("_club"), "left")
        .select(
            "player_id",
            F.col("name").alias("player_name"),
            "position_canonical",
            "country_of_citizenship_iso",
            "current_club_id",
            F.col("_club_name").alias("current_club_name"),
            *names,
            "seasons_played",
            safe_ratio(F.col("total_goals"), F.col("appearance_count")).alias("goals_per_appearance"),
        )
    )


def player_valuation_rolling_avg(
    valuations: DataFrame, dim_players: DataFrame, dim_clubs: DataFrame, tie_break: tuple[str, ...] = (), **limits: int
) -> DataFrame:
    """G-4: mean of the last 90 observations (rows, not days) with the version valid on the day.

    ``tie_break`` names columns that order several observations of one player on one date; what they leave
    open, the value and then the other columns decide, so that the order is total but for equal rows.
    """
    observed = valuations.where(F.col("market_value_in_eur").isNotNull() & F.col("date").isNotNull())
    named = ["player_id", "date", *tie_break, "market_value_in_eur"]
    others = sorted(c for c in observed.columns if c not in named)
    slim = observed.select(*named, *others)
    order = [F.col(c).asc() for c in [*named[1:], *others]]
    hot = {k: v for k, v in limits.items() if k == "hot_limit"}
    rolled = rolling_mean(
        slim,
        ["player_id"],
        order,
        "market_value_in_eur",
        ROLLING_ROWS,
        "rolling_avg_90_rows",
        count_out="rolling_sample_count",
        **hot,
    ).withColumn("_day", day_of(slim, "date"))
    take = {"player_sk": "player_sk", "name": "player_name", "position_canonical": "position_canonical",
            "current_club_id": "club_id_at_event"}
    versioned = asof_join(
        rolled, dim_players, ["player_id"], "_day", "effective_date", "end_date", take, "player_sk", **limits
    )
    return versioned.join(_club_names(dim_clubs), F.col("club_id_at_event") == F.col("_club"), "left").select(
        "player_id",
        "player_sk",
        "player_name",
        "position_canonical",
        "club_id_at_event",
        F.col("_club_name").alias("club_name_at_event"),
        "date",
        *tie_break,
        "market_value_in_eur",
        "rolling_avg_90_rows",
        "rolling_sample_count",
    )


def club_performance_metrics(fact_games: DataFrame, dim_clubs: DataFrame) -> DataFrame:
    """G-5: lifetime record and rates per club.

    A match without a score counts as played and as a clean sheet, as it always has.
    """
    clean = F.count_if(zero_if_null(F.col("goals_against")) == 0).cast("int").alias("clean_sheets")
    record = _perspectives(fact_games).groupBy("club_id").agg(*_record(), clean)
    played = F.col("matches_played")
    clubs = _club_names(dim_clubs, "domestic_competition_id")
    return record.join(clubs, F.col("club_id") == F.col("_club"), "left").select(
        "club_id",
        F.col("_club_name").alias("club_name"),
        "domestic_competition_id",
        "matches_played",
        "wins",
        "draws",
        "losses",
        F.col("goals_for").alias("total_goals_for"),
        F.col("goals_against").alias("total_goals_against"),
        "clean_sheets",
        safe_ratio(F.col("wins"), played).alias("win_rate"),
        safe_ratio(F.col("goals_for"), played).alias("goals_per_game"),
        safe_ratio(F.col("goals_against"), played).alias("goals_conceded_per_game"),
        safe_ratio(F.col("clean_sheets"), played).alias("clean_sheet_rate"),
    )


@dataclass(frozen=True)
class Artifact:
    """An analytical table: how it is built, from what, and the order it is shown in."""

    name: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    primary_source: str
    order: tuple[tuple[str, bool], ...]  # (column, ascending)


ARTIFACTS = (
    Artifact(
        "top_scorers_by_season",
        top_scorers_by_season,
        ("fact_appearances", "dim_players", "dim_clubs"),
        "appearances",
        (("season", False), ("total_goals", False)),
    ),
    Artifact(
        "club_season_summary",
        club_season_summary,
        ("fact_games", "dim_clubs"),
        "games",
        (("season", False), ("points", False)),
    ),
    Artifact(
        "top_players_all_time",
        top_players_all_time,
        ("fact_appearances", "dim_players", "dim_clubs"),
        "appearances",
        (("total_goals", False), ("appearance_count", False)),
    ),
    Artifact(
        "player_valuation_rolling_avg",
        player_valuation_rolling_avg,
        ("bronze_player_valuations", "dim_players", "dim_clubs"),
        "player_valuations",
        (("player_id", True), ("date", True)),
    ),
    Artifact(
        "club_performance_metrics",
        club_performance_metrics,
        ("fact_games", "dim_clubs"),
        "games",
        (("wins", False), ("total_goals_for", False)),
    ),
)


def presented(artifact: Artifact, table: DataFrame) -> DataFrame:
    """O1: the artifact in its order of presentation."""
    return table.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in artifact.order])


# --- Explorations ---


def top_scorers(scorers: DataFrame, k: int = 10) -> DataFrame:
    """G-7."""
    order = [F.col("total_goals").desc(), F.col("total_assists").desc(), F.col("season").desc(), F.col("player_sk")]
    shown = scorers.select(
        "season",
        "player_sk",
        "player_name",
        "position_canonical",
        F.col("club_name_at_event").alias("club"),
        "total_goals",
        "total_assists",
        "appearance_count",
    )
    return top_k(shown, order, k).drop("player_sk")


def totals_by_position(scorers: DataFrame) -> DataFrame:
    """G-8/A13."""
    return scorers.groupBy("position_canonical").agg(
        F.sum("total_goals").alias("goals"),
        F.sum("total_assists").alias("assists"),
        F.count_distinct("player_id").alias("players"),
    )


def standings(summary: DataFrame) -> DataFrame:
    """G-9."""
    columns = ["club_name", "matches_played", "wins", "draws", "losses", "goals_for", "goals_against",
               "goal_difference", "points"]
    return summary.select(*columns).orderBy(F.col("points").desc(), "club_name")


def valuation_trend(rolling: DataFrame, dim_players: DataFrame) -> DataFrame:
    """G-10/J9: observations under the current name of the player."""
    current = dim_players.where("is_current").select("player_id", F.col("name").alias("player"))
    return (
        rolling.join(current, "player_id")
        .select(
            "date",
            "player",
            F.col("market_value_in_eur").alias("value_eur"),
            F.col("rolling_avg_90_rows").alias("rolling_avg"),
            F.col("rolling_sample_count").alias("n_observations"),
        )
        .orderBy("player", "date")
    )


def version_storage(dim_players: DataFrame, k: int = 10) -> DataFrame:
    """G-11: how versions lie in the dimension."""
    columns = ["player_sk", "player_id", "name", "position_canonical", "market_value_in_eur", "effective_date",
               "end_date", "is_current"]
    return top_k(dim_players.select(*columns), [F.col("player_id").asc(), F.col("effective_date").asc(), F.col("player_sk").asc()], k)


def best_scorer_per_club(scorers: DataFrame) -> DataFrame:
    """G-12/W5."""
    order = [F.col("total_goals").desc(), F.col("total_assists").desc(), F.col("season").desc(), F.col("player_sk")]
    best = first_per_key(
        scorers.select("club_name_at_event", "player_name", "total_goals", "total_assists", "season", "player_sk"),
        ["club_name_at_event"],
        order,
    )
    return best.select(F.col("club_name_at_event").alias("club"), "player_name", "total_goals")
