"""Dimensions and facts of the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.hashing import tokenize_columns
from strataflow.functions.lookups import normalise_country, normalise_position
from strataflow.functions.scalars import calendar_columns, date_key, day_of, match_outcome, season
from strataflow.operators.asof import asof_join
from strataflow.operators.relational import drop_batch, first_per_key, keep_existing
from strataflow.operators.scd2 import FAR_PAST, MergeResult, scd2_merge
from strataflow.sources.catalogue import PLAYERS, Source

# The columns of the two dimensions.
CLUB_COLUMNS = (
    "club_id",
    "club_code",
    "name",
    "domestic_competition_id",
    "total_market_value",
    "squad_size",
    "average_age",
    "foreigners_number",
    "foreigners_percentage",
    "national_team_players",
    "stadium_name",
    "stadium_seats",
    "last_season",
)
COMPETITION_COLUMNS = ("competition_id", "name", "country_name", "sub_type", "type", "confederation")
PLAYER_KEY = "player_sk"


def type1_dimension(
    snapshot: DataFrame, columns: Sequence[str], key: Sequence[str], latest_first: Sequence[Column] = ()
) -> DataFrame:
    """D-1: the wanted columns, one row per key.

    ``latest_first`` says which row of a repeated key stays; ties are settled by the row's values, so
    the choice never depends on how the rows were spread over tasks.
    """
    kept = keep_existing(snapshot, columns)
    rest = [F.col(c).desc_nulls_last() for c in kept.columns if c not in key]
    return first_per_key(kept, key, [*latest_first, *rest] or [F.lit(1)])


def build_dim_clubs(clubs: DataFrame) -> DataFrame:
    return type1_dimension(clubs, CLUB_COLUMNS, ["club_id"])


def build_dim_competitions(competitions: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """D-2."""
    kept = type1_dimension(competitions, COMPETITION_COLUMNS, ["competition_id"])
    if "country_name" not in kept.columns:
        return kept
    return normalise_country(kept, "country_name", "country_iso_code", countries)


def build_dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """D-3: one row per day, both ends included."""
    if end < start:
        raise ValueError(f"the range ends ({end}) before it starts ({start})")
    span = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("_day"))
    return span.select(*[expr.alias(name) for name, expr in calendar_columns(F.col("_day")).items()])


def _with_labels(players: DataFrame) -> DataFrame:
    """Position and country labels in canonical form."""
    rows = normalise_position(players, "position")
    if "country_of_citizenship" in rows.columns:
        rows = normalise_country(rows, "country_of_citizenship", "country_of_citizenship_iso")
    return rows


def build_dim_players(
    players: DataFrame,
    existing: DataFrame | None,
    batch_date: dt.date,
    source: Source = PLAYERS,
    salt: str | None = None,
    first_version_effective: dt.date | None = None,
) -> MergeResult:
    """D-7: the players dimension after this batch.

    On the first load versions start in the far past, so that events before the first batch resolve.
    Personal data is masked before changes are detected, so tokens are what is compared.
    """
    if not source.tracked_columns:
        raise ValueError(f"source {source.name} tracks no columns")
    incoming = drop_batch(players)
    if salt is not None:
        incoming = tokenize_columns(incoming, source.pii_columns, salt)
    effective = FAR_PAST if existing is None else batch_date
    return scd2_merge(
        drop_batch(existing) if existing is not None else None,
        incoming,
        list(source.primary_key),
        list(source.tracked_columns),
        PLAYER_KEY,
        effective,
        first_version_effective,
        enrich=_with_labels,
    )


def build_fact_games(games: DataFrame) -> DataFrame:
    """D-8: the season label takes the place of the source's season number."""
    day = day_of(games, "date")
    return drop_batch(games).withColumns(
        {
            "outcome": match_outcome(F.col("home_club_goals"), F.col("away_club_goals")),
            "season": season(day),
            "date_key": date_key(day),
        }
    )


def build_fact_appearances(appearances: DataFrame, dim_players: DataFrame, **limits: int) -> DataFrame:
    """D-9: each appearance with the version of the player that was valid on the day."""
    day = day_of(appearances, "date")
    dated = drop_batch(appearances).withColumns({"season": season(day), "date_key": date_key(day), "_day": day})
    return asof_join(
        dated,
        dim_players,
        ["player_id"],
        "_day",
        "effective_date",
        "end_date",
        {PLAYER_KEY: PLAYER_KEY},
        PLAYER_KEY,
        **limits,
    ).drop("_day")


def resolution_rate(fact: DataFrame, key: str = PLAYER_KEY) -> DataFrame:
    """Rows of a fact and how many found no version."""
    unresolved = F.count_if(F.col(key).isNull())
    total = F.count("*")
    return fact.agg(
        total.alias("rows"),
        unresolved.alias("unresolved"),
        F.when(total > 0, F.round((total - unresolved) * 100 / total, 1)).alias("resolved_pct"),
    )
