"""The six declared sources and their data-quality rules."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from strataflow.operators.quality import CRITICAL, WARNING, ForeignKey, HasColumns, NotNull, Range, Rule, Unique
from strataflow.sources.schema import struct_type


@dataclass(frozen=True)
class Source:
    """A table that arrives as one full snapshot per batch."""

    name: str
    primary_key: tuple[str, ...]
    schema: dict[str, str] = field(hash=False)
    format: str = "csv"
    timestamp_column: str | None = None
    tracked_columns: tuple[str, ...] = ()
    pii_columns: tuple[str, ...] = ()
    expected_min_rows: int | None = None
    multiline: bool = True  # False: the vendor warrants that no quoted value holds a line break, which saves a scan

    def __post_init__(self) -> None:
        struct_type(self.schema)
        named = [*self.primary_key, *self.tracked_columns, *self.pii_columns]
        unknown = [c for c in named if c not in self.schema]
        if unknown:
            raise ValueError(f"source {self.name} names the undeclared columns {unknown}")

    def path(self, raw_root: str) -> str:
        return f"{raw_root.rstrip('/')}/{self.name}.{self.format}"


# Keys, columns and their types, tracked and masked columns, and least rows of the six sources.
COMPETITIONS = Source(
    "competitions",
    ("competition_id",),
    {
        "competition_id": "string",
        "name": "string",
        "country_name": "string",
        "sub_type": "string",
        "type": "string",
        "confederation": "string",
        "url": "string",
    },
    expected_min_rows=10,
)
CLUBS = Source(
    "clubs",
    ("club_id",),
    {
        "club_id": "int",
        "club_code": "string",
        "name": "string",
        "domestic_competition_id": "string",
        "total_market_value": "float",
        "squad_size": "int",
        "average_age": "float",
        "foreigners_number": "int",
        "foreigners_percentage": "float",
        "national_team_players": "int",
        "stadium_name": "string",
        "stadium_seats": "int",
        "net_transfer_record": "string",
        "coach_name": "string",
        "last_season": "int",
        "filename": "string",
        "url": "string",
    },
    expected_min_rows=100,
)
PLAYERS = Source(
    "players",
    ("player_id",),
    {
        "player_id": "int",
        "first_name": "string",
        "last_name": "string",
        "name": "string",
        "last_season": "int",
        "current_club_id": "int",
        "player_code": "string",
        "country_of_birth": "string",
        "city_of_birth": "string",
        "country_of_citizenship": "string",
        "date_of_birth": "date",
        "sub_position": "string",
        "position": "string",
        "foot": "string",
        "height_in_cm": "int",
        "market_value_in_eur": "float",
        "highest_market_value_in_eur": "float",
        "contract_expiration_date": "date",
        "agent_name": "string",
        "image_url": "string",
        "url": "string",
        "current_club_domestic_competition_id": "string",
        "current_club_name": "string",
    },
    tracked_columns=("current_club_id", "position", "market_value_in_eur"),
    pii_columns=("first_name", "last_name", "name", "date_of_birth", "city_of_birth"),
    expected_min_rows=1000,
)
GAMES = Source(
    "games",
    ("game_id",),
    {
        "game_id": "int",
        "competition_id": "string",
        "season": "int",
        "round": "string",
        "date": "date",
        "home_club_id": "int",
        "away_club_id": "int",
        "home_club_goals": "int",
        "away_club_goals": "int",
        "home_club_position": "int",
        "away_club_position": "int",
        "home_club_manager_name": "string",
        "away_club_manager_name": "string",
        "stadium": "string",
        "attendance": "int",
        "referee": "string",
        "url": "string",
        "home_club_formation": "string",
        "away_club_formation": "string",
        "home_club_name": "string",
        "away_club_name": "string",
        "aggregate": "string",
        "competition_type": "string",
    },
    timestamp_column="date",
    expected_min_rows=1000,
)
APPEARANCES = Source(
    "appearances",
    ("appearance_id",),
    {
        "appearance_id": "string",
        "game_id": "int",
        "player_id": "int",
        "player_club_id": "int",
        "player_current_club_id": "int",
        "date": "date",
        "player_name": "string",
        "competition_id": "string",
        "yellow_cards": "int",
        "red_cards": "int",
        "goals": "int",
        "assists": "int",
        "minutes_played": "int",
    },
    # The name is carried here in plain text as well, so it is masked here as well.
    pii_columns=("player_name",),
    expected_min_rows=10000,
)
PLAYER_VALUATIONS = Source(
    "player_valuations",
    ("player_id", "date"),
    {
        "player_id": "int",
        "date": "date",
        "market_value_in_eur": "float",
        "current_club_id": "int",
        "player_club_domestic_competition_id": "string",
    },
    timestamp_column="date",
    expected_min_rows=10000,
)

ALL_SOURCES = (COMPETITIONS, CLUBS, PLAYERS, GAMES, APPEARANCES, PLAYER_VALUATIONS)


def by_name(sources: Iterable[Source] = ALL_SOURCES) -> dict[str, Source]:
    table: dict[str, Source] = {}
    for source in sources:
        if source.name in table:
            raise ValueError(f"source {source.name} is declared twice")
        table[source.name] = source
    return table


def scd2_sources(sources: Iterable[Source] = ALL_SOURCES) -> list[Source]:
    return [s for s in sources if s.tracked_columns]


def pii_sources(sources: Iterable[Source] = ALL_SOURCES) -> list[Source]:
    return [s for s in sources if s.pii_columns]


def incremental_sources(sources: Iterable[Source] = ALL_SOURCES) -> list[Source]:
    return [s for s in sources if s.timestamp_column]


# The rules of the six sources, their severities and ranges.
QUALITY_RULES: tuple[Rule, ...] = (
    NotNull("competitions", CRITICAL, ("competition_id", "name")),
    Unique("competitions", CRITICAL, ("competition_id",)),
    NotNull("clubs", CRITICAL, ("club_id", "name", "domestic_competition_id")),
    Unique("clubs", CRITICAL, ("club_id",)),
    ForeignKey("clubs", CRITICAL, "domestic_competition_id", "competitions", "competition_id"),
    Range("clubs", WARNING, "squad_size", 0, 200),
    NotNull("players", CRITICAL, ("player_id", "name", "current_club_id")),
    Unique("players", CRITICAL, ("player_id",)),
    ForeignKey("players", CRITICAL, "current_club_id", "clubs", "club_id"),
    Range("players", WARNING, "market_value_in_eur", 0, 500_000_000),
    NotNull("games", CRITICAL, ("game_id", "date", "home_club_id", "away_club_id")),
    Unique("games", CRITICAL, ("game_id",)),
    ForeignKey("games", CRITICAL, "home_club_id", "clubs", "club_id"),
    ForeignKey("games", CRITICAL, "away_club_id", "clubs", "club_id"),
    ForeignKey("games", CRITICAL, "competition_id", "competitions", "competition_id"),
    Range("games", WARNING, "home_club_goals", 0, 30),
    Range("games", WARNING, "away_club_goals", 0, 30),
    NotNull("appearances", CRITICAL, ("appearance_id", "player_id", "game_id", "date")),
    Unique("appearances", CRITICAL, ("appearance_id",)),
    ForeignKey("appearances", CRITICAL, "player_id", "players", "player_id"),
    ForeignKey("appearances", CRITICAL, "game_id", "games", "game_id"),
    Range("appearances", WARNING, "minutes_played", 0, 120),
    Range("appearances", WARNING, "goals", 0, 10),
    Range("appearances", WARNING, "assists", 0, 10),
    NotNull("player_valuations", CRITICAL, ("player_id", "date", "market_value_in_eur")),
    ForeignKey("player_valuations", CRITICAL, "player_id", "players", "player_id"),
    Range("player_valuations", WARNING, "market_value_in_eur", 0, 500_000_000),
)


def rules_for(source: str, rules: Iterable[Rule] = QUALITY_RULES) -> list[Rule]:
    return [r for r in rules if r.source == source]


def schema_rules(sources: Iterable[Source] = ALL_SOURCES) -> list[Rule]:
    """One column-presence rule per source, for callers that want them besides the rules above."""
    return [HasColumns(s.name, CRITICAL, tuple(s.schema)) for s in sources]


def foreign_key_targets(rules: Iterable[Rule]) -> set[tuple[str, str]]:
    return {(r.references_source, r.references_column) for r in rules if isinstance(r, ForeignKey)}
