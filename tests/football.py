"""Three days of an invented league, written as raw CSV deliveries.

Two countries, five clubs, ten players who mostly play every match of their club, five matches before the
first day and two before the second. Goals are listed by match; all else follows from a rule.
"""

import csv
from pathlib import Path

from strataflow.sources.catalogue import ALL_SOURCES

COMPETITIONS = [("NO", "Northern League", "Norway"), ("PT", "Coastal Cup", "Portugal")]
CLUBS = [(11, "Fjordvik", "NO"), (12, "Granheim", "NO"), (13, "Solnes", "NO"), (21, "Marazul", "PT"), (22, "Portovelho", "PT")]
# player, name, club, country, position label, market value in millions
PLAYERS = [
    (301, "Aksel Tind", 11, "Norway", "striker", 40),
    (302, "Bo Lyng", 11, "Sweden", "CAM", 25),
    (303, "Carl Myhre", 12, "Norway", "GK", 8),
    (304, "Dag Foss", 12, "Denmark", "ST", 31),
    (305, "Eirik Nes", 13, "Norway", "CDM", 14),
    (306, "Finn Ask", 13, "Atlantis", "LW", 22),
    (401, "Gil Pombo", 21, "Portugal", "ST", 55),
    (402, "Hugo Vaz", 21, "Brazil", "CM", 18),
    (403, "Ivo Tello", 22, "Portugal", "GK", 5),
    (404, "Jaime Rua", 22, "Spain", "RW", 37),
]
MOVED, RELABELLED, REVALUED, ABSENT, UNKNOWN = 304, 403, 401, 305, 777
# game, competition, date, home, away, home goals, away goals (None: not played)
GAMES = [
    (71, "NO", "2016-03-06", 11, 12, 3, 1),
    (72, "NO", "2016-03-13", 12, 13, 0, 0),
    (73, "NO", "2016-09-04", 13, 11, 2, 4),
    (74, "PT", "2016-03-06", 21, 22, 1, 2),
    (75, "PT", "2016-09-11", 22, 21, None, None),
]
LATER_GAMES = [(76, "NO", "2016-11-20", 13, 12, 1, 2), (77, "PT", "2016-11-27", 21, 22, 3, 3)]
# game -> scorer of each goal; own goals and goals of players who are not listed are nobody's
GOALS = {71: [301, 301, 302, 304], 73: [305, 306, 301, 302, 302, 302], 74: [401, 404, 404], 76: [306, 304, 304], 77: [401, 401, 402, 404]}
OBSERVED_ON = ("2016-02-01", "2016-05-01", "2016-08-01", "2016-10-01")


def value_on(player: int, n: int) -> int:
    return (player % 50 + 3 * n) * 1_000_000


def _players(day):
    rows = []
    for pid, name, club, country, position, value in PLAYERS:
        if day >= 2 and pid == MOVED:
            club, value = 13, value + 4
        if day >= 2 and pid == RELABELLED:
            position = "Goalkeeper"
        if day >= 3 and pid == REVALUED:
            value += 5
        if day >= 3 and pid == ABSENT:
            continue
        first, _, last = name.partition(" ")
        rows.append(
            {
                "player_id": pid,
                "first_name": first,
                "last_name": last,
                "name": name,
                "current_club_id": club,
                "country_of_citizenship": country,
                "date_of_birth": f"{1990 + pid % 9}-07-1{pid % 9}",
                "position": position,
                "market_value_in_eur": value * 1_000_000,
            }
        )
    return rows


def games(day):
    return GAMES + (LATER_GAMES if day >= 2 else [])


def appearances(day):
    """(game, date, competition, player, club, goals, assists, minutes); one player nobody has listed comes on in the first match."""
    rows = []
    for game, competition, date, home, away, *_ in games(day):
        for pid, _, club, *_ in PLAYERS:
            if day >= 2 and game == 76 and pid == MOVED:
                club = 13
            if club in (home, away):
                rows.append((game, date, competition, pid, club, GOALS.get(game, []).count(pid), (game + pid) % 2, 90 - (pid + game) % 4 * 10))
        if game == 71:
            rows.append((game, date, competition, UNKNOWN, home, 0, 0, 5))
    return rows


def tables(day):
    return {
        "competitions": [{"competition_id": c, "name": n, "country_name": k} for c, n, k in COMPETITIONS],
        "clubs": [{"club_id": c, "name": n, "domestic_competition_id": k, "squad_size": 20 + c % 3, "average_age": 24.5} for c, n, k in CLUBS],
        "players": _players(day),
        "games": [
            dict(zip(("game_id", "competition_id", "season", "date", "home_club_id", "away_club_id", "home_club_goals", "away_club_goals"), (g, c, 2016, *rest)))
            for g, c, *rest in games(day)
        ],
        "appearances": [
            {
                "appearance_id": f"{game}-{pid}",
                "game_id": game,
                "player_id": pid,
                "player_club_id": club,
                "player_current_club_id": club,
                "date": date,
                "player_name": f"no. {pid}",
                "competition_id": competition,
                "goals": goals,
                "assists": assists,
                "minutes_played": minutes,
            }
            for game, date, competition, pid, club, goals, assists, minutes in appearances(day)
        ],
        "player_valuations": [
            {"player_id": pid, "date": date, "market_value_in_eur": value_on(pid, n)} for pid, *_ in PLAYERS if pid != ABSENT for n, date in enumerate(OBSERVED_ON)
        ],
    }


def deliver(folder: Path, day: int) -> str:
    """Write the six files of a day; columns no row fills are left empty."""
    folder.mkdir(parents=True)
    for source in ALL_SOURCES:
        with open(folder / f"{source.name}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.DictWriter(out, list(source.schema), lineterminator="\n")
            writer.writeheader()
            writer.writerows(tables(day)[source.name])
    return str(folder)
