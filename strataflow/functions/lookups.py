"""Reference tables of fixed size and the joins that apply them."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN_POSITION = "Unknown"
UNKNOWN_COUNTRY = "XX"

# Raw label, canonical label, category.
POSITION_TAXONOMY = [
    ("GK", "Goalkeeper", "goalkeeper"),
    ("Goalkeeper", "Goalkeeper", "goalkeeper"),
    ("CB", "Centre-Back", "defender"),
    ("Centre-Back", "Centre-Back", "defender"),
    ("Center-Back", "Centre-Back", "defender"),
    ("LB", "Left-Back", "defender"),
    ("Left-Back", "Left-Back", "defender"),
    ("RB", "Right-Back", "defender"),
    ("Right-Back", "Right-Back", "defender"),
    ("LWB", "Left Wing-Back", "defender"),
    ("RWB", "Right Wing-Back", "defender"),
    ("CDM", "Defensive Midfield", "midfielder"),
    ("Defensive Midfield", "Defensive Midfield", "midfielder"),
    ("CM", "Central Midfield", "midfielder"),
    ("Central Midfield", "Central Midfield", "midfielder"),
    ("CAM", "Attacking Midfield", "midfielder"),
    ("Attacking Midfield", "Attacking Midfield", "midfielder"),
    ("LM", "Left Midfield", "midfielder"),
    ("RM", "Right Midfield", "midfielder"),
    ("LW", "Left Winger", "forward"),
    ("Left Winger", "Left Winger", "forward"),
    ("RW", "Right Winger", "forward"),
    ("Right Winger", "Right Winger", "forward"),
    ("ST", "Striker", "forward"),
    ("Striker", "Striker", "forward"),
    ("CF", "Centre-Forward", "forward"),
    ("Centre-Forward", "Centre-Forward", "forward"),
    ("SS", "Second Striker", "forward"),
    ("Second Striker", "Second Striker", "forward"),
]

# Vendor spellings that win over the registry.
COUNTRY_OVERRIDES = [
    ("England", "GB"),
    ("England, United Kingdom", "GB"),
    ("Scotland", "GB"),
    ("Wales", "GB"),
    ("Northern Ireland", "GB"),
    ("USA", "US"),
    ("United States of America", "US"),
    ("Korea, South", "KR"),
    ("Korea, Republic of", "KR"),
    ("South Korea", "KR"),
    ("Korea, North", "KP"),
    ("North Korea", "KP"),
    ("Czech Republic", "CZ"),
    ("Czechia", "CZ"),
    ("Ivory Coast", "CI"),
    ("Cote d'Ivoire", "CI"),
    ("Democratic Republic of the Congo", "CD"),
    ("DR Congo", "CD"),
    ("Republic of the Congo", "CG"),
    ("Russian Federation", "RU"),
    ("Republic of Ireland", "IE"),
    ("Bosnia-Herzegovina", "BA"),
    ("FYR Macedonia", "MK"),
    ("North Macedonia", "MK"),
    ("Macedonia", "MK"),
]

# ISO 3166 short names that differ from the everyday names the JDK knows.
ISO_SHORT_NAMES = [
    ("Bolivia, Plurinational State of", "BO"),
    ("Bonaire, Sint Eustatius and Saba", "BQ"),
    ("Brunei Darussalam", "BN"),
    ("Cabo Verde", "CV"),
    ("Cocos (Keeling) Islands", "CC"),
    ("Congo", "CG"),
    ("Congo, The Democratic Republic of the", "CD"),
    ("Curaçao", "CW"),
    ("Côte d'Ivoire", "CI"),
    ("Eswatini", "SZ"),
    ("Falkland Islands (Malvinas)", "FK"),
    ("Heard Island and McDonald Islands", "HM"),
    ("Holy See (Vatican City State)", "VA"),
    ("Hong Kong", "HK"),
    ("Iran, Islamic Republic of", "IR"),
    ("Korea, Democratic People's Republic of", "KP"),
    ("Lao People's Democratic Republic", "LA"),
    ("Macao", "MO"),
    ("Micronesia, Federated States of", "FM"),
    ("Moldova, Republic of", "MD"),
    ("Myanmar", "MM"),
    ("Palestine, State of", "PS"),
    ("Pitcairn", "PN"),
    ("Réunion", "RE"),
    ("Saint Barthélemy", "BL"),
    ("Saint Helena, Ascension and Tristan da Cunha", "SH"),
    ("Saint Martin (French part)", "MF"),
    ("Sao Tome and Principe", "ST"),
    ("Sint Maarten (Dutch part)", "SX"),
    ("South Georgia and the South Sandwich Islands", "GS"),
    ("Syrian Arab Republic", "SY"),
    ("Taiwan, Province of China", "TW"),
    ("Tanzania, United Republic of", "TZ"),
    ("Turkey", "TR"),
    ("Türkiye", "TR"),
    ("United States", "US"),
    ("Venezuela, Bolivarian Republic of", "VE"),
    ("Viet Nam", "VN"),
    ("Virgin Islands, British", "VG"),
    ("Virgin Islands, U.S.", "VI"),
]


def match_key(raw: Column) -> Column:
    """Label without outer white space, in lower case."""
    return F.lower(F.regexp_replace(raw.cast("string"), r"(?U)^\s+|\s+$", ""))


def position_table(spark: SparkSession, taxonomy: list[tuple[str, str, str]] = POSITION_TAXONOMY) -> DataFrame:
    """(match key, canonical, category); the first label wins among equal keys."""
    first = {}
    for label, canonical, category in taxonomy:
        first.setdefault(label.strip().lower(), (canonical, category))
    rows = [(key, *value) for key, value in first.items()]
    return spark.createDataFrame(rows, "_key string, _canonical string, _category string")


@lru_cache(maxsize=1)
def _registry_names() -> tuple[tuple[str, str], ...]:
    """Every ISO 3166-1 code of the JDK with its alpha-3 code and English name."""
    spark = SparkSession.active()
    locale = spark.sparkContext._jvm.java.util.Locale
    english = locale.ENGLISH
    names = []
    for code in locale.getISOCountries():
        place = locale("", code)
        name = place.getDisplayCountry(english).replace("’", "'")
        spelled = {name, name.replace("&", "and"), name.replace("St.", "Saint")}
        spelled.add(name.replace("&", "and").replace("St.", "Saint"))
        names += [(code, code), (place.getISO3Country(), code), *((n, code) for n in sorted(spelled))]
    return tuple(names)


def country_table(
    spark: SparkSession,
    overrides: list[tuple[str, str]] = COUNTRY_OVERRIDES,
    extra_names: list[tuple[str, str]] = ISO_SHORT_NAMES,
) -> DataFrame:
    """(match key, alpha-2): overrides first, then ISO short names, then the JDK's registry."""
    first = {}
    for name, code in [*overrides, *extra_names, *_registry_names()]:
        first.setdefault(name.strip().lower(), code.upper())
    return spark.createDataFrame(list(first.items()), "_key string, _alpha2 string")


def normalise_position(
    df: DataFrame,
    column: str,
    canonical_out: str = "position_canonical",
    category_out: str = "position_category",
    taxonomy: DataFrame | None = None,
) -> DataFrame:
    """add the canonical label and its category; unmatched labels become ``Unknown``."""
    # The built-in table has a fixed size; the caller's is left to Spark.
    table = taxonomy if taxonomy is not None else F.broadcast(position_table(df.sparkSession))
    joined = df.join(table, match_key(F.col(column)) == F.col("_key"), "left")
    return joined.select(
        *df.columns,
        F.coalesce("_canonical", F.lit(UNKNOWN_POSITION)).alias(canonical_out),
        F.coalesce("_category", F.lit(UNKNOWN_POSITION)).alias(category_out),
    )


def normalise_country(df: DataFrame, column: str, out: str, countries: DataFrame | None = None) -> DataFrame:
    """add the ISO alpha-2 code of a country label; unmatched labels become ``XX``."""
    table = countries if countries is not None else F.broadcast(country_table(df.sparkSession))
    joined = df.join(table, match_key(F.col(column)) == F.col("_key"), "left")
    return joined.select(*df.columns, F.coalesce("_alpha2", F.lit(UNKNOWN_COUNTRY)).alias(out))
