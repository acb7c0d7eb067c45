"""Column expressions, coercion and lookups on hand-written rows."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from strataflow.functions import hashing, lookups, scalars
from strataflow.sources.schema import coerce, struct_type


def values(df, column):
    return [r[column] for r in df.collect()]


def test_season_and_key_of_dates_and_texts(spark):
    texts = ["2024-10-15", "2025-03-20", "2025-08-12", "2025-07-31", "2024-10-15T20:00:00", " 2024-10-15 20:00 ", "1999-12-01", "2024-13-01", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "d string").coalesce(1)
    day = scalars.day_of(df, "d")
    assert values(df.select(scalars.season(day).alias("s")), "s") == [
        "2024-25", "2024-25", "2025-26", "2024-25", "2024-25", "2024-25", "1999-00", None, None, None, None,
    ]
    assert values(df.select(scalars.date_key(day).alias("k")), "k")[:3] == [20241015, 20250320, 20250812]
    stamps = spark.createDataFrame([(dt.datetime(2024, 7, 31, 23, 59),), (dt.datetime(2024, 8, 1),)], "d timestamp_ntz").coalesce(1)
    assert values(stamps.select(scalars.season(scalars.day_of(stamps, "d")).alias("s")), "s") == ["2023-24", "2024-25"]


def test_season_on_every_day_of_two_years(spark):
    days = spark.range(731).select(F.date_add(F.lit(dt.date(2023, 1, 1)), F.col("id").cast("int")).alias("d"))
    wrong = days.select("d", scalars.season(F.col("d")).alias("s")).collect()
    for r in wrong:
        start = r["d"].year if r["d"].month >= 8 else r["d"].year - 1
        assert r["s"] == f"{start}-{(start + 1) % 100:02d}"


def test_outcome(spark):
    rows = [(2.0, 0.0), (0.0, 1.0), (1.0, 1.0), (None, 0.0), (3.0, None), (float("nan"), 1.0), (1.9, 1.2)]
    df = spark.createDataFrame(rows, "h double, a double").coalesce(1)
    assert values(df.select(scalars.match_outcome(F.col("h"), F.col("a")).alias("o")), "o") == [
        "home_win", "away_win", "draw", "unknown", "unknown", "unknown", "draw",
    ]


def test_row_hash_is_the_documented_digest(spark):
    df = spark.createDataFrame([(1, "x", 120000000.0), (None, "", 0.5)], "a int, b string, c double").coalesce(1)
    want = [hashlib.md5("␟".join(t).encode()).hexdigest() for t in (("1", "x", "120000000.0"), ("<NULL>", "", "0.5"))]
    assert values(hashing.with_row_hash(df, ["a", "b", "c"]), "row_hash") == want


def test_row_hash_tells_null_from_empty_and_values_apart(spark):
    rows = [(None, "a"), ("", "a"), ("<NULL>", "b"), ("a", None), ("a", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert hashing.with_row_hash(df, ["a", "b"]).select("row_hash").distinct().count() == len(rows)
    close = spark.createDataFrame([(1e7,), (1e7 + 2e-9,), (1.5e300,), (-1e7,), (1e-5,)], "v double")
    assert hashing.with_row_hash(close, ["v"]).select("row_hash").distinct().count() == 5


def test_tokens(spark):
    df = spark.createDataFrame([("Ann", 42, 1.0), (None, None, float("nan")), ("", 42, None)], "s string, i int, d double").coalesce(1)
    got = hashing.tokenize_columns(df, ["s", "i", "d", "absent"], "salt").collect()
    digest = lambda t: "pii_" + hashlib.sha256(("salt" + t).encode()).hexdigest()[:8]
    assert [(r["s"], r["i"]) for r in got] == [(digest("Ann"), digest("42")), (None, None), (digest(""), digest("42"))]
    assert got[1]["d"] is None and got[2]["d"] is None
    assert len(hashing.tokenize_columns(df, ["s"], "salt", 16).first()["s"]) == 20
    with pytest.raises(ValueError):
        hashing.tokenize_columns(df, ["s"], "")


def test_schema_hash_ignores_order(spark):
    pairs = [("b", "int"), ("a", "string")]
    digest = hashlib.md5(b"a:string\nb:int").hexdigest()
    for rows in (pairs, pairs[::-1]):
        assert hashing.schema_hash(spark.createDataFrame(rows, "name string, type string")).first()["schema_hash"] == digest


def test_fingerprint(spark):
    def of(*rows):
        return tuple(hashing.content_fingerprint(spark.createDataFrame(rows, "a int, b string")).first())

    base = of((1, "x"), (2, "y"))
    assert of((2, "y"), (1, "x")) == base
    others = [of((1, "x")), of((1, "y"), (2, "x")), of((1, "x"), (2, "y"), (2, "y"), (2, "y")), of((1, "x"), (2, None)), of((1, "x"), (2, ""))]
    assert len({base, *others}) == 6


def test_positions(spark):
    labels = ["GK", "goalkeeper", " CB ", "Sweeper", "", None, "\tst\n"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "i int, p string")
    got = [(r["position_canonical"], r["position_category"]) for r in lookups.normalise_position(df, "p").orderBy("i").collect()]
    unknown = ("Unknown", "Unknown")
    assert got == [("Goalkeeper", "goalkeeper")] * 2 + [("Centre-Back", "defender")] + [unknown] * 3 + [("Striker", "forward")]


def test_countries(spark):
    labels = {
        "England, United Kingdom": "GB", "Brazil": "BR", "brazil": "BR", "BRA": "BR", "br": "BR", "Côte d'Ivoire": "CI", "Atlantis": "XX",
        "": "XX", " Spain ": "ES", "Korea, South": "KR", "Bosnia and Herzegovina": "BA", "Saint Lucia": "LC", "Viet Nam": "VN", "Türkiye": "TR",
        "Germany": "DE", "United States": "US", "Trinidad and Tobago": "TT",
    }
    df = spark.createDataFrame([(v,) for v in labels], "c string")
    assert {r["c"]: r["iso"] for r in lookups.normalise_country(df, "c", "iso").collect()} == labels
    none = spark.createDataFrame([(None,)], "c string")
    assert lookups.normalise_country(none, "c", "iso").first()["iso"] == "XX"


def test_coercion(spark):
    raw = spark.createDataFrame(
        [("1", "1.5", "true", "2024-02-03T10:00:00", "x"), ("1.0", "abc", "maybe", "03/02/2024", "NA"), ("1.5", "-", "", "2024-02-30", "?"),
         ("9007199254740993", "1e3", "FALSE", "2024-02-03", " NA")],
        "i string, f string, b string, d string, s string",
    ).coalesce(1)
    got = coerce(raw, {"i": "int", "f": "float", "b": "bool", "d": "date", "declared_only": "int"}, ["?"])
    assert dict(got.dtypes) == {"i": "bigint", "f": "double", "b": "boolean", "d": "date", "s": "string"}
    day = dt.date(2024, 2, 3)
    assert [tuple(r) for r in got.collect()] == [
        (1, 1.5, True, day, "x"), (1, None, None, None, None), (None, None, None, None, None), (9007199254740993, 1000.0, False, day, " NA"),
    ]
    with pytest.raises(ValueError):
        coerce(raw, {"i": "decimal"})
    with pytest.raises(ValueError):
        struct_type({"a": "array"})
