"""Operators against hand-written rows and brute force, in both of their shapes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strataflow.operators import ordered, relational, scd2
from strataflow.operators.asof import asof_join, nested_versions


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows; times repeat, some values are missing."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        key = 0 if i % 3 == 0 else rng.randrange(1, 120)
        rows.append((key, rng.randrange(60), i, rng.choice([None, rng.randrange(1000)])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, at int, id int, v int").repartition(4)
    return rows, df



def order():
    return [F.col("at").asc(), F.col("id").asc()]


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("limit", [10**9, 10])
def test_row_number(skewed, limit):
    rows, df = skewed
    got = {r["id"]: r["n"] for r in ordered.row_number_by(df, ["k"], order(), "n", limit).collect()}
    assert got == {r[2]: i + 1 for g in by_key(rows).values() for i, r in enumerate(g)}


@pytest.mark.parametrize("limit", [10**9, 10])
def test_rolling_mean(skewed, limit):
    rows, df = skewed
    rolled = ordered.rolling_mean(df, ["k"], order(), "v", 7, "m", count_out="n", number_out="rn", hot_limit=limit)
    got = {r["id"]: (r["m"], r["n"], r["rn"]) for r in rolled.collect()}
    want = {}
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            frame = group[max(0, i - 6) : i + 1]
            values = [r[3] for r in frame if r[3] is not None]
            want[row[2]] = (sum(values) / len(values) if values else None, len(frame), i + 1)
    assert got == want


def test_rolling_mean_two_rows(spark):
    df = spark.createDataFrame([(1, 1, 1e6), (1, 2, 2e6), (1, 3, 3e6)], "k int, at int, v double")
    rolled = ordered.rolling_mean(df, ["k"], [F.col("at").asc()], "v", 2, "m")
    assert [r["m"] for r in rolled.orderBy("at").collect()] == [1e6, 1.5e6, 2.5e6]


@pytest.mark.parametrize("limit", [10**9, 10])
def test_previous_value(skewed, limit):
    rows, df = skewed
    got = {r["id"]: r["p"] for r in ordered.previous_value(df, ["k"], order(), "id", "p", limit).collect()}
    assert got == {r[2]: (g[i - 1][2] if i else None) for g in by_key(rows).values() for i, r in enumerate(g)}


@pytest.mark.parametrize("limit", [10**9, 10])
def test_carry_forward(skewed, limit):
    rows, df = skewed
    got = {r["id"]: r["c"] for r in ordered.carry_forward(df, ["k"], ["at", "id"], "v", "c", limit).collect()}
    want = {}
    for group in by_key(rows).values():
        last = None
        for row in group:
            last = row[3] if row[3] is not None else last
            want[row[2]] = last
    assert got == want


@pytest.mark.parametrize("alone", [10**6, 0])
def test_dense_number_is_total_and_starts_where_told(skewed, alone):
    rows, df = skewed
    columns = [F.col("v").asc_nulls_last(), F.col("id").asc()]
    got = {r["id"]: r["n"] for r in ordered.dense_number(df, columns, "n", start=11, one_task_rows=alone).collect()}
    in_order = sorted(rows, key=lambda r: (r[3] is None, r[3] or 0, r[2]))
    assert got == {r[2]: i + 11 for i, r in enumerate(in_order)}
    empty = ordered.dense_number(df.where("false"), columns, "n", one_task_rows=alone)
    assert empty.collect() == []


@pytest.mark.parametrize("few,limit", [(10**9, 10**9), (0, 10**9), (0, 10)])
def test_asof_join_with_ends_and_ties(spark, few, limit):
    rng = random.Random(5)
    versions, sk = [], 0
    for key in range(40):
        start = 0
        for _ in range(40 if key == 0 else rng.randrange(0, 5)):
            sk += 1
            end = start + rng.randrange(0, 4)  # sometimes no longer than a day, sometimes with a gap behind
            versions.append((key, start, end, sk))
            start = end + rng.randrange(0, 3)
    events = [(i, None if i % 50 == 1 else (0 if i % 3 == 0 else rng.randrange(45)), None if i % 41 == 2 else rng.randrange(160)) for i in range(600)]
    v = spark.createDataFrame(versions, "k int, a int, b int, sk int").repartition(3)
    e = spark.createDataFrame(events, "id int, k int, at int").repartition(3)
    joined = asof_join(e, v, ["k"], "at", "a", "b", {"sk": "found"}, "sk", few_versions=few, hot_limit=limit)
    assert joined.columns == ["id", "k", "at", "found"]
    got = {r["id"]: r["found"] for r in joined.collect()}
    want = {}
    for i, key, at in events:
        live = [(a, s) for k, a, b, s in versions if at is not None and k == key and a <= at <= b]
        want[i] = max(live)[1] if live else None
    assert got == want
    assert joined.count() == len(events)
    assert nested_versions(v, ["k"], "a", "b", "sk").isEmpty()


@pytest.mark.parametrize(("few", "limit"), [(1000, 10**9), (0, 10**9), (0, 20)])
def test_asof_join_with_versions_inside_one_another(spark, few, limit):
    rng = random.Random(8)
    versions = [(rng.randrange(12), a := rng.randrange(60), a + rng.randrange(-3, 40), sk) for sk in range(1, 120)]
    events = [(i, None if i % 60 == 1 else rng.randrange(12), None if i % 41 == 2 else rng.randrange(110)) for i in range(500)]
    v = spark.createDataFrame(versions, "k int, a int, b int, sk int").repartition(3)
    e = spark.createDataFrame(events, "id int, k int, at int").repartition(3)
    got = {r["id"]: r["found"] for r in asof_join(e, v, ["k"], "at", "a", "b", {"sk": "found"}, "sk", few_versions=few, hot_limit=limit).collect()}
    want = {}
    for i, key, at in events:
        live = [(a, s) for k, a, b, s in versions if at is not None and k == key and a <= at <= b]
        want[i] = max(live)[1] if live else None
    assert got == want


def test_asof_join_either_side_of_a_change(spark):
    day = dt.date
    versions = spark.createDataFrame(
        [(100, day(2024, 1, 1), day(2024, 6, 30), 1), (100, day(2024, 7, 1), day(9999, 12, 31), 2)], "k int, a date, b date, sk int"
    )
    events = spark.createDataFrame(
        [(1, 100, day(2024, 4, 15)), (2, 100, day(2024, 9, 15)), (3, 100, day(2023, 12, 31)), (4, 7, day(2024, 4, 15))], "id int, k int, at date"
    )
    joined = asof_join(events, versions, ["k"], "at", "a", "b", {"sk": "sk"}, "sk")
    assert {r["id"]: r["sk"] for r in joined.collect()} == {1: 1, 2: 2, 3: None, 4: None}
    with pytest.raises(ValueError, match="lack"):
        asof_join(events, versions.drop("b"), ["k"], "at", "a", "b", {"sk": "sk"}, "sk")


def test_filters_ignore_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (4, 9.0)], "id int, v double")
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(relational.filter_range(df, "v", ge=1.0)) == [1, 4]
    assert ids(relational.filter_range(df, "v", le=5.0)) == [1]
    assert ids(relational.filter_range(df, "v")) == [1, 2, 3, 4]
    assert ids(relational.filter_not_null(df, ["v"])) == [1, 4]
    assert ids(relational.filter_eq(df, "v", 9.0)) == [4]
    assert ids(relational.filter_isin(df, "id", [2, 3])) == [2, 3]


def test_union_needs_a_table_and_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2,)], "i int")
    assert sorted(map(tuple, relational.union_by_name([a, b]).collect())) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        relational.union_by_name([])


def test_group_agg_keeps_the_null_group(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 5), ("a", 3, None)], "k string, at int, v int")
    out = relational.group_agg(
        df, ["k"], {"n": ("v", "count"), "d": ("v", "count_distinct"), "m": ("v", "avg"), "l": ("v@at", "last"), "f": ("at@at", "first")}
    )
    assert {r["k"]: (r["n"], r["d"], r["m"], r["l"], r["f"]) for r in out.collect()} == {None: (2, 1, 5.0, 5, 1), "a": (0, 0, None, None, 3)}
    with pytest.raises(ValueError):
        relational.group_agg(df, ["k"], {"x": ("v", "median")})
    with pytest.raises(ValueError):
        relational.group_agg(df, ["k"], {"x": ("v", "first")})


def test_top_per_key_is_limited_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    best = relational.top_per_key(df, ["k"], [F.col("id").desc()], 2)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(r["id"] for r in best.collect()) == [994, 995, 996, 997, 998, 999]


# --- Type 2 history ---

TRACKED = ["club", "position", "value"]


def players(spark, *rows):
    return spark.createDataFrame(rows, "player_id int, name string, club int, position string, value double")


def merge(existing, incoming, date, **more):
    return scd2.scd2_merge(existing, incoming, ["player_id"], TRACKED, "sk", date, **more)


def versions(df):
    return sorted(
        (r["sk"], r["player_id"], r["name"], r["club"], str(r["effective_date"]), str(r["end_date"]), r["is_current"]) for r in df.collect()
    )


D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def test_scd2_four_statuses_and_absence(spark):
    first = merge(None, players(spark, (2, "b", 1, "GK", 1.0), (1, "a", 1, None, 1.0), (3, "c", 1, "ST", 1.0), (4, "d", 1, "ST", 1.0)), D1)
    assert [v[:2] for v in versions(first.dimension)] == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert tuple(first.stats.first()) == (4, 0, 0, 0, 0, 4)
    # 1: only the untracked name changes; 2: changes; 3: NULL for a value; 4: absent; 5 and 6: new
    second = merge(
        first.dimension,
        players(spark, (6, "f", 2, "GK", 1.0), (1, "renamed", 1, None, 1.0), (2, "b", 9, "GK", 1.0), (3, "c", 1, None, 1.0), (5, "e", 2, "GK", 1.0)),
        D2,
    )
    assert tuple(second.stats.first()) == (2, 2, 1, 0, 1, 8)
    far = "9999-12-31"
    assert versions(second.dimension) == [
        (1, 1, "a", 1, "2024-01-01", far, True),
        (2, 2, "b", 1, "2024-01-01", "2024-02-01", False),
        (3, 3, "c", 1, "2024-01-01", "2024-02-01", False),
        (4, 4, "d", 1, "2024-01-01", far, True),
        (5, 2, "b", 9, "2024-02-01", far, True),
        (6, 3, "c", 1, "2024-02-01", far, True),
        (7, 5, "e", 2, "2024-02-01", far, True),
        (8, 6, "f", 2, "2024-02-01", far, True),
    ]
    # The same snapshot again changes nothing; history passes through untouched.
    same = merge(second.dimension, players(spark, (2, "b", 9, "GK", 1.0)), D3)
    assert versions(same.dimension) == versions(second.dimension)
    assert same.stats.first()["historical_preserved"] == 2
    # Merging is repeatable.
    assert versions(merge(second.dimension, players(spark, (7, "g", 1, "GK", 1.0), (2, "b", 8, "GK", 1.0)), D3).dimension) == versions(
        merge(second.dimension, players(spark, (2, "b", 8, "GK", 1.0), (7, "g", 1, "GK", 1.0)), D3).dimension
    )


def test_scd2_edge_inputs(spark):
    empty = players(spark).where("false")
    nothing = merge(None, empty, D1)
    assert {"sk", "effective_date", "end_date", "is_current"} <= set(nothing.dimension.columns)
    assert nothing.dimension.count() == 0 and tuple(nothing.stats.first()) == (0, 0, 0, 0, 0, 0)
    started = merge(nothing.dimension, players(spark, (1, "a", 1, "GK", 1.0)), D2)
    assert versions(started.dimension) == [(1, 1, "a", 1, "2024-02-01", "9999-12-31", True)]
    kept = merge(started.dimension, empty, D3)
    assert versions(kept.dimension) == versions(started.dimension)
    late = merge(started.dimension, players(spark, (2, "b", 1, "GK", 1.0)), D3, first_version_effective=scd2.FAR_PAST)
    assert {r["player_id"]: str(r["effective_date"]) for r in late.dimension.collect()} == {1: "2024-02-01", 2: "1900-01-01"}


def test_scd2_null_natural_key_matches_itself(spark):
    first = merge(None, players(spark, (None, "x", 1, "GK", 1.0), (1, "a", 1, "GK", 1.0)), D1)
    assert [v[:2] for v in versions(first.dimension)] == [(1, 1), (2, None)]
    second = merge(first.dimension, players(spark, (None, "x", 2, "GK", 1.0)), D2)
    assert tuple(second.stats.first()) == (0, 1, 0, 0, 1, 3)


def test_scd2_refuses_bad_input(spark):
    rows = players(spark, (1, "a", 1, "GK", 1.0), (1, "a", 2, "GK", 1.0))
    with pytest.raises(ValueError, match="2 times"):
        merge(None, rows, D1)
    first = merge(None, rows.limit(1), D1).dimension
    with pytest.raises(ValueError, match="2 times"):
        merge(first, rows, D2)
    second = merge(first, players(spark, (1, "a", 3, "GK", 1.0)), D2).dimension
    with pytest.raises(ValueError, match="would close"):
        merge(second, players(spark, (1, "a", 4, "GK", 1.0)), D2 - dt.timedelta(days=1))
    for key, tracked in (([], TRACKED), (["player_id"], []), (["absent"], TRACKED), (["player_id"], ["absent"])):
        with pytest.raises(ValueError):
            scd2.scd2_merge(None, rows, key, tracked, "sk", D1)


def test_scd2_numbers_a_large_delta_alike(spark, monkeypatch):
    rows = spark.range(300).select(
        F.col("id").cast("int").alias("player_id"), F.lit("n").alias("name"), F.lit(1).alias("club"), F.lit("GK").alias("position"), F.lit(1.0).alias("value")
    )
    moved = rows.withColumn("club", F.when(F.col("player_id") % 2 == 0, 2).otherwise(1))
    grown = moved.unionByName(rows.withColumn("player_id", F.col("player_id") + 1000))
    small = merge(merge(None, rows, D1).dimension, grown, D2).dimension
    plain = versions(small)
    monkeypatch.setattr(scd2, "dense_number", lambda df, by, out, start=1, rows=None: ordered.dense_number(df, by, out, start, rows, one_task_rows=0))
    monkeypatch.setattr(scd2, "BROADCAST_KEYS", 0)
    assert versions(merge(merge(None, rows, D1).dimension, grown, D2).dimension) == plain
