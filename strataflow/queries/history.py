"""Type 2 history over daily snapshots of the customers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators import scd2
from strataflow.operators.asof import nested_versions
from strataflow.queries.inputs import Tables, as_text, registry

QUERIES, SQL, query = registry()

KEY, TRACKED, SK = ["c_custkey"], ["c_mktsegment", "c_nationkey"], "c_sk"
DAY2, DAY3 = dt.date(1998, 1, 1), dt.date(1999, 1, 1)


def day1(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def day2(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    rows = day1(t).withColumn("c_name", F.lower("c_name"))
    stayed = rows.where(key % 11 != 0).withColumn(
        "c_mktsegment", F.when(key % 7 == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment"))
    )
    return stayed.unionByName(rows.where(key % 13 == 0).withColumn("c_custkey", key + 1000000))


def day3(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return day2(t).where(key % 5 != 0).withColumn(
        "c_nationkey", F.when(key % 14 == 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    )


DAYS_SQL = """
day1 AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer),
day2 AS (
  SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment
  FROM day1 WHERE c_custkey % 11 <> 0
  UNION ALL SELECT c_custkey + 1000000, lower(c_name), c_nationkey, c_mktsegment FROM day1 WHERE c_custkey % 13 = 0),
day3 AS (
  SELECT c_custkey, c_name, CASE WHEN c_custkey % 14 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS c_nationkey, c_mktsegment
  FROM day2 WHERE c_custkey % 5 <> 0)"""


def _merge_sql(before: str, incoming: str, date: str, out: str) -> str:
    columns = "c_custkey, c_name, c_nationkey, c_mktsegment"
    return f"""
{out}_delta AS (
  SELECT n.*, o.c_custkey IS NULL AS fresh,
         row_number() OVER (ORDER BY o.c_custkey IS NULL, n.c_custkey) + (SELECT max(c_sk) FROM {before}) AS c_sk
  FROM {incoming} n LEFT JOIN (SELECT * FROM {before} WHERE is_current) o ON n.c_custkey = o.c_custkey
  WHERE o.c_custkey IS NULL OR n.c_mktsegment IS DISTINCT FROM o.c_mktsegment OR n.c_nationkey IS DISTINCT FROM o.c_nationkey),
{out} AS (
  SELECT {', '.join('b.' + c for c in columns.split(', '))}, b.c_sk, b.effective_date,
         CASE WHEN b.is_current AND d.c_custkey IS NOT NULL THEN DATE '{date}' ELSE b.end_date END AS end_date,
         b.is_current AND d.c_custkey IS NULL AS is_current
  FROM {before} b LEFT JOIN (SELECT c_custkey FROM {out}_delta WHERE NOT fresh) d ON b.c_custkey = d.c_custkey
  UNION ALL SELECT {columns}, c_sk, DATE '{date}', DATE '9999-12-31', TRUE FROM {out}_delta)"""


DIM_SQL = f"""WITH {DAYS_SQL},
dim1 AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS c_sk, DATE '1900-01-01' AS effective_date,
                DATE '9999-12-31' AS end_date, TRUE AS is_current FROM day1),
{_merge_sql('dim1', 'day2', '1998-01-01', 'dim2')},
{_merge_sql('dim2', 'day3', '1999-01-01', 'dim3')}"""
_SHOW = """SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_sk, CAST(effective_date AS VARCHAR) AS effective_date,
 CAST(end_date AS VARCHAR) AS end_date, is_current FROM """


def _load(t: Tables) -> DataFrame:
    return scd2.scd2_merge(None, day1(t), KEY, TRACKED, SK, scd2.FAR_PAST).dimension


def _second(t: Tables) -> scd2.MergeResult:
    return scd2.scd2_merge(_load(t), day2(t), KEY, TRACKED, SK, DAY2)


def _third(t: Tables) -> DataFrame:
    return scd2.scd2_merge(_second(t).dimension, day3(t), KEY, TRACKED, SK, DAY3).dimension


@query("scd2_initial_load", DIM_SQL + _SHOW + "dim1")
def scd2_initial_load(t: Tables) -> DataFrame:
    return as_text(_load(t), "effective_date", "end_date")


@query("scd2_merge_day2", DIM_SQL + _SHOW + "dim2")
def scd2_merge_day2(t: Tables) -> DataFrame:
    return as_text(_second(t).dimension, "effective_date", "end_date")


@query("scd2_merge_day3", DIM_SQL + _SHOW + "dim3")
def scd2_merge_day3(t: Tables) -> DataFrame:
    return as_text(_third(t), "effective_date", "end_date")


@query(
    "scd2_merge_stats",
    DIM_SQL
    + """SELECT (SELECT count(*) FROM dim2_delta WHERE fresh) AS new_versions,
                (SELECT count(*) FROM dim2_delta WHERE NOT fresh) AS changed_versions,
                (SELECT count(*) FROM day2 JOIN dim1 USING (c_custkey)) - (SELECT count(*) FROM dim2_delta WHERE NOT fresh) AS unchanged_versions,
                CAST(0 AS BIGINT) AS historical_preserved,
                (SELECT count(*) FROM dim1 WHERE c_custkey NOT IN (SELECT c_custkey FROM day2)) AS absent_kept,
                (SELECT count(*) FROM dim2) AS total_output_rows""",
)
def scd2_merge_stats(t: Tables) -> DataFrame:
    return _second(t).stats


@query(
    "scd2_classify",
    DIM_SQL
    + """SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey,
                CASE WHEN o.c_custkey IS NULL THEN 'NEW' WHEN n.c_custkey IS NULL THEN 'ABSENT'
                     WHEN n.c_mktsegment IS DISTINCT FROM o.c_mktsegment OR n.c_nationkey IS DISTINCT FROM o.c_nationkey THEN 'CHANGED'
                     ELSE 'UNCHANGED' END AS status
         FROM day2 n FULL JOIN dim1 o ON n.c_custkey = o.c_custkey""",
)
def scd2_classify(t: Tables) -> DataFrame:
    return scd2.classify(_load(t), day2(t), KEY, TRACKED).drop("arrivals", "_since")


@query(
    "scd2_history_immutable",
    DIM_SQL
    + """SELECT (SELECT count(*) FROM dim2 WHERE NOT is_current) AS closed_before,
                (SELECT count(*) FROM (SELECT c_sk, c_custkey, c_name, c_nationkey, c_mktsegment, effective_date, end_date FROM dim2 WHERE NOT is_current
                   EXCEPT ALL SELECT c_sk, c_custkey, c_name, c_nationkey, c_mktsegment, effective_date, end_date FROM dim3 WHERE NOT is_current)) AS altered,
                (SELECT count(*) FROM (SELECT end_date < max(end_date) OVER (PARTITION BY c_custkey ORDER BY effective_date, c_sk
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS inside FROM dim3) WHERE inside) AS nested""",
)
def scd2_history_immutable(t: Tables) -> DataFrame:
    """Closed versions that a later merge changed or lost, and versions inside one another: none."""
    second, third = _second(t).dimension, _third(t)
    closed = second.where(~F.col("is_current"))
    same = ["c_sk", "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "effective_date", "end_date", "is_current"]
    altered = closed.select(*same).join(third.select(*same), same, "left_anti").agg(F.count("*").alias("altered"))
    nested = nested_versions(third, KEY, "effective_date", "end_date", SK).agg(F.count("*").alias("nested"))
    before = closed.agg(F.count("*").alias("closed_before"))
    one = [df.withColumn("_one", F.lit(1)) for df in (before, altered, nested)]
    return one[0].join(one[1], "_one").join(one[2], "_one").drop("_one")


@query(
    "scd2_late_keys_from_far_past",
    DIM_SQL
    + """SELECT c_custkey, CAST(CASE WHEN effective_date = DATE '1998-01-01' AND c_custkey >= 1000000 THEN DATE '1900-01-01'
           ELSE effective_date END AS VARCHAR) AS effective_date, is_current FROM dim2""",
)
def scd2_late_keys_from_far_past(t: Tables) -> DataFrame:
    """Keys that appear later may be dated back, so that their earlier events resolve."""
    merged = scd2.scd2_merge(_load(t), day2(t), KEY, TRACKED, SK, DAY2, first_version_effective=scd2.FAR_PAST)
    return as_text(merged.dimension.select("c_custkey", "effective_date", "is_current"), "effective_date")
