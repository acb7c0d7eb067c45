"""Column expressions and lookups over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions import hashing, lookups, scalars
from strataflow.operators.relational import derive
from strataflow.plans import star
from strataflow.queries.inputs import (
    COUNTRY_LABELS,
    DATE_KEY_SQL,
    POSITION_LABELS,
    POSITION_SQL,
    SEASON_SQL,
    Tables,
    as_text,
    dealt,
    dealt_sql,
    registry,
)

QUERIES, SQL, query = registry()

SALT = "public-example-salt"


@query(
    "outcome_season_key",
    f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
                CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 5 AS DOUBLE) + 0.5 END AS home,
                CASE WHEN o_orderkey % 23 <> 0 THEN o_custkey % 5 END AS away FROM orders)
        SELECT o_orderkey,
               CASE WHEN home IS NULL OR away IS NULL THEN 'unknown' WHEN floor(home) > away THEN 'home_win'
                    WHEN away > floor(home) THEN 'away_win' ELSE 'draw' END AS outcome,
               {SEASON_SQL.format('day')} AS season, {DATE_KEY_SQL.format('day')} AS date_key
        FROM o""",
)
def outcome_season_key(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    home = F.when(key % 19 != 0, (key % 5).cast("double") + 0.5)
    away = F.when(key % 23 != 0, F.col("o_custkey") % 5)
    day = scalars.day_of(t.orders, "o_orderdate")
    return t.orders.select(
        "o_orderkey",
        scalars.match_outcome(home, away).alias("outcome"),
        scalars.season(day).alias("season"),
        scalars.date_key(day).alias("date_key"),
    )


@query(
    "dates_from_text",
    f"""WITH d AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL
                          WHEN event_id % 5 = 0 THEN CAST(ts AS DATE) END AS day, ts FROM events),
             e AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS day FROM d)
        SELECT event_id, {SEASON_SQL.format('day')} AS season, {DATE_KEY_SQL.format('day')} AS date_key FROM e""",
    sparse=("date_key",),
)
def dates_from_text(t: Tables) -> DataFrame:
    """Dates written as ISO date-times, as plain dates, or as junk."""
    key = F.col("event_id")
    text = (
        F.when(key % 11 == 0, F.lit("2024-02-30T10:00:00"))
        .when(key % 5 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd"), F.lit(" ")))
    )
    rows = t.events.select("event_id", text.alias("day"))
    day = scalars.day_of(rows, "day")
    return rows.select("event_id", scalars.season(day).alias("season"), scalars.date_key(day).alias("date_key"))


@query(
    "dim_date",
    f"""WITH bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST((SELECT max(l_shipdate) FROM lineitem) AS DATE) AS b FROM orders),
             days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds)
        SELECT {DATE_KEY_SQL.format('day')} AS date_key, CAST(day AS VARCHAR) AS date, CAST(year(day) AS INTEGER) AS year,
               CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month, CAST(day(day) AS INTEGER) AS day,
               CAST(isodow(day) - 1 AS INTEGER) AS day_of_week, strftime(day, '%A') AS day_name,
               isodow(day) >= 6 AS is_weekend, {SEASON_SQL.format('day')} AS season
        FROM days""",
)
def dim_date(t: Tables) -> DataFrame:
    """A calendar over the days the orders and shipments span."""
    first = t.orders.agg(F.min("o_orderdate").cast("date").alias("d")).first()["d"]
    last = t.lineitem.agg(F.max("l_shipdate").cast("date").alias("d")).first()["d"]
    return as_text(star.build_dim_date(t.spark, first, last), "date")


@query(
    "calendar_rollup",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, strftime(o_orderdate, '%A') AS day_name,
              isodow(o_orderdate) >= 6 AS is_weekend, count(*) AS orders
       FROM orders GROUP BY ALL""",
)
def calendar_rollup(t: Tables) -> DataFrame:
    calendar = scalars.calendar_columns(scalars.day_of(t.orders, "o_orderdate"))
    return (
        t.orders.select(*[calendar[c].alias(c) for c in ("year", "day_name", "is_weekend")])
        .groupBy("year", "day_name", "is_weekend")
        .agg(F.count("*").alias("orders"))
    )


@query(
    "position_lookup",
    f"""WITH {POSITION_SQL}, p AS (SELECT c_custkey, {dealt_sql(POSITION_LABELS, 'c_custkey')} AS label FROM customer)
        SELECT c_custkey, label, coalesce(canonical, 'Unknown') AS position_canonical, coalesce(category, 'Unknown') AS position_category
        FROM p LEFT JOIN taxonomy ON raw_key = lower(trim(label))""",
)
def position_lookup(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", dealt(POSITION_LABELS, F.col("c_custkey")).alias("label"))
    return lookups.normalise_position(rows, "label")


@query(
    "country_iso",
    f"""WITH {POSITION_SQL}, p AS (SELECT o_orderkey, {dealt_sql(COUNTRY_LABELS, 'o_orderkey')} AS label FROM orders)
        SELECT o_orderkey, label, coalesce(alpha2, 'XX') AS iso FROM p LEFT JOIN countries ON raw_key = lower(trim(label))""",
)
def country_iso(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", dealt(COUNTRY_LABELS, F.col("o_orderkey")).alias("label"))
    return lookups.normalise_country(rows, "label", "iso")


@query(
    "pii_tokens",
    f"""SELECT c_custkey, 'pii_' || left(sha256('{SALT}' || c_name), 8) AS name,
              CASE WHEN c_custkey % 3 <> 0 THEN 'pii_' || left(sha256('{SALT}' || CAST(c_nationkey AS VARCHAR)), 8) END AS nation
       FROM customer""",
)
def pii_tokens(t: Tables) -> DataFrame:
    nation = F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey"))
    rows = t.customer.select("c_custkey", F.col("c_name").alias("name"), nation.alias("nation"))
    return hashing.tokenize_columns(rows, ["name", "nation", "absent"], SALT)


@query(
    "row_hash",
    """SELECT c_custkey, md5(concat_ws('␟', coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END, '<NULL>'),
              CAST(c_nationkey AS VARCHAR), CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR))) AS row_hash
       FROM customer""",
)
def row_hash(t: Tables) -> DataFrame:
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment"),
        "c_nationkey",
        F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"),
    )
    return hashing.with_row_hash(rows, ["segment", "c_nationkey", "cents"]).select("c_custkey", "row_hash")


@query(
    "schema_hash",
    """WITH c AS (SELECT DISTINCT o_orderpriority AS source_name, 'c' || CAST(o_custkey % 40 AS VARCHAR) AS name,
                         CASE WHEN o_custkey % 3 = 0 THEN 'bigint' ELSE 'string' END AS type
                  FROM orders)
       SELECT source_name, md5(string_agg(name || ':' || type, chr(10) ORDER BY name || ':' || type)) AS schema_hash
       FROM c GROUP BY source_name""",
)
def schema_hash(t: Tables) -> DataFrame:
    key = F.col("o_custkey")
    columns = (
        t.orders.select(
            F.col("o_orderpriority").alias("source_name"),
            F.concat(F.lit("c"), (key % 40).cast("string")).alias("name"),
            F.when(key % 3 == 0, "bigint").otherwise("string").alias("type"),
        )
        .distinct()
    )
    return hashing.schema_hash(columns, ["source_name"])


@query(
    "ratios_and_percentages",
    """SELECT o_custkey, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
              round(CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'O') > 0
                THEN CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) FILTER (WHERE o_orderstatus = 'O') ELSE 0 END, 6) AS per_open,
              round(CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) * 100, 2) AS finished_pct
       FROM orders GROUP BY o_custkey""",
)
def ratios_and_percentages(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    counted = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.count_if(status == "F").alias("finished"), F.count_if(status == "O").alias("open")
    )
    return counted.select(
        "o_custkey",
        "orders",
        "finished",
        F.round(scalars.safe_ratio(F.col("finished"), F.col("open")), 6).alias("per_open"),
        scalars.percentage(F.col("finished"), F.col("orders")).alias("finished_pct"),
    )


@query(
    "json_payload",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
              '{"type":"' || event_type || '","k":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}' AS payload
       FROM events""",
)
def json_payload(t: Tables) -> DataFrame:
    decoded = t.events.select("event_id", "event_type", F.from_json("props", "k bigint").alias("p"))
    payload = F.to_json(F.struct(F.col("event_type").alias("type"), F.col("p.k").alias("k")))
    return decoded.select("event_id", F.col("p.k").alias("k"), payload.alias("payload"))


@query(
    "value_map_and_casts",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'partial' END AS state,
              CAST(left(o_orderpriority, 1) AS INTEGER) AS priority, TRY_CAST(o_orderpriority AS INTEGER) AS whole_priority,
              CAST(o_orderkey AS VARCHAR) AS key_text
       FROM orders""",
    sparse=("whole_priority",),
)
def value_map_and_casts(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "F", "finished").when(status == "O", "open").otherwise("partial").alias("state"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("priority"),
        F.col("o_orderpriority").try_cast("int").alias("whole_priority"),
        F.col("o_orderkey").cast("string").alias("key_text"),
    )


def _weekday_name(row: dict) -> str:
    return "missing" if row["o_orderdate"] is None else row["o_orderdate"].strftime("%a")


@query("row_function_on_dates", "SELECT o_orderkey, strftime(o_orderdate, '%a') AS weekday FROM orders")
def row_function_on_dates(t: Tables) -> DataFrame:
    return derive(t.orders, "weekday", _weekday_name, ["o_orderdate"], "string").select("o_orderkey", "weekday")
