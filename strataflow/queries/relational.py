"""Row-set operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators import ordered, relational
from strataflow.operators.asof import asof_join
from strataflow.queries.inputs import Tables, as_text, registry

QUERIES, SQL, query = registry()


@query(
    "project_rename",
    """SELECT c_custkey AS customer, c_name AS label, c_mktsegment AS segment, 'first' AS batch
       FROM customer""",
)
def project_rename(t: Tables) -> DataFrame:
    kept = relational.keep_existing(t.customer, ["c_mktsegment", "c_custkey", "no_such_column", "c_name"])
    renamed = kept.withColumnsRenamed({"c_custkey": "customer", "c_name": "label", "c_mktsegment": "segment", "absent": "x"})
    return renamed.withColumn("batch_id", F.lit("first")).withColumn("batch", F.lit("first")).transform(relational.drop_batch)


@query(
    "filters_all",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity
       FROM lineitem
       WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 10 AND 20
         AND l_discount >= 0.03 AND l_partkey IS NOT NULL AND l_shipdate IS NOT NULL
         AND l_shipdate >= TIMESTAMP '1996-01-01'""",
)
def filters_all(t: Tables) -> DataFrame:
    rows = relational.filter_eq(t.lineitem, "l_linestatus", "F")
    rows = relational.filter_isin(rows, "l_returnflag", ["A", "R"])
    rows = relational.filter_range(rows, "l_quantity", 10, 20)
    rows = relational.filter_range(rows, "l_discount", ge=0.03)
    rows = relational.filter_not_null(rows, ["l_partkey", "l_shipdate"])
    rows = rows.where(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")


def _size_class(row: dict) -> str:
    return f"{row['o_orderstatus']}-{'large' if row['o_totalprice'] > 250000 else 'small'}"


@query(
    "row_functions",
    """SELECT o_orderkey, o_orderstatus || '-' || CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS size_class
       FROM orders WHERE o_orderkey % 5 <> 0""",
)
def row_functions(t: Tables) -> DataFrame:
    kept = relational.filter_rows(t.orders, lambda r: r["o_orderkey"] % 5 != 0, ["o_orderkey"])
    derived = relational.derive(kept, "size_class", _size_class, ["o_orderstatus", "o_totalprice"], "string")
    return derived.select("o_orderkey", "size_class")


_BOUGHT = "(SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 10 = 0 THEN 500000 ELSE 0 END AS o_custkey FROM orders)"


def _bought(t: Tables) -> DataFrame:
    key = F.col("o_custkey") + F.when(F.col("o_orderkey") % 10 == 0, 500000).otherwise(0)
    return t.orders.select("o_orderkey", key.alias("o_custkey"))


def _join_query(how: str, sql_join: str) -> None:
    @query(
        f"joins_{how}",
        f"SELECT c_custkey, c_name, o_orderkey, o_custkey FROM customer {sql_join} JOIN {_BOUGHT} o ON c_custkey = o_custkey",
        sparse=("c_custkey", "o_orderkey", "o_custkey"),
    )
    def joined(t: Tables) -> DataFrame:
        on = F.col("c_custkey") == F.col("o_custkey")
        return t.customer.select("c_custkey", "c_name").join(_bought(t), on, how)


for _how, _sql in (("inner", "INNER"), ("left", "LEFT"), ("right", "RIGHT"), ("full_outer", "FULL")):
    _join_query(_how, _sql)


@query("joins_semi", f"SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM {_BOUGHT} o WHERE c_custkey = o_custkey)")
def joins_semi(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name").join(_bought(t), F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query("joins_anti", f"SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM {_BOUGHT} o WHERE c_custkey = o_custkey)")
def joins_anti(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name").join(_bought(t), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query(
    "agg_all",
    """SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty, count(l_partkey) AS n_parts,
              count(DISTINCT l_orderkey) AS n_orders, round(avg(CAST(l_quantity AS BIGINT)), 6) AS avg_qty,
              min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
              min_by(l_partkey, ROW(l_orderkey, l_linenumber, l_partkey)) AS first_part,
              max_by(l_partkey, ROW(l_orderkey, l_linenumber, l_partkey)) AS last_part
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def agg_all(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumns(
        {"qty": F.col("l_quantity").cast("long"), "position": F.struct("l_orderkey", "l_linenumber", "l_partkey")}
    )
    return relational.group_agg(
        lines,
        ["l_returnflag", "l_linestatus"],
        {
            "sum_qty": ("qty", "sum"),
            "n_parts": ("l_partkey", "count"),
            "n_orders": ("l_orderkey", "count_distinct"),
            "avg_qty": ("qty", "avg"),
            "min_price": ("l_extendedprice", "min"),
            "max_price": ("l_extendedprice", "max"),
            "first_part": ("l_partkey@position", "first"),
            "last_part": ("l_partkey@position", "last"),
        },
    ).withColumn("avg_qty", F.round("avg_qty", 6))


@query(
    "agg_conditional",
    """SELECT l_suppkey, CAST(count(*) AS BIGINT) AS n_lines,
              CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS n_returned,
              CAST(3 * sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) + sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS score,
              round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS return_rate
       FROM lineitem GROUP BY l_suppkey""",
)
def agg_conditional(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    counted = t.lineitem.groupBy("l_suppkey").agg(
        F.count("*").alias("n_lines"),
        F.count_if(flag == "R").cast("int").alias("n_returned"),
        (3 * F.count_if(flag == "A") + F.count_if(flag == "N")).alias("score"),
    )
    return counted.withColumn("return_rate", F.round(F.col("n_returned") / F.col("n_lines"), 6))


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS balance_cents FROM customer
       UNION ALL BY NAME
       SELECT s_suppkey AS id, s_name AS name, CAST(round(s_acctbal * 100) AS BIGINT) AS balance_cents FROM supplier""",
    sparse=("balance_cents",),
)
def union_by_name(t: Tables) -> DataFrame:
    buyers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    cents = F.round(F.col("s_acctbal") * 100).cast("long")
    sellers = t.supplier.select(cents.alias("balance_cents"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return relational.union_by_name([buyers, sellers])


@query(
    "two_sides",
    """SELECT l_orderkey, 'part' AS side, l_partkey AS id FROM lineitem
       UNION ALL SELECT l_orderkey, 'supplier', l_suppkey FROM lineitem""",
)
def two_sides(t: Tables) -> DataFrame:
    def side(name, column):
        return {"l_orderkey": F.col("l_orderkey"), "side": F.lit(name), "id": F.col(column)}

    return relational.two_sides(t.lineitem, [side("part", "l_partkey"), side("supplier", "l_suppkey")])


@query("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_type").distinct()


@query(
    "distinct_grouped_max",
    "SELECT user_id, event_type, max(event_id) AS last_event FROM events GROUP BY user_id, event_type",
)
def distinct_grouped_max(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", "event_type").agg(F.max("event_id").alias("last_event"))


@query(
    "dim_type1_dedupe",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def dim_type1_dedupe(t: Tables) -> DataFrame:
    order = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return relational.first_per_key(t.lineitem.select(*columns), ["l_orderkey", "l_linenumber"], order).drop("l_shipdate")


@query(
    "top_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
       WHERE rn <= 3""",
)
def top_per_key(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return relational.top_per_key(rows, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 3)


@query("topk_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk_orders(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return relational.top_k(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 10)


@query(
    "occurrence_counts",
    "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY l_orderkey, l_linenumber",
)
def occurrence_counts(t: Tables) -> DataFrame:
    return relational.occurrence_count(t.lineitem, ["l_orderkey", "l_linenumber"], "occurrences")


@query(
    "dense_numbering",
    """SELECT o_orderkey, row_number() OVER (ORDER BY nullif(o_custkey % 10, 3) ASC NULLS LAST, o_orderkey) AS number FROM orders""",
)
def dense_numbering(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.nullif(F.col("o_custkey") % 10, F.lit(3).cast("long")).alias("k"))
    order = [F.col("k").asc_nulls_last(), F.col("o_orderkey").asc()]
    return ordered.dense_number(rows, order, "number", one_task_rows=0).drop("k")


_NUMBER_SQL = "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number FROM events"


def _numbered(t: Tables, **limit) -> DataFrame:
    order = [F.col("ts").asc(), F.col("event_id").asc()]
    rows = t.events.select("user_id", "ts", "event_id")
    return ordered.row_number_by(rows, ["user_id"], order, "number", **limit).select("event_id", "number")


@query("row_numbers", _NUMBER_SQL)
def row_numbers(t: Tables) -> DataFrame:
    return _numbered(t)


@query("row_numbers_hot_keys", _NUMBER_SQL)
def row_numbers_hot_keys(t: Tables) -> DataFrame:
    """The shape for hot keys, forced by a low limit."""
    return _numbered(t, hot_limit=20)


_ROLLING_SQL = """
SELECT o_orderkey, round(avg(CAST(round(o_totalprice * 100) AS BIGINT)) OVER w, 6) AS mean_cents,
       CAST(count(*) OVER w AS INTEGER) AS in_frame
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""


def _rolled(t: Tables, **limit) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    order = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    rolled = ordered.rolling_mean(rows, ["o_custkey"], order, "cents", 5, "mean_cents", count_out="in_frame", **limit)
    return rolled.select("o_orderkey", F.round("mean_cents", 6).alias("mean_cents"), "in_frame")


@query("rolling_mean_rows", _ROLLING_SQL)
def rolling_mean_rows(t: Tables) -> DataFrame:
    return _rolled(t)


@query("rolling_mean_hot_keys", _ROLLING_SQL)
def rolling_mean_hot_keys(t: Tables) -> DataFrame:
    return _rolled(t, hot_limit=6)


_ASOF_SQL = """
WITH views AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view'),
     others AS (SELECT user_id, ts, event_id FROM events WHERE event_type IS DISTINCT FROM 'view')
SELECT b.event_id, v.event_id AS last_view
FROM others b ASOF LEFT JOIN views v ON b.user_id = v.user_id AND b.ts >= v.ts"""


def _last_view(t: Tables, **limits) -> DataFrame:
    rows = t.events.select("user_id", "ts", "event_id", "event_type")
    others = rows.where(~F.col("event_type").eqNullSafe("view")).drop("event_type")
    views = rows.where(F.col("event_type") == "view").drop("event_type")
    joined = asof_join(others, views, ["user_id"], "ts", "ts", None, {"event_id": "last_view"}, "event_id", **limits)
    return joined.select("event_id", "last_view")


@query("asof_events", _ASOF_SQL, sparse=("last_view",))
def asof_events(t: Tables) -> DataFrame:
    return _last_view(t)


@query("asof_events_many_versions", _ASOF_SQL, sparse=("last_view",))
def asof_events_many_versions(t: Tables) -> DataFrame:
    return _last_view(t, few_versions=0)


@query("asof_events_hot_keys", _ASOF_SQL, sparse=("last_view",))
def asof_events_hot_keys(t: Tables) -> DataFrame:
    return _last_view(t, few_versions=0, hot_limit=10)


_NESTED_SQL = """
WITH v AS (SELECT user_id, ts, event_id, ts + to_hours(CAST(event_id % 90 - 5 AS INTEGER)) AS until FROM events WHERE event_type = 'view')
SELECT e.event_id, (SELECT max_by(v.event_id, ROW(v.ts, v.event_id)) FROM v WHERE v.user_id = e.user_id AND v.ts <= e.ts AND e.ts <= v.until) AS valid_view
FROM events e"""


def _valid_view(t: Tables, **limits) -> DataFrame:
    """Versions that lie inside one another, overlap, leave gaps or end before they begin."""
    rows = t.events.select("user_id", "ts", "event_id")
    hours = F.make_dt_interval(hours=(F.col("event_id") % 90 - 5).cast("int"))
    views = t.events.where(F.col("event_type") == "view").select("user_id", "ts", "event_id", (F.col("ts") + hours).alias("until"))
    joined = asof_join(rows, views, ["user_id"], "ts", "ts", "until", {"event_id": "valid_view"}, "event_id", **limits)
    return joined.select("event_id", "valid_view")


@query("asof_nested_versions", _NESTED_SQL, sparse=("valid_view",))
def asof_nested_versions(t: Tables) -> DataFrame:
    return _valid_view(t)


@query("asof_nested_many_versions", _NESTED_SQL, sparse=("valid_view",))
def asof_nested_many_versions(t: Tables) -> DataFrame:
    return _valid_view(t, few_versions=0)


@query("asof_nested_hot_keys", _NESTED_SQL, sparse=("valid_view",))
def asof_nested_hot_keys(t: Tables) -> DataFrame:
    """Every key beyond the limit: running ends, the sweep and the carrying forward all go by range slices."""
    return _valid_view(t, few_versions=0, hot_limit=10)


@query(
    "previous_value_hot_keys",
    """SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_type FROM events""",
)
def previous_value_hot_keys(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "ts", "event_id", "event_type")
    order = [F.col("ts").asc(), F.col("event_id").asc()]
    stepped = ordered.previous_value(rows, ["user_id"], order, "event_type", "previous_type", hot_limit=7)
    return stepped.select("event_id", "previous_type")


@query(
    "row_counts",
    """SELECT 'orders' AS table_name, count(*) AS row_count, count(DISTINCT o_custkey) AS keys FROM orders
       UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey) FROM lineitem
       UNION ALL SELECT 'events', count(*), count(DISTINCT user_id) FROM events""",
)
def row_counts(t: Tables) -> DataFrame:
    parts = [("orders", t.orders, "o_custkey"), ("lineitem", t.lineitem, "l_orderkey"), ("events", t.events, "user_id")]
    return relational.union_by_name(
        [
            df.agg(F.count("*").alias("row_count"), F.count_distinct(key).alias("keys")).withColumn("table_name", F.lit(name))
            for name, df, key in parts
        ]
    )


@query(
    "latest_order_text",
    """SELECT o_custkey, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_day FROM orders GROUP BY o_custkey""",
)
def latest_order_text(t: Tables) -> DataFrame:
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("last_day"))
    return as_text(last, "last_day")
