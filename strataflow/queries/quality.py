"""Data-quality rules over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators import quality
from strataflow.operators.quality import CRITICAL, WARNING, ForeignKey, HasColumns, NotNull, Range, Unique
from strataflow.operators.relational import union_by_name
from strataflow.plans import quality_report
from strataflow.queries.inputs import Tables, registry
from strataflow.session import cut_lineage

QUERIES, SQL, query = registry()

LINE_RULES = [
    NotNull("lineitem", CRITICAL, ("l_orderkey", "l_shipdate")),
    Unique("lineitem", CRITICAL, ("l_orderkey", "l_linenumber")),
    ForeignKey("lineitem", CRITICAL, "l_orderkey", "orders", "o_orderkey"),
    Range("lineitem", WARNING, "l_quantity", 2, 45),
    Range("lineitem", WARNING, "l_discount", None, 0.08),
]
ORDER_RULES = [
    NotNull("orders", CRITICAL, ("o_orderkey", "o_priority")),
    Unique("orders", CRITICAL, ("o_orderkey",)),
    ForeignKey("orders", WARNING, "o_custkey", "customer", "c_custkey"),
    Range("orders", CRITICAL, "o_code", 2, 4),
    HasColumns("orders", WARNING, ("o_orderkey", "o_custkey", "o_clerk")),
]


def _lines(t: Tables) -> DataFrame:
    """Lines whose ship date is missing where the part number says so."""
    shipped = F.when(F.col("l_partkey") % 50 != 0, F.col("l_shipdate"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", shipped.alias("l_shipdate"))


def _orders(t: Tables) -> DataFrame:
    code = F.when(F.col("o_orderkey") % 30 == 0, F.lit("none")).otherwise(F.left("o_orderpriority", F.lit(1)))
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_priority"),
        F.when(F.col("o_orderkey") % 7 != 0, code).alias("o_code"),
    )


def _references(t: Tables) -> dict:
    return {
        ("orders", "o_orderkey"): t.orders.where(F.col("o_orderstatus") != "P").select("o_orderkey"),
        ("customer", "c_custkey"): t.customer.where(F.col("c_custkey") % 10 != 0).select("c_custkey"),
    }


LINES_SQL = """
lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount,
                 CASE WHEN l_partkey % 50 <> 0 THEN l_shipdate END AS l_shipdate FROM lineitem),
line_flags AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate IS NULL AS f0,
         count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS f1,
         NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P') AS f2,
         l_quantity < 2 OR l_quantity > 45 AS f3, l_discount > 0.08 AS f4
  FROM lines l),
line_rows AS (
  SELECT *, concat_ws(';', CASE WHEN f0 THEN 'not_null:lineitem:l_orderkey,l_shipdate' END,
           CASE WHEN f1 THEN 'unique:lineitem:l_orderkey,l_linenumber' END,
           CASE WHEN f2 THEN 'foreign_key:lineitem.l_orderkey->orders.o_orderkey' END) AS reason
  FROM line_flags)"""
ORDERS_SQL = """
order_in AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_priority,
         CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 30 = 0 THEN 'none' ELSE left(o_orderpriority, 1) END END AS o_code
  FROM orders),
order_rows AS (
  SELECT *, o_priority IS NULL AS f0, count(*) OVER (PARTITION BY o_orderkey) > 1 AS f1,
         NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 10 <> 0) AS f2,
         o_code IS NOT NULL AND (TRY_CAST(o_code AS DOUBLE) IS NULL OR TRY_CAST(o_code AS DOUBLE) < 2 OR TRY_CAST(o_code AS DOUBLE) > 4) AS f3
  FROM order_in)"""
OUTCOMES_SQL = f"""{LINES_SQL}, {ORDERS_SQL},
raw_outcomes(source_name, rule_id, severity, rows_evaluated, rows_failed) AS (
  SELECT 'lineitem', 'not_null:lineitem:l_orderkey,l_shipdate', 'critical', count(*), count(*) FILTER (WHERE f0) FROM line_rows UNION ALL
  SELECT 'lineitem', 'unique:lineitem:l_orderkey,l_linenumber', 'critical', count(*), count(*) FILTER (WHERE f1) FROM line_rows UNION ALL
  SELECT 'lineitem', 'foreign_key:lineitem.l_orderkey->orders.o_orderkey', 'critical', count(*), count(*) FILTER (WHERE f2) FROM line_rows UNION ALL
  SELECT 'lineitem', 'range:lineitem:l_quantity', 'warning', count(*), count(*) FILTER (WHERE f3) FROM line_rows UNION ALL
  SELECT 'lineitem', 'range:lineitem:l_discount', 'warning', count(*), count(*) FILTER (WHERE f4) FROM line_rows UNION ALL
  SELECT 'orders', 'not_null:orders:o_orderkey,o_priority', 'critical', count(*), count(*) FILTER (WHERE f0) FROM order_rows UNION ALL
  SELECT 'orders', 'unique:orders:o_orderkey', 'critical', count(*), count(*) FILTER (WHERE f1) FROM order_rows UNION ALL
  SELECT 'orders', 'foreign_key:orders.o_custkey->customer.c_custkey', 'warning', count(*), count(*) FILTER (WHERE f2) FROM order_rows UNION ALL
  SELECT 'orders', 'range:orders:o_code', 'critical', count(*), count(*) FILTER (WHERE f3) FROM order_rows UNION ALL
  SELECT 'orders', 'schema:orders', 'warning', count(*), count(*) FROM order_rows),
outcomes AS (SELECT *, round(CAST(rows_evaluated - rows_failed AS DOUBLE) / rows_evaluated, 6) AS pass_rate FROM raw_outcomes),
totals AS (
  SELECT 'lineitem' AS source_name, count(*) AS rows_in, count(*) FILTER (WHERE reason = '') AS rows_clean,
         count(*) FILTER (WHERE reason <> '') AS rows_quarantined FROM line_rows
  UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE NOT (f0 OR f1 OR f3)), count(*) FILTER (WHERE f0 OR f1 OR f3) FROM order_rows)"""


def _failing(t: Tables, rules, rows: DataFrame, references=None) -> DataFrame:
    annotated = quality.annotate(rows, rules, references)
    return annotated.where(F.col(quality.flag_name(rules[0], rules)))


@query("dq_not_null", f"WITH {LINES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM line_rows WHERE f0")
def dq_not_null(t: Tables) -> DataFrame:
    return _failing(t, LINE_RULES[:1], _lines(t)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("dq_range", f"WITH {ORDERS_SQL} SELECT o_orderkey, o_code FROM order_rows WHERE f3")
def dq_range(t: Tables) -> DataFrame:
    return _failing(t, ORDER_RULES[3:4], _orders(t)).select("o_orderkey", "o_code")


@query("dq_unique", f"WITH {LINES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM line_rows WHERE f1")
def dq_unique(t: Tables) -> DataFrame:
    return _failing(t, LINE_RULES[1:2], _lines(t)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("dq_fk", f"WITH {LINES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM line_rows WHERE f2")
def dq_fk(t: Tables) -> DataFrame:
    failing = _failing(t, LINE_RULES[2:3], _lines(t), _references(t))
    return failing.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "dq_fk_absent_or_empty_target",
    """SELECT 'absent' AS target, count(*) AS rows_in, CAST(0 AS BIGINT) AS failed FROM orders
       UNION ALL SELECT 'empty', count(*), count(*) FILTER (WHERE o_orderkey % 3 <> 0) FROM orders""",
)
def dq_fk_absent_or_empty_target(t: Tables) -> DataFrame:
    """Without the target every row passes; with an empty one every value fails and NULL passes."""
    rows = t.orders.select(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("o_custkey"))
    rules = [ForeignKey("orders", CRITICAL, "o_custkey", "customer", "c_custkey")]
    parts = []
    for name, target in (("absent", None), ("empty", t.customer.where(F.lit(False)).select("c_custkey"))):
        annotated = quality.annotate(rows, rules, {("customer", "c_custkey"): target})
        failed = F.count_if(F.col(quality.flag_name(rules[0], rules)))
        parts.append(annotated.agg(F.lit(name).alias("target"), F.count("*").alias("rows_in"), failed.alias("failed")))
    return union_by_name(parts)


@query(
    "dq_schema",
    """SELECT 'complete' AS expected, count(*) AS rows_in, CAST(0 AS BIGINT) AS failed FROM orders
       UNION ALL SELECT 'with o_clerk', count(*), count(*) FROM orders""",
)
def dq_schema(t: Tables) -> DataFrame:
    parts = []
    for name, columns in (("complete", ("o_orderkey",)), ("with o_clerk", ("o_orderkey", "o_clerk"))):
        rules = [HasColumns("orders", CRITICAL, columns)]
        failed = F.count_if(F.col(quality.flag_name(rules[0], rules)))
        annotated = quality.annotate(t.orders, rules)
        parts.append(annotated.agg(F.lit(name).alias("expected"), F.count("*").alias("rows_in"), failed.alias("failed")))
    return union_by_name(parts)


def _annotated_lines(t: Tables) -> DataFrame:
    return quality.annotate(_lines(t), LINE_RULES, _references(t))


@query("dq_clean", f"WITH {LINES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM line_rows WHERE reason = ''")
def dq_clean(t: Tables) -> DataFrame:
    clean = quality.clean_rows(_annotated_lines(t), LINE_RULES)
    return clean.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "dq_quarantine",
    f"""WITH {LINES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, reason AS _dq_failure_reason
        FROM line_rows WHERE reason <> ''""",
)
def dq_quarantine(t: Tables) -> DataFrame:
    failing = quality.failing_rows(_annotated_lines(t), LINE_RULES)
    return failing.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", quality.REASON)


def _results(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Totals and outcomes of both tables; each table is counted in one pass."""
    totals, found = [], []
    for name, rows, rules in (("lineitem", _lines(t), LINE_RULES), ("orders", _orders(t), ORDER_RULES)):
        counted = cut_lineage(quality.count_failures(quality.annotate(rows, rules, _references(t)), rules))
        totals.append(quality.source_totals(counted, name))
        found.append(quality.outcomes(counted, rules, name))
    return union_by_name(totals), union_by_name(found)


@query("dq_outcomes", f"WITH {OUTCOMES_SQL} SELECT * FROM outcomes")
def dq_outcomes(t: Tables) -> DataFrame:
    return _results(t)[1]


@query("dq_source_totals", f"WITH {OUTCOMES_SQL} SELECT * FROM totals")
def dq_source_totals(t: Tables) -> DataFrame:
    return _results(t)[0]


_SUMMARY_SQL = f"""WITH {OUTCOMES_SQL},
summary AS (
  SELECT 'b1' AS batch_id, CAST(sum(rows_in) AS BIGINT) AS total_rows_in, CAST(sum(rows_clean) AS BIGINT) AS total_rows_clean,
         CAST(sum(rows_quarantined) AS BIGINT) AS total_rows_quarantined,
         (SELECT count(*) FROM outcomes WHERE severity = 'critical' AND rows_failed > 0) AS critical_failure_count,
         (SELECT count(*) FROM outcomes WHERE severity = 'warning' AND rows_failed > 0) AS warning_count,
         (SELECT string_agg(DISTINCT source_name, ',' ORDER BY source_name) FROM outcomes WHERE severity = 'critical' AND rows_failed > 0) AS sources
  FROM totals)"""


@query("dq_report", _SUMMARY_SQL + "SELECT * FROM summary")
def dq_report(t: Tables) -> DataFrame:
    summary = quality_report.batch_summary(*_results(t), "b1")
    return summary.withColumn("sources", F.array_join("sources_with_critical_failures", ",")).drop(
        "sources_with_critical_failures"
    )


@query(
    "dq_gate",
    _SUMMARY_SQL
    + """, gates AS (SELECT *, CAST(total_rows_quarantined AS DOUBLE) / total_rows_in * 100 AS pct, unnest([5.0, 99.0]) AS threshold FROM summary)
        SELECT batch_id, CASE WHEN critical_failure_count > 0 AND pct > threshold THEN 'fail' ELSE 'pass' END AS decision,
               critical_failure_count AS critical_failures, total_rows_quarantined AS rows_quarantined, total_rows_in AS rows_in,
               round(pct, 2) AS quarantine_pct, CAST(threshold AS DOUBLE) AS threshold_pct FROM gates""",
)
def dq_gate(t: Tables) -> DataFrame:
    summary = cut_lineage(quality_report.batch_summary(*_results(t), "b1"))
    return union_by_name([quality_report.gate(summary), quality_report.gate(summary, 99.0)])


@query(
    "dq_min_rows",
    f"""WITH {OUTCOMES_SQL}, m(source_name, expected_min_rows) AS (VALUES ('lineitem', CAST(1000000000000 AS BIGINT)), ('orders', CAST(1 AS BIGINT)))
        SELECT source_name, rows_in, expected_min_rows, 'WARN' AS severity FROM totals JOIN m USING (source_name) WHERE rows_in < expected_min_rows""",
)
def dq_min_rows(t: Tables) -> DataFrame:
    return quality.below_minimum(_results(t)[0], {"lineitem": 10**12, "orders": 1})


_HISTORY_SQL = """
log AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id, 'table_' || CAST(user_id % 7 AS VARCHAR) AS table_name, event_type AS check_name,
         CASE WHEN event_id % 3 = 0 THEN 'ERROR' ELSE 'WARN' END AS severity, event_id % 4 <> 0 AS passed,
         CAST(100 AS BIGINT) AS rows_checked, event_id % 4 AS rows_failed, props AS details, ts AS recorded_at FROM events),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, table_name, check_name ORDER BY recorded_at DESC) AS rn FROM log) WHERE rn = 1)"""


def _log(t: Tables) -> DataFrame:
    key = F.col("event_id")
    return t.events.select(
        F.col("ts").cast("date").cast("string").alias("batch_id"),
        F.concat(F.lit("table_"), (F.col("user_id") % 7).cast("string")).alias("table_name"),
        F.col("event_type").alias("check_name"),
        F.when(key % 3 == 0, "ERROR").otherwise("WARN").alias("severity"),
        (key % 4 != 0).alias("passed"),
        F.lit(100).cast("long").alias("rows_checked"),
        (key % 4).alias("rows_failed"),
        F.col("props").alias("details"),
        F.col("ts").alias("recorded_at"),
    )


@query(
    "dq_history",
    f"""WITH {_HISTORY_SQL} SELECT batch_id, table_name, check_name, severity, passed, rows_checked, rows_failed, details FROM latest""",
)
def dq_history(t: Tables) -> DataFrame:
    return quality_report.latest_results(_log(t)).drop("recorded_at")


@query(
    "dq_history_errors",
    f"""WITH {_HISTORY_SQL} SELECT batch_id, count(*) FILTER (WHERE severity = 'ERROR' AND NOT passed) > 0 AS any_error FROM latest GROUP BY batch_id""",
)
def dq_history_errors(t: Tables) -> DataFrame:
    return quality_report.any_errors(_log(t))


@query(
    "dq_history_of_batch",
    f"""WITH {_HISTORY_SQL} SELECT table_name, check_name, severity, passed, rows_failed FROM latest WHERE batch_id = '2024-01-15'""",
)
def dq_history_of_batch(t: Tables) -> DataFrame:
    report = quality_report.report_for_batch(_log(t), "2024-01-15")
    return report.select("table_name", "check_name", "severity", "passed", "rows_failed")
