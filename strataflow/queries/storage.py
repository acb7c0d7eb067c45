"""Reading, writing and finding snapshots, over the given tables and what they are written to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.hashing import content_fingerprint
from strataflow.operators import quality
from strataflow.operators.relational import union_by_name
from strataflow.plans import quality_report
from strataflow.queries.inputs import Tables, as_text, registry
from strataflow.session import scratch_path
from strataflow.sources import manifest, readers, snapshots
from strataflow.sources.catalogue import Source

QUERIES, SQL, query = registry()

ORDER_COLUMNS = {"o_orderkey": "int", "o_custkey": "int", "o_orderdate": "date", "o_totalprice": "float", "flag": "bool", "note": "string"}
_ORDER_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 4 <> 3 THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS o_orderdate, o_totalprice,
       o_orderstatus = 'F' AS flag, CASE WHEN o_orderkey % 6 = 1 THEN 'two' || chr(10) || 'lines, "quoted"' WHEN o_orderkey % 6 <> 0 THEN 'a "quoted", note' END AS note
FROM orders"""


def _messy_orders(t: Tables) -> DataFrame:
    """Orders as text with the faults a vendor's file may have."""
    key = F.col("o_orderkey")
    customer = F.col("o_custkey").cast("string")
    return t.orders.select(
        key.cast("string").alias("o_orderkey"),
        F.when(key % 4 == 0, F.lit("NA"))
        .when(key % 4 == 1, F.concat(customer, F.lit(".0")))
        .when(key % 4 == 3, F.concat(customer, F.lit(".5")))
        .otherwise(customer)
        .alias("o_custkey"),
        F.when(key % 5 == 0, F.lit("someday")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("o_orderdate"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        (F.col("o_orderstatus") == "F").cast("string").alias("flag"),
        F.when(key % 6 == 0, F.lit("missing")).when(key % 6 == 1, F.lit('two\nlines, "quoted"')).otherwise(F.lit('a "quoted", note')).alias("note"),
    )


def _messy_delivery(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The rows of a written CSV and those set aside: beside the orders it has rows with one or two values too many."""
    path = scratch_path(t.spark, "csv")
    _messy_orders(t).write.option("header", True).option("escape", '"').csv(path)
    key = F.col("o_orderkey")
    extra = F.when(key % 2 == 0, "stray").otherwise(",stray")
    line = F.concat_ws(",", key.cast("string"), F.lit("1"), F.lit("1998-01-01"), F.lit("0.5"), F.lit("true"), F.lit("note"), extra)
    # A single column with another separator, so that the line and the header are written as they stand.
    t.orders.where(key % 7 == 2).select(line.alias(",".join(ORDER_COLUMNS))).write.mode("append").option("header", True).option("sep", "\u0001").csv(path)
    return readers.csv_parts(t.spark, path, ORDER_COLUMNS, na_values=["missing"])


@query("csv_coerce", _ORDER_SQL, sparse=("o_custkey",))
def csv_coerce(t: Tables) -> DataFrame:
    return as_text(_messy_delivery(t)[0], "o_orderdate")


@query(
    "csv_malformed",
    """SELECT o_orderkey || ',1,1998-01-01,0.5,true,note,' || CASE WHEN o_orderkey % 2 = 0 THEN 'stray' ELSE ',stray' END AS malformed
       FROM orders WHERE o_orderkey % 7 = 2""",
)
def csv_malformed(t: Tables) -> DataFrame:
    """The second result of the delivery that ``csv_coerce`` reads."""
    return _messy_delivery(t)[1]


@query(
    "load_sources",
    "SELECT 'csv' AS format, count(*) AS row_count, sum(o_orderkey) :: BIGINT AS keys FROM orders"
    " UNION ALL SELECT 'json', count(*), sum(o_orderkey) :: BIGINT FROM orders"
    " UNION ALL SELECT 'parquet', count(*), sum(o_orderkey) :: BIGINT FROM orders",
)
def load_sources(t: Tables) -> DataFrame:
    """The same rows in each format; all loads have the same fingerprint."""
    root = scratch_path(t.spark, "raw")
    schema = {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "string"}
    rows = t.orders.select(*schema)
    rows.write.option("header", True).csv(f"{root}/delivery.csv")
    rows.write.json(f"{root}/delivery.json")
    rows.write.parquet(f"{root}/delivery.parquet")
    parts, seen = [], set()
    for kind in ("csv", "json", "parquet"):
        load = readers.load_source(t.spark, Source("delivery", ("o_orderkey",), schema, format=kind), root)
        seen.add((load.row_count, load.fingerprint))
        parts.append(load.rows.agg(F.lit(kind).alias("format"), F.count("*").alias("row_count"), F.sum("o_orderkey").alias("keys")))
    if len(seen) != 1:
        raise AssertionError(f"the formats differ: {seen}")
    return union_by_name(parts)


@query("parquet_roundtrip", "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem")
def parquet_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parquet")
    snapshots.write_table(t.lineitem, path)
    return as_text(readers.read_parquet(t.spark, path), "l_shipdate")


@query(
    "dynamic_overwrite",
    """SELECT o_orderpriority, count(*) AS orders, CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS rewritten
       FROM orders GROUP BY o_orderpriority""",
)
def dynamic_overwrite(t: Tables) -> DataFrame:
    """Writing one partition again leaves the others as they were."""
    path = scratch_path(t.spark, "partitions")
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.lit(0).alias("version"))
    snapshots.write_table(rows, path, ["o_orderpriority"])
    again = rows.where(F.col("o_orderpriority") == "2-HIGH").withColumn("version", F.lit(1))
    snapshots.write_table(again, path, ["o_orderpriority"])
    stored = readers.read_parquet(t.spark, path)
    return stored.groupBy("o_orderpriority").agg(F.count("*").alias("orders"), F.sum("version").alias("rewritten"))


@query(
    "append_error_modes",
    "SELECT s_suppkey, CAST(2 AS BIGINT) AS copies, TRUE AS refused FROM supplier",
)
def append_error_modes(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "modes")
    rows = t.supplier.select("s_suppkey")
    snapshots.write_table(rows, path, mode="error")
    snapshots.write_table(rows, path, mode="append")
    try:
        snapshots.write_table(rows, path, mode="error")
        refused = False
    except Exception:  # noqa: BLE001 - Spark names this error differently from version to version
        refused = True
    stored = readers.read_parquet(t.spark, path)
    return stored.groupBy("s_suppkey").agg(F.count("*").alias("copies"), F.lit(refused).alias("refused"))


@query(
    "batch_snapshots",
    """SELECT 'day-1' AS batch_id, c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0
       UNION ALL SELECT '2024-01-02', c_custkey, c_name FROM customer""",
)
def batch_snapshots(t: Tables) -> DataFrame:
    """Batch ids stay text, whatever they look like; writing a batch again replaces only that batch."""
    root = scratch_path(t.spark, "bronze")
    rows = t.customer.select("c_custkey", "c_name")
    snapshots.write_snapshot(rows, root, "customer", "day-1")
    snapshots.write_snapshot(rows, root, "customer", "2024-01-02")
    snapshots.write_snapshot(rows.where(F.col("c_custkey") % 2 == 0), root, "customer", "day-1")
    return union_by_name([snapshots.read_snapshot(t.spark, root, "customer", b) for b in ("day-1", "2024-01-02")])


@query("temp_views", "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def temp_views(t: Tables) -> DataFrame:
    snapshots.register_views(t.spark, {"v_customer": t.customer, "v_nation": t.nation, "v_missing": None})
    return t.spark.sql(
        "SELECT n_name, count(*) AS customers FROM v_customer JOIN v_nation ON c_nationkey = n_nationkey GROUP BY n_name"
    )


@query("rejected_sink", "SELECT o_orderkey, 'not_null:orders:o_priority' AS _dq_failure_reason, 'b1' AS batch_id FROM orders WHERE o_orderstatus = 'P'")
def rejected_sink(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "lake")
    rules = [quality.NotNull("orders", quality.CRITICAL, ("o_priority",))]
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_priority"))
    annotated = quality.annotate(rows, rules)
    snapshots.write_rejected(quality.failing_rows(annotated, rules), root, "orders", "b1")
    return snapshots.read_snapshot(t.spark, f"{root}/_rejected", "orders", "b1").drop("o_priority")


@query(
    "dq_report_sink",
    """SELECT 'b1' AS batch_id, count(*) AS total_rows_in, count(*) FILTER (WHERE o_orderstatus = 'P') AS total_rows_quarantined,
              'orders' AS source_name, 'not_null:orders:o_priority' AS rule_id, count(*) FILTER (WHERE o_orderstatus = 'P') AS rows_failed FROM orders""",
)
def dq_report_sink(t: Tables) -> DataFrame:
    """The report as written to JSON and read back."""
    root = scratch_path(t.spark, "reports")
    rules = [quality.NotNull("orders", quality.CRITICAL, ("o_priority",))]
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_priority"))
    annotated = quality.annotate(rows, rules)
    counted = quality.count_failures(annotated, rules)
    totals, found = quality.source_totals(counted, "orders"), quality.outcomes(counted, rules, "orders")
    report = quality_report.batch_report(totals, found, "b1")
    quality_report.write_report(report, root, "b1")
    stored = quality_report.read_report(t.spark, root, "b1")
    return (
        stored.select("batch_id", "total_rows_in", "total_rows_quarantined", F.explode("sources").alias("s"))
        .select("*", F.explode("s.rules").alias("r"))
        .select("batch_id", "total_rows_in", "total_rows_quarantined", "s.source_name", "r.rule_id", "r.rows_failed")
    )


# --- Fingerprints and manifests ---


#: Keys whose lines make one file; the number of files follows the table.
FILE_KEYS = 500


@query(
    "fingerprint_files",
    f"""SELECT p_partkey // {FILE_KEYS} AS bucket, CAST(sum(strlen(line) + 1) AS BIGINT) AS size_bytes,
               md5(string_agg(line || chr(10), '' ORDER BY p_partkey)) AS checksum_md5
       FROM (SELECT p_partkey, concat_ws('|', p_partkey, p_name, p_brand, p_type, p_size, CAST(round(p_retailprice * 100) AS BIGINT)) AS line FROM part)
       GROUP BY p_partkey // {FILE_KEYS}""",
)
def fingerprint_files(t: Tables) -> DataFrame:
    """Files written from the parts of this run, one per run of keys, their lines in the order of the key."""
    path = scratch_path(t.spark, "files")
    columns = [c if c != "p_retailprice" else F.round(F.col(c) * 100).cast("long") for c in t.part.columns]
    lines = t.part.select(F.expr(f"p_partkey div {FILE_KEYS}").alias("bucket"), "p_partkey", F.concat_ws("|", *columns).alias("line"))
    dealt = lines.repartition("bucket").sortWithinPartitions("bucket", "p_partkey")
    dealt.select("bucket", "line").write.partitionBy("bucket").text(path)
    found = readers.file_fingerprints(t.spark, path).where(F.col("file_name").startswith("part-"))
    return found.select(F.regexp_extract("file_path", "bucket=(\\d+)", 1).cast("long").alias("bucket"), "size_bytes", "checksum_md5")


def dealt_anew(rows: DataFrame, by: str) -> DataFrame:
    """The same rows in other partitions, whose number follows the table; adaptive execution cuts those of hot keys."""
    return rows.hint("rebalance", by)


@query(
    "fingerprint_tables",
    """SELECT 'reordered' AS variant, TRUE AS same_content, count(*) AS row_count FROM lineitem
       UNION ALL SELECT 'one row twice', FALSE, count(*) + 1 FROM lineitem
       UNION ALL SELECT 'one value changed', FALSE, count(*) FROM lineitem""",
)
def fingerprint_tables(t: Tables) -> DataFrame:
    """A table's fingerprint ignores row order and notices any other difference."""
    rows = t.lineitem
    most = rows.agg(F.max(F.struct(*rows.columns)).alias("r"))
    twice = rows.unionByName(most.select("r.*"))
    last = F.broadcast(most.withColumnRenamed("r", "_last"))  # one row
    is_last = F.struct(*rows.columns).eqNullSafe(F.col("_last"))
    marked = rows.join(last, rows["l_orderkey"] == F.col("_last.l_orderkey"), "left")
    changed = marked.withColumn("l_partkey", F.when(is_last, F.col("l_partkey") + 1).otherwise(F.col("l_partkey"))).drop("_last")
    base = content_fingerprint(rows).select(F.col("fingerprint").alias("base"), F.lit(1).alias("_one"))
    variants = {"reordered": dealt_anew(rows, "l_partkey"), "one row twice": twice, "one value changed": changed}
    found = union_by_name([content_fingerprint(v).withColumn("variant", F.lit(n)) for n, v in variants.items()])
    joined = found.withColumn("_one", F.lit(1)).join(base, "_one")
    return joined.select("variant", (F.col("fingerprint") == F.col("base")).alias("same_content"), "row_count")


_MANIFEST_SQL = """
m AS (SELECT c_custkey, c_custkey % 6 AS kind FROM customer)"""


@query(
    "manifest_parse",
    f"""WITH {_MANIFEST_SQL}
        SELECT c_custkey, CASE kind WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'unsupported version' WHEN 2 THEN 'unknown fields: extra'
               WHEN 3 THEN 'missing fields: vendor' WHEN 4 THEN 'a field has the wrong type' END AS problem,
               CASE WHEN kind = 5 THEN c_custkey * 10 END AS size_bytes FROM m""",
    sparse=("size_bytes",),
)
def manifest_parse(t: Tables) -> DataFrame:
    """One manifest per customer, most of them broken in one way or another."""
    key = F.col("c_custkey")
    head = '{"manifest_version": %s, %s"dataset": "d", "dataset_version": 3, "vendor_last_updated": "t", "fetched_at": "t", %s"files": {"a.csv": {"size_bytes": '
    tail = ', "checksum_md5": "x"}}}'

    def text(version, vendor, extra, size):
        return F.concat(F.lit(head % (version, vendor, extra)), size, F.lit(tail))

    vendor, size = '"vendor": "v", ', (key * 10).cast("string")
    kind = key % 6
    value = (
        F.when(kind == 0, F.lit('{"manifest_version": 1, "vendor'))
        .when(kind == 1, text("2", vendor, "", size))
        .when(kind == 2, text("1", vendor, '"extra": 1, ', size))
        .when(kind == 3, text("1", "", "", size))
        .when(kind == 4, text("1", vendor, "", F.lit('"big"')))
        .otherwise(text("1", vendor, "", size))
    )
    parsed = manifest.parse_manifests(t.customer.select("c_custkey", value.alias("value")))
    good = F.when(F.col("problem").isNull(), F.col("files")["a.csv"]["size_bytes"])
    return parsed.select("c_custkey", "problem", good.alias("size_bytes"))


@query(
    "manifest_check",
    """SELECT 'f' || CAST(p_partkey AS VARCHAR) AS file_name, md5(p_name) AS listed_md5, md5(p_name || '!') AS computed_md5
       FROM part WHERE p_partkey % 9 = 0""",
)
def manifest_check(t: Tables) -> DataFrame:
    name = F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("file_name")
    listed = t.part.select(name, F.md5("p_name").alias("checksum_md5"))
    body = F.when(F.col("p_partkey") % 9 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name"))
    computed = t.part.where(F.col("p_partkey") % 10 != 7).select(name, F.md5(body).alias("checksum_md5"))
    # A file whose part number ends in 7 was not delivered, so it cannot differ.
    delivered = manifest.checksum_mismatches(listed, computed)
    missing = manifest.checksum_mismatches(
        listed, t.part.where(F.col("p_partkey") % 10 == 7).select(name, F.md5(body).alias("checksum_md5"))
    )
    return delivered.unionByName(missing)


# --- Which batch holds what ---

_FILES_SQL = """
files AS (
  SELECT CAST(event_id AS VARCHAR) AS batch_id, 'src' || CAST(user_id % 5 AS VARCHAR) AS source_name,
         md5(CAST(event_id % 97 AS VARCHAR)) AS fingerprint, ts AS registered_at,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ingested' END AS status,
         CASE WHEN event_id % 4 = 0 THEN 'held-' || CAST(event_id % 97 AS VARCHAR) END AS data_batch_id
  FROM events),
landed AS (SELECT * FROM files WHERE status = 'ingested')"""


def _files(t: Tables) -> DataFrame:
    key = F.col("event_id")
    return t.events.select(
        key.cast("string").alias("batch_id"),
        F.concat(F.lit("src"), (F.col("user_id") % 5).cast("string")).alias("source_name"),
        F.md5((key % 97).cast("string")).alias("fingerprint"),
        F.col("ts").alias("registered_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ingested").alias("status"),
        F.when(key % 4 == 0, F.concat(F.lit("held-"), (key % 97).cast("string"))).alias("data_batch_id"),
    )


@query(
    "unchanged_skip",
    f"""WITH {_FILES_SQL},
        arriving AS (SELECT CAST(o_orderkey AS VARCHAR) AS batch_id, 'src' || CAST(o_custkey % 6 AS VARCHAR) AS source_name,
                            md5(CAST(o_orderkey % 120 AS VARCHAR)) AS fingerprint FROM orders),
        ranked AS (SELECT a.batch_id, a.source_name, a.fingerprint, coalesce(l.data_batch_id, l.batch_id) AS data_batch_id,
                          row_number() OVER (PARTITION BY a.batch_id ORDER BY l.registered_at DESC) AS rn
                   FROM arriving a LEFT JOIN landed l ON l.source_name = a.source_name AND l.fingerprint = a.fingerprint AND l.batch_id <> a.batch_id)
        SELECT batch_id, source_name, fingerprint, data_batch_id FROM ranked WHERE rn = 1""",
)
def unchanged_skip(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    arriving = t.orders.select(
        key.cast("string").alias("batch_id"),
        F.concat(F.lit("src"), (F.col("o_custkey") % 6).cast("string")).alias("source_name"),
        F.md5((key % 120).cast("string")).alias("fingerprint"),
    )
    return snapshots.previously_landed(_files(t), arriving)


@query(
    "resolve_snapshot",
    f"""WITH {_FILES_SQL},
        asked AS (SELECT 'src' || CAST(s_suppkey % 6 AS VARCHAR) AS source_name, CAST(s_suppkey * 37 AS VARCHAR) AS batch_id FROM supplier),
        as_of AS (SELECT a.*, coalesce((SELECT max(registered_at) FROM files f WHERE f.batch_id = a.batch_id), (SELECT max(registered_at) FROM files)) AS at FROM asked a),
        ranked AS (SELECT a.source_name, a.batch_id, coalesce(l.data_batch_id, l.batch_id) AS data_batch_id,
                          row_number() OVER (PARTITION BY a.source_name, a.batch_id ORDER BY l.batch_id = a.batch_id DESC, l.registered_at DESC) AS rn
                   FROM as_of a LEFT JOIN landed l ON l.source_name = a.source_name AND l.registered_at <= a.at)
        SELECT source_name, batch_id, data_batch_id FROM ranked WHERE rn = 1""",
)
def resolve_snapshot(t: Tables) -> DataFrame:
    asked = t.supplier.select(
        F.concat(F.lit("src"), (F.col("s_suppkey") % 6).cast("string")).alias("source_name"),
        (F.col("s_suppkey") * 37).cast("string").alias("batch_id"),
    )
    return snapshots.resolve_snapshots(_files(t), asked)


@query(
    "high_water_mark",
    """SELECT event_type AS table_name, CAST(max(event_id) AS BIGINT) AS mark, arg_max(user_id, ts) :: VARCHAR AS batch_id FROM events GROUP BY event_type""",
)
def high_water_mark(t: Tables) -> DataFrame:
    """Marks only ever rise here, as event ids rise with time."""
    marks = t.events.select(
        F.col("event_type").alias("table_name"), F.col("event_id").alias("mark"), F.col("user_id").cast("string").alias("batch_id"), F.col("ts").alias("updated_at")
    )
    return snapshots.latest_marks(marks).drop("updated_at")


@query(
    "incremental_read",
    """SELECT event_type, max(event_id) AS mark, count(*) AS rows FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00' GROUP BY event_type""",
)
def incremental_read(t: Tables) -> DataFrame:
    return snapshots.next_mark(snapshots.rows_after(t.events, "ts", dt.datetime(2024, 1, 20)), "event_id", ["event_type"])
