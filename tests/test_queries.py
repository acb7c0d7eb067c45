"""Every registered query against its own SQL, on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check_queries
from strataflow.functions.hashing import content_fingerprint
from strataflow.queries import storage

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry._merged("QUERIES", entry._MODULES), entry._merged("SQL", entry._MODULES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in check_queries.TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got = check_queries.rows_of(df.columns, df.collect())
    if name not in SQL:
        assert got
        return
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == check_queries.rows_of(names, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", ["id", "id % 2", "CAST(NULL AS LONG)"])
def test_partitions_dealt_anew_follow_the_table(spark, key):
    """Partitions stay as small as they should be, however few keys there are; equal rows stay as they are."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "64k")
    try:
        rows = spark.range(0, 200_000, numPartitions=16).select(F.expr(key).alias("k"), F.xxhash64("id").alias("v"))
        rows = rows.unionByName(rows.limit(10))
        dealt = storage.dealt_anew(rows, "k")
        sizes = [r.n for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("v")).collect()]
        assert sum(sizes) == 200_010 and max(sizes) < 200_000 / 10
        assert content_fingerprint(dealt).first() == content_fingerprint(rows).first()
    finally:
        spark.conf.unset(setting)
