"""Batch-partitioned tables: writing, skipping, finding and reading snapshots."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.scalars import literal_like
from strataflow.operators.asof import asof_join
from strataflow.operators.relational import BATCH_COLUMN, top_per_key

_MODES = {"overwrite": "overwrite", "append": "append", "error": "errorifexists"}

# File states that mean the rows were landed.
LANDED_STATES = ("ingested", "transforming", "transformed")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet sink. A partitioned overwrite replaces only the partitions it brings."""
    if mode not in _MODES:
        raise ValueError(f"unknown mode {mode!r}; known: {sorted(_MODES)}")
    writer = df.write.mode(_MODES[mode])
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _checked(batch_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.\-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r} does not name a folder")
    return batch_id


def snapshot_path(root: str, table: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/{table}/{BATCH_COLUMN}={_checked(batch_id)}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def write_snapshot(df: DataFrame, root: str, table: str, batch_id: str) -> None:
    """One batch of a table; other batches are left alone.

    The batch lies in a folder of its own, so rows need not be shuffled or sorted by batch.
    """
    df.drop(BATCH_COLUMN).write.mode("overwrite").parquet(snapshot_path(root, table, batch_id))


def publish_snapshot(spark: SparkSession, staged: str, root: str, table: str, batch_id: str) -> None:
    """Make a written folder a batch of a table by moving it; a folder of that batch that is there already goes."""
    target = snapshot_path(root, table, batch_id)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path(target), True)
    files.mkdirs(path(target).getParent())
    if not files.rename(path(staged), path(target)):
        raise OSError(f"{staged} could not be moved to {target}")


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_snapshot(spark: SparkSession, root: str, table: str, batch_id: str) -> DataFrame:
    """One batch of a table; only its own folder is listed, and its id stays the text it is."""
    return spark.read.parquet(snapshot_path(root, table, batch_id)).withColumn(BATCH_COLUMN, F.lit(batch_id))


def write_rejected(failing: DataFrame, root: str, source: str, batch_id: str) -> bool:
    """Rows that failed a critical rule; nothing is written where there are none."""
    if failing.isEmpty():
        return False
    write_snapshot(failing, f"{root.rstrip('/')}/_rejected", source, batch_id)
    return True


def register_views(spark: SparkSession, tables: dict[str, DataFrame | None]) -> list[str]:
    """One temporary view per table that exists, over the snapshot it was given."""
    made = []
    for name, table in tables.items():
        if table is not None:
            table.createOrReplaceTempView(name)
            made.append(name)
    return made


# --- Which snapshot holds what. All take the table of file states of `plans.lineage.file_states`. ---


def previously_landed(files: DataFrame, arriving: DataFrame) -> DataFrame:
    """For each arriving (batch_id, source_name, fingerprint), the batch that already holds its content.

    ``data_batch_id`` is that batch, or NULL where the content is new. Of each content only the last two
    batches are kept, limited before the exchange, so it does not matter how often content was re-sent.
    """
    content = ["_source", "_fingerprint"]
    landed = files.where(F.col("status").isin(*LANDED_STATES)).select(
        F.col("source_name").alias("_source"),
        F.col("fingerprint").alias("_fingerprint"),
        F.struct(
            "registered_at",
            "batch_id",
            F.coalesce("data_batch_id", "batch_id").alias("held_in"),
        ).alias("_landing"),
    )
    per_batch = landed.groupBy(*content, F.col("_landing.batch_id").alias("_batch")).agg(F.max("_landing").alias("_landing"))
    # A batch is never its own predecessor, so the one before the last is needed as well.
    last_two = top_per_key(per_batch, content, [F.col("_landing").desc()], 2)
    known = last_two.groupBy(*content).agg(F.max("_landing").alias("_last"), F.min("_landing").alias("_earlier"))
    joined = arriving.join(
        known,
        (F.col("source_name") == F.col("_source")) & (F.col("fingerprint") == F.col("_fingerprint")),
        "left",
    )
    own = F.col("batch_id")
    held = F.when(F.col("_last.batch_id") != own, F.col("_last.held_in")).when(
        F.col("_earlier.batch_id") != own, F.col("_earlier.held_in")
    )
    return joined.select(*arriving.columns, held.alias("data_batch_id"))


def resolve_snapshots(files: DataFrame, batches: DataFrame) -> DataFrame:
    """For every (source, batch) pair asked for, the batch whose folder holds the source as of then.

    "As of" goes by registration time, never by the text of the batch id; a batch that registered nothing
    sees the latest landing. A skipped landing recorded where its content lies, so no chain is walked.
    ``batches`` is (source_name, batch_id); the result adds ``data_batch_id``, NULL if there is none.
    """
    registered = files.groupBy("batch_id").agg(F.max("registered_at").alias("_as_of")).withColumnRenamed("batch_id", "_b")
    asked = batches.join(registered, F.col("batch_id") == F.col("_b"), "left").drop("_b")
    latest = files.agg(F.max("registered_at").cast("string").alias("m")).first()["m"]
    asked = asked.withColumn("_as_of", F.coalesce("_as_of", literal_like(files, "registered_at", latest)))
    landings = files.where(F.col("status").isin(*LANDED_STATES)).select(
        "source_name",
        "registered_at",
        F.col("batch_id").alias("_landing"),
        F.coalesce("data_batch_id", "batch_id").alias("_held_in"),
    )
    own = landings.groupBy(F.col("source_name").alias("_os"), F.col("_landing").alias("_ob")).agg(
        F.max_by("_held_in", "registered_at").alias("_own")
    )
    asked = asked.join(own, (F.col("source_name") == F.col("_os")) & (F.col("batch_id") == F.col("_ob")), "left")
    found = asof_join(
        asked, landings, ["source_name"], "_as_of", "registered_at", None, {"_held_in": "_found"}, "_landing"
    )
    return found.select(*batches.columns, F.coalesce("_own", "_found").alias("data_batch_id"))


def existing_snapshot(spark: SparkSession, root: str, files: DataFrame, source: str, batch_id: str | None) -> str | None:
    """The batch itself if its folder is there, else the newest one that landed the same content and is; or None."""
    if batch_id is None or path_exists(spark, snapshot_path(root, source, batch_id)):
        return batch_id
    of_source = files.where(F.col("source_name") == source)
    content = of_source.where(F.col("batch_id") == batch_id).select(F.col("fingerprint").alias("_f")).limit(1)
    same = of_source.where(F.col("status").isin(*LANDED_STATES)).join(content, F.col("fingerprint") == F.col("_f"))
    held = same.groupBy(F.coalesce("data_batch_id", "batch_id").alias("b")).agg(F.max("registered_at").alias("at"))
    for row in held.orderBy(F.col("at").desc(), F.col("b").desc()).toLocalIterator():
        if path_exists(spark, snapshot_path(root, source, row["b"])):
            return row["b"]
    return None


# --- Incremental reads ---


def rows_after(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows past a high-water mark; all rows where there is no mark yet."""
    return df if mark is None else df.where(F.col(column) > literal_like(df, column, mark))


def next_mark(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """The mark a read of ``df`` moves to."""
    return df.groupBy(*by).agg(F.max(column).alias("mark"), F.count("*").alias("rows"))


def latest_marks(marks: DataFrame) -> DataFrame:
    """Current mark per table of an append-only (table_name, mark, batch_id, updated_at) log."""
    return marks.groupBy("table_name").agg(
        F.max_by("mark", "updated_at").alias("mark"),
        F.max_by("batch_id", "updated_at").alias("batch_id"),
        F.max("updated_at").alias("updated_at"),
    )
