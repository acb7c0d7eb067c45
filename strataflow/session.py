"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in the library counts on.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

def build_session(app_name: str = "strataflow", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; cluster settings come from the environment."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        **RUNTIME_SETTINGS,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session built elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A folder on this machine stands in only when Spark itself runs on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return os.path.dirname(in_use.rstrip("/"))
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strataflow-"))
    return os.path.dirname(spark.sparkContext.getCheckpointDir().rstrip("/"))


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/strataflow-{spark.sparkContext.applicationId}"


# Folders of the jobs that run now, the innermost last; threads of a job share its folder.
_JOBS: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's part of the shared folder, and below the running job's in it."""
    return "/".join([_scratch_root(spark), *_JOBS[-1:], f"{name}-{uuid.uuid4().hex}"])


def drop_scratch(spark: SparkSession, job: str = "") -> None:
    """Delete what the application, or one job of it, wrote for itself; tables read from it cannot be used any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_scratch_root(spark)}/{job}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def job(run: Callable) -> Callable:
    """A job whose first argument is the session and whose result needs none of its intermediate tables.

    They are deleted when it ends, however it ends.
    """

    @functools.wraps(run)
    def whole(spark: SparkSession, *args, **kwargs):
        name = f"job-{uuid.uuid4().hex}"
        _JOBS.append(name)
        try:
            return run(spark, *args, **kwargs)
        finally:
            _JOBS.remove(name)
            drop_scratch(spark, name)

    return whole


def together(spark: SparkSession, tasks: dict[str, Callable[[], object]]) -> tuple[dict[str, object], dict[str, Exception]]:
    """Submit independent jobs at once and let Spark share the cluster among them; results and errors by name."""
    if not tasks:
        return {}, {}
    done, failed = {}, {}
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        waiting = {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in tasks.items()}
        for name, future in waiting.items():
            try:
                done[name] = future.result()
            except Exception as error:  # noqa: BLE001 - the caller decides which failures matter
                failed[name] = error
    return done, failed


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    Later passes read the same rows, only the columns they need, and know the table's real size, so Spark
    itself decides what is small enough to broadcast. A lost executor costs a re-read, never other rows.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
