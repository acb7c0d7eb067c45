"""Vendor manifests: what a delivery says about its own files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.sources.snapshots import path_exists

MANIFEST_NAME = "_manifest.json"
SUPPORTED_VERSIONS = (1,)

_FILE = T.StructType(
    [T.StructField("size_bytes", T.LongType()), T.StructField("checksum_md5", T.StringType())]
)
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("manifest_version", T.LongType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("dataset_version", T.StringType()),
        T.StructField("vendor_last_updated", T.StringType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("files", T.MapType(T.StringType(), _FILE)),
    ]
)


class ManifestError(ValueError):
    """The manifest exists but cannot be used."""


def parse_manifests(texts: DataFrame, column: str = "value") -> DataFrame:
    """Parse manifest texts, one per row; ``problem`` says what is wrong with each, or is NULL."""
    text = F.col(column)
    parsed = F.from_json(text, MANIFEST_SCHEMA, {"mode": "PERMISSIVE"})
    keys = F.json_object_keys(text)
    known = F.array(*[F.lit(name) for name in MANIFEST_SCHEMA.names])
    missing = F.array_except(known, keys)
    unknown = F.array_except(keys, known)
    out = texts.withColumn("_m", parsed)
    entries = F.map_values(F.col("_m.files"))
    broken_entry = F.exists(entries, lambda e: e.isNull() | e["size_bytes"].isNull() | e["checksum_md5"].isNull())
    not_typed = F.exists(
        F.array(*[F.col(f"_m.{name}").isNull() for name in MANIFEST_SCHEMA.names]), lambda x: x
    )
    problem = (
        F.when(keys.isNull(), "not a JSON object")
        .when(F.array_contains(missing, "manifest_version") | F.col("_m.manifest_version").isNull(), "unsupported version")
        .when(~F.col("_m.manifest_version").isin(*SUPPORTED_VERSIONS), "unsupported version")
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown fields: "), F.array_join(unknown, ", ")))
        .when(F.size(missing) > 0, F.concat(F.lit("missing fields: "), F.array_join(missing, ", ")))
        .when(not_typed | broken_entry, "a field has the wrong type")
    )
    return out.select(*texts.columns, "_m.*", problem.alias("problem"))


def load_manifest(spark: SparkSession, directory: str) -> DataFrame | None:
    """The one-row manifest of a delivery, None if it has none; a broken one raises.

    Spark's readers pass over names that start with an underscore, so this small file is opened through
    the file system of its path.
    """
    path = f"{directory.rstrip('/')}/{MANIFEST_NAME}"
    if not path_exists(spark, path):
        return None
    jvm = spark.sparkContext._jvm
    jvm_path = jvm.org.apache.hadoop.fs.Path(path)
    stream = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(jvm_path)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    parsed = parse_manifests(spark.createDataFrame([(text,)], "value string")).drop("value")
    problem = parsed.first()["problem"]
    if problem is not None:
        raise ManifestError(f"{path}: {problem}")
    return parsed.drop("problem")


def manifest_files(manifest: DataFrame) -> DataFrame:
    """One row per file the manifest lists."""
    return manifest.select("dataset", "dataset_version", F.explode("files").alias("file_name", "_f")).select(
        "dataset", "dataset_version", "file_name", "_f.size_bytes", "_f.checksum_md5"
    )


def checksum_mismatches(listed: DataFrame, computed: DataFrame) -> DataFrame:
    """Files whose computed md5 is not the listed one; the computed value is the one that counts."""
    found = computed.select(F.col("file_name").alias("_name"), F.col("checksum_md5").alias("computed_md5"))
    return (
        listed.join(found, F.col("file_name") == F.col("_name"), "inner")
        .where(F.col("checksum_md5") != F.col("computed_md5"))
        .select("file_name", F.col("checksum_md5").alias("listed_md5"), "computed_md5")
    )
