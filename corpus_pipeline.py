"""A corpus from raw documents in five stages; each reads what the one before it wrote.

    spark-submit corpus_pipeline.py    # reads $BENCH_SF_DIR, default /root/testdata/sf0.1
"""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm import language_id, minhash_dedup, piece_codec, quality_rules, source_mix
from strataflow.llm.common import small_batches
from strataflow.llm.queries import TOKENIZERS
from strataflow.session import drop_scratch, job, scratch_path, tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no base rule and whose source is not rejected; null, empty and blank texts break one.

    Texts of any length are measured whole; equal rows stand or fall together; documents without a source form one.
    """
    return quality_rules.keep_quality(docs)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents close enough to a language of the documents themselves; null texts and those without a letter go.

    Nothing is rejected for its length; where no row has a language, nothing can be learnt and all rows go.
    """
    small_batches(spark)
    return language_id.keep_known_languages(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group alike in at least 80 % of their shingles of five words.

    Of equal ids or null ids one row stays as well; texts without words are alike nothing but their equal rows.
    """
    small_batches(spark)
    return minhash_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it: not at all, once or twice.

    Null sources are one source; texts without words use no budget and stay.
    """
    return source_mix.apply_mix(docs)


#: A batch to encode is held as text, ids, decoded text and Arrow's copies of them, some 25 KB a document.
ENCODE_ROWS = 100


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, null texts as empty ones, texts of any length whole."""
    small_batches(spark, ENCODE_ROWS)
    model = Path(TOKENIZERS, "piece_bpe_32k.model").read_bytes()
    # A smaller memo than by itself: earlier stages have left executors with full heaps.
    return piece_codec.encode_and_decode(docs, model, memo_words=200_000).select(
        "doc.doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("language ID", languages),
    ("MinHash near-dedup", deduplicate),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL expresses neither the language models nor the encoding; tests hold the stages against brute force.
ORACLE_SQL = None


@job
def _store(spark: SparkSession, stage, docs: DataFrame, sf_dir: str, path: str) -> T.StructType:
    """Write what a stage gives; what it wrote for itself goes when it is done."""
    done = stage(spark, docs, sf_dir)
    done.write.parquet(path)
    return done.schema


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again.

    Of intermediate tables only the last stage's input stays. An empty table gives an empty result.
    """
    docs = tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    *inner, (_, last) = STAGES
    before = None
    for _, stage in inner:
        path = scratch_path(spark, "pipeline")
        schema = _store(spark, stage, docs, sf_dir, path)
        docs = spark.read.schema(schema).parquet(path)
        if before:
            drop_scratch(spark, before.rsplit("/", 1)[-1])
        before = path
    return last(spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}


if __name__ == "__main__":
    from strataflow.session import build_session

    session = build_session("corpus_pipeline")
    run(session, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")).agg(F.count(F.lit(1)), F.sum("n_tokens")).show()
