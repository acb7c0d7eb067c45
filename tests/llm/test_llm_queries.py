"""Every registered query of the subpackage against its SQL, or against brute force where SQL cannot say it."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import sentencepiece

import check_queries
import corpus_pipeline
from strataflow.llm import queries

SF_DIR = "/root/testdata/sf0.001"
MODEL = os.path.join(queries.TOKENIZERS, "piece_bpe_32k.model")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in check_queries.TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet")


def test_operators_and_their_sql():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert queries.SQL.keys() <= queries.QUERIES.keys()


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    got = check_queries.rows_of(df.columns, df.collect())
    cursor = con.execute(queries.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == check_queries.rows_of(names, cursor.fetchall())


def remainder(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


def test_language_id(spark, documents):
    got = queries.QUERIES["op5_language_id"](spark, SF_DIR).toPandas().merge(documents, on="doc_id")
    assert len(got) == len(documents)
    assert (got.held_out == [remainder(i, 4) == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all()
    assert set(got.lang_pred) <= set(documents.lang.dropna())
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95


def test_toxicity(spark, documents):
    got = queries.QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    assert (got.held_out == [remainder(i, 3) == 1 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    held = got[got.held_out].merge(pd.read_parquet("/root/testdata/sf0.1/labels.parquet"), on="doc_id")
    hit = held[held.predicted == 1]
    assert hit.toxic.mean() > 0.95
    assert hit.toxic.sum() > 0.75 * held.toxic.sum()  # some labels are noise


def test_piece_codec_is_the_library(spark, documents):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = queries.QUERIES["op9_piece_codec"](spark, SF_DIR).toPandas().set_index("doc_id")
    for doc_id, text in zip(documents.doc_id, documents.text):
        ids = lib.encode(text or "", add_bos=True, add_eos=True)
        row = got.loc[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_lattice_lm_base(spark, documents):
    lower = {c: c + 32 for c in range(65, 91)}
    words = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(lower)) for t in documents.text]
    held = [remainder(i, 10) == 0 for i in documents.doc_id]
    counts = Counter(w for ws, h in zip(words, held) if not h for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    got = queries.QUERIES["op10_lattice_lm"](spark, SF_DIR).toPandas().set_index("doc_id")
    assert len(got) == len(documents)
    for doc_id, ws, h in zip(documents.doc_id, words, held):
        row = got.loc[doc_id]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (h, len(ws) + 1, n)
        assert row.n_known == sum(counts[w] > 0 for w in [*ws, None])
        assert math.isclose(row.base_score, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*ws, None]), rel_tol=1e-9)
        assert row.score < 0 and math.isfinite(row.score)


def test_pipeline_stage_by_stage(spark, documents, con):
    """Each stage against a plain computation on what it was given."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    (_, quality), (_, languages), (_, dedup), (_, mix), (_, encode) = corpus_pipeline.STAGES
    first = quality(spark, docs, SF_DIR).cache()
    assert first.columns == docs.columns
    verdict = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.SQL['op1_quality_rules']}) WHERE kept").fetchall()}
    assert {r.doc_id for r in first.collect()} == verdict < kept
    second = languages(spark, first, SF_DIR).cache()
    assert second.columns == docs.columns
    assert second.count() > 0.95 * first.count()
    third = dedup(spark, second, SF_DIR).cache()
    assert third.columns == docs.columns
    assert {r.doc_id for r in third.collect()} == brute_force_kept(second.toPandas(), 5)
    fourth = mix(spark, third, SF_DIR).cache()
    assert fourth.columns == docs.columns
    sizes = {r.doc_id: len(re.findall("[^\x20\x09-\x0d]+", r.text or "")) for r in third.collect()}
    copies = Counter(r.doc_id for r in fourth.collect())
    assert max(copies.values()) <= 2
    taken = sum(sizes[d] * n for d, n in copies.items())
    assert 1.5 * sum(sizes.values()) - max(sizes.values()) <= taken <= 1.5 * sum(sizes.values())
    last = encode(spark, fourth, SF_DIR).toPandas()
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = dict(zip(documents.doc_id, documents.text))
    assert Counter(last.doc_id) == copies
    for row in last.drop_duplicates("doc_id").itertuples():
        assert row.n_tokens == len(lib.encode(text[row.doc_id], add_bos=True, add_eos=True))


def brute_force_kept(docs: pd.DataFrame, width: int) -> set:
    lower = {c: c + 32 for c in range(65, 91)}
    sets = {}
    for doc_id, text in zip(docs.doc_id, docs.text):
        ws = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(lower))
        sets[doc_id] = {tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)} or ({tuple(ws)} if ws else set())
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {d for d in ids if root(d) == d}
