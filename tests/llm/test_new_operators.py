"""Permutation index, target resampling and prefix trie: against brute force, on edge rows, and in their hot shapes."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strataflow.llm import permutation_index, prefix_trie, target_resampling
from strataflow.llm.permutation_index import PermutationIndex

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


# --- target resampling ---


def brute_resample(docs, target, percent=10, width=1, buckets=10_000):
    def features(text):
        words = WORD.findall((text or "").translate(LOWER))
        return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, width + 1) for i in range(len(words) - n + 1)]

    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, text in docs:
        np.add.at(s, features(text)[1], 1)
    for text in target:
        np.add.at(t, features(text)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        words, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(words), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return [(*r, drawn.get(id(r))) for r in rows]


@pytest.mark.parametrize("width", [1, 3])
def test_resample_equals_brute_force(spark, width):
    draw = random.Random(width)
    words = ["Alpha", "beta", "Zürich", "x1", "the", "Ünder", "long" * 700, "q"]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(0, 60)))) for i in range(80)]
    docs += [(3, docs[3][1]), (3, docs[3][1]), (None, docs[5][1]), (None, None), (900, ""), (901, " .,\n"), (902, "a b İ K"), (903, "x" * 300_000)]
    target = ["the beta alpha", "Zürich, the q", None, ""]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score long, doc string").repartition(3)
    got = target_resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), percent=40, max_words=width)
    rows = [tuple(r) for r in got.select("doc.doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
    assert sorted(rows, key=str) == sorted(brute_resample(docs, target, 40, width), key=str)


def test_resample_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert target_resampling.resample(none, none).count() == 0
    one = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert target_resampling.resample(one, none, percent=100).first()["rank"] == 1


def test_crc_matrices():
    draw = np.random.default_rng(3)
    for width in (1, 7, 8, 9, 40):
        matrix = draw.integers(0, 3, size=(500, width), dtype=np.uint8)
        first, code = target_resampling.distinct_rows(matrix)
        assert (matrix[first][code] == matrix).all() and len(first) == len(np.unique(matrix, axis=0))
        assert target_resampling.crc_rows(matrix).tolist() == [zlib.crc32(r.tobytes()) for r in matrix]


def test_ranges_of_long_tables(spark, monkeypatch):
    """More rows than one task numbers: the range sort gives the same ranks."""
    docs = [(i, f"the word {i % 7} " * 10) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([("word 3",)], "text string")
    one = {tuple(r) for r in target_resampling.resample(frame, target).select("doc.doc_id", "rank").collect()}
    whole = target_resampling.dense_number
    monkeypatch.setattr(target_resampling, "dense_number", lambda *a, **k: whole(*a, **k, one_task_rows=10))
    assert {tuple(r) for r in target_resampling.resample(frame, target).select("doc.doc_id", "rank").collect()} == one


# --- permutation index ---


def brute_nearest(rows, k):
    found = {}
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for a, (query, q) in enumerate(usable):
        if query is None or query % 20:
            continue
        scores = []
        for b, (other, x) in enumerate(usable):
            if a != b and len(x) == len(q):
                total = 0.0
                for y, z in zip(q, x):
                    total += y * z
                scores.append((-total, other is None, other or 0))
        found.setdefault(query, []).append([(r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])])
    return found


def answers(df):
    found = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    return found


def test_small_tables_are_exact(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(60)]
    rows += [(100, rows[7][1]), (101, rows[7][1]), (102, rows[7][1])]  # equal vectors, one of them a query
    rows += [(120, [0.0] * 6), (140, None), (160, []), (180, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (200, [float("nan")] * 6), (220, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0])]
    rows += [(None, rows[1][1]), (None, rows[2][1]), (240, [1.0, 2.0]), (241, [3.0, 1.0]), (260, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = answers(permutation_index.nearest_vectors(frame, F.col("vec_id") % 20 == 0, k=5))
    want = {q: a[0] for q, a in brute_nearest(rows, 5).items() if a[0]}
    assert got == want and 260 not in got and 120 not in got and len(got[240]) == 1
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert permutation_index.nearest_vectors(none, F.col("vec_id") % 20 == 0).count() == 0
    assert permutation_index.nearest_vectors(frame, F.lit(False)).count() == 0


def test_rows_of_one_id_are_queries_of_their_own(spark):
    frame = spark.createDataFrame([(20, [1.0, 0.0]), (20, [0.0, 1.0]), (21, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = permutation_index.nearest_vectors(frame, F.col("vec_id") == 20, k=3).collect()
    assert sorted((r.vec_id, r.score) for r in got) == [(20, 0.0), (20, 0.0), (21, 1.0), (21, 1.0)]


@pytest.mark.parametrize("dims,lengths", [(16, False), (64, True), (256, False)])
def test_recall_through_pivot_files(spark, dims, lengths):
    draw = np.random.default_rng(dims)
    vectors = draw.normal(size=(3000, dims)) + 0.7 * draw.normal(size=(10, dims))[draw.integers(0, 10, 3000)]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if lengths:  # inner products of vectors of different norms
        vectors *= draw.uniform(0.5, 2, size=(3000, 1))
    vectors[1000:2000] = vectors[1000]  # a third of all rows are copies
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": range(3000), "embedding": vectors.tolist()}))
    shape = PermutationIndex(block_rows=700)
    got = permutation_index.nearest_vectors(frame, F.col("vec_id") % 20 == 0, k=20, shape=shape).toPandas()
    assert (got.groupby("query_id").size() == 20).all() and got.query_id.nunique() == 150
    hits = 0
    for query, rows in got.groupby("query_id"):
        score = vectors @ vectors[query]
        score[query] = -np.inf
        hits += (rows.score.to_numpy() >= np.sort(score)[-20] - 1e-12).sum()
        assert np.allclose(rows.score, score[rows.vec_id]) and query not in set(rows.vec_id)
    assert hits / len(got) > 0.9


def test_footrule():
    draw = np.random.default_rng(1)
    shape = PermutationIndex(pivots=40, prefix=10)
    perms = np.array([draw.permutation(40)[:10] for _ in range(50)], dtype=np.uint8)
    place = np.full((50, 40), 10)
    for position in range(10):
        place[np.arange(50), perms[:, position]] = position
    far = np.abs(place - place[0]).sum(1)
    near = permutation_index.footrule(permutation_index.pivot_files(perms, shape), perms[0]).astype(int)
    assert (2 * (near - near[0]) == far).all()


# --- prefix trie ---


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:])  # remainders have the sign of the id
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
    out = []
    for node, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if built[c] == node)
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def chats(seed, n, long=0):
    draw = random.Random(seed)
    texts = ["hello there", "a b c", "", None, "yes", "no no no", "ünï cöde"]
    rows = []
    for c in range(n):
        first = draw.choice(["system prompt of many words", "system prompt of many words", "other"])
        rows += [(c, None, None, first)]
        rows += [(c, t, draw.choice(["user", "assistant", None]), draw.choice(texts[: 2 + c % 5])) for t in range(draw.randint(0, 4))]
        if c % 3 == 0:  # copies of one conversation
            rows += [(c, 10 + t, "user", f"copy {t % 3}") for t in range(6)]
    rows += [(10_000, t, "user", f"word {t}") for t in range(long)] + [(10_020, t, "user", f"word {t}") for t in range(long)]
    return rows


@pytest.mark.parametrize("shape", [prefix_trie.Shards(), prefix_trie.Shards(members=3, queue_rows=2, hot_limit=20)])
def test_trie_equals_brute_force(spark, shape):
    rows = chats(1, 120, 60) + [(None, 1, "user", "nobody's"), (-5, 1, "user", "minus"), (20_001, 1, "user", "x" * 200_000), (20_002, 0, "user", "gone")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth long, id1 string").repartition(3)
    got = [tuple(r) for r in prefix_trie.prefix_trie(frame, shape).select(NODE).collect()]
    assert sorted(got, key=str) == sorted(brute_trie(rows), key=str)


def test_trie_of_little(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    for rows in ([(1, 0, "user", "a b")], [(20, 0, "user", "a"), (20, 0, "user", "a")], [(c, 0, "u", "t") for c in range(40)]):
        got = [tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, schema)).select(NODE).collect()]
        assert sorted(got, key=str) == sorted(brute_trie(rows), key=str)


def test_queue_spills_and_keeps_order():
    queue, draw = prefix_trie.SpillingQueue(50), random.Random(2)
    items = [(draw.randint(0, 30), draw.randint(0, 5), k) for k in range(2000)]
    for item in items:
        queue.push(item)
    assert len(queue.runs) > 30 and len(queue.heap) <= 50
    for key in sorted({i[:2] for i in items}):
        assert sorted(queue.take(key)) == sorted(i for i in items if i[:2] == key)
