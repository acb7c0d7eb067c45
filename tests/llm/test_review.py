"""Cases of a review: what was left out before must be there."""

import random

import numpy as np
import pandas as pd

from strataflow.llm import language_id, lattice_dedup, minhash_dedup, toxicity


def test_ngrams_are_counted_over_all_labelled_rows(spark, monkeypatch):
    draw = random.Random(1)
    words = "alpha beta gamma delta epsilon".split()
    rows = [(i, " ".join(draw.choice(words) for _ in range(8)) + (" qzx" if i % 25 == 0 else ""), int(i % 5 == 0)) for i in range(100)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, toxic) for i, _, toxic in rows], "doc_id int, toxic int")
    model = toxicity.learn_toxicity(docs, labels, most=8)
    rare = next(toxicity.gram_hashes(toxicity.codes_of("qzx")))[1]  # in four texts, too few for a sample of eight
    assert rare in model.hashes
    few, many = (toxicity.training_rows(docs, labels, n).orderBy("draw", "text").collect() for n in (1000, 10))
    assert few == many and len(few) == 100  # labels broadcast or joined
    assert len(toxicity.learn_toxicity(docs, labels, most=1).hashes) in (0, len(model.hashes))


def test_no_language_is_left_out(spark):
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    prose = lambda seed: " ".join("".join(random.Random(seed * 100 + k).choices(alphabet, k=6)) for k in range(40))
    rows = [(k, prose(k), "many") for k in range(30)] + [(100 + k, prose(100 + k), f"rare{k:02d}") for k in range(20)]
    frame = spark.createDataFrame([*rows, (200, "123", "blank")], "key long, text string, lang string")
    languages = ["many", *[f"rare{k:02d}" for k in range(20)]]
    model = language_id.learn_languages(frame)
    assert model.languages == languages and np.isfinite(model.centre).all()  # a row each, one in five of them drawn for calibration
    assert language_id.learn_languages(frame, train_chars=40).languages == languages  # hardly any row is drawn


def test_vectors_of_two_dimensions_in_one_cell(spark):
    shape = lattice_dedup.Lattice(tables=1, probes=0)
    units = [np.eye(4)[0], np.eye(3)[0], np.eye(4)[0]]
    cell = pd.DataFrame({"key": [5] * 3, "lo": [0] * 3, "hi": [0] * 3, "node": [1, 2, 3], "weight": [1] * 3, "block": [0] * 3, "unit": units, "keys": [np.array([5])] * 3})
    found = pd.concat(lattice_dedup._comparer(shape, 0.95)(iter([cell])))
    assert found.to_numpy().tolist() == [[1, 1, 1], [3, 1, 1]]
    flat = lattice_dedup.Lattice(scale=0.0)  # all vectors lie at the point zero
    own = [lattice_dedup.cell_keys(np.eye(d)[:1], flat)[0, :, 0] for d in (3, 4)]
    assert (own[0] != own[1]).all()


def test_pairs_at_the_threshold_meet():
    draw = np.random.default_rng(11)
    x, y = draw.normal(size=(2, 4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a, b = (lattice_dedup.cell_keys(v, lattice_dedup.Lattice()) for v in (x, 0.95 * x + np.sqrt(1 - 0.95**2) * y))
    met = (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3))
    assert (~met).sum() <= 1  # about 14 with ten tables


def test_one_of_each_group_stays_whatever_its_ids(spark):
    words = lambda seed: " ".join("".join(random.Random(seed * 1000 + k).choices("abcdefgh", k=5)) for k in range(200))
    rows = [(None, words(1) + f" more{k}") for k in range(3)] + [(5, words(2) + f" more{k}") for k in range(3)]
    rows += [(7, words(3)), (None, words(3) + " x"), (8, words(3) + " y"), (None, words(4)), (None, words(4)), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = minhash_dedup.drop_near_duplicates(docs).collect()
    groups = [sum((r.text or "").startswith(words(k)) for r in left) for k in (1, 2, 3, 4)]
    assert groups == [1, 1, 1, 1] and len(left) == 6
    assert [r.doc_id for r in left if (r.text or "").startswith(words(3))] == [7]
