"""The learnt models against plain dictionaries: Kneser-Ney probabilities, n-gram counts, ratios and scores."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import language_id, toxicity

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the tables are not here")


def letters(text):
    if not text or not any(c.isalpha() for c in text.lower()):
        return ""
    return re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text.lower()))


class PlainKneserNey:
    """One language: counts of the highest order, continuation counts below, discount and recursion by the book."""

    def __init__(self, texts, order, characters):
        self.order, self.characters = order, characters
        self.counts = [Counter() for _ in range(order + 1)]
        for text in texts:
            padded = " " * (order - 1) + text
            self.counts[order].update(padded[i : i + order] for i in range(len(text)))
        for n in range(order - 1, 0, -1):
            self.counts[n].update(g[1:] for g in self.counts[n + 1])
        self.discount, self.total, self.kinds = {}, defaultdict(int), defaultdict(int)
        for n in range(1, order + 1):
            ones, twos = (sum(c == k for c in self.counts[n].values()) for k in (1, 2))
            self.discount[n] = ones / (ones + 2 * twos) if ones else 0.5
            for g, c in self.counts[n].items():
                self.total[n, g[:-1]] += c
                self.kinds[n, g[:-1]] += 1
        self.probability = lru_cache(maxsize=None)(self._probability)

    def left(self, n, head):
        return self.discount[n] * self.kinds[n, head] / self.total[n, head] if self.total.get((n, head)) else 1.0

    def _probability(self, gram):
        n = len(gram)
        lower = self.probability(gram[1:]) if n > 1 else 1 / (self.characters + 1)
        total = self.total.get((n, gram[:-1]), 0)
        own = max(self.counts[n].get(gram, 0) - self.discount[n], 0) / total if total else 0.0
        return own + self.left(n, gram[:-1]) * lower


def test_cross_entropies_equal_plain_kneser_ney(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(5)).alias("part")
    rows = [r for r in docs.select("doc_id", "text", "lang", part).collect()]
    learnt = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text is not None and r.part > 0]
    texts = defaultdict(list)
    for r in learnt:
        if letters(r.text):
            texts[r.lang].append(letters(r.text))
    characters = {c for own in texts.values() for t in own for c in t}
    plain = {lang: PlainKneserNey(own, language_id.ORDER, len(characters)) for lang, own in texts.items()}
    unseen = np.mean([math.log2(p.left(1, "") / (len(characters) + 1)) for p in plain.values()])
    model = language_id.learn_from_documents(docs)
    assert model.languages == sorted(plain)
    table = language_id.letter_table()
    predicted = {r[0]: r[1] for r in language_id.identify(docs, model).select("doc.doc_id", "lang_pred").collect()}
    for r in rows:
        text = letters(r.text)
        codes = language_id.letters_of(r.text or "", table)
        assert codes.tobytes().decode("utf-32-le") == text
        if not text:
            assert predicted[r.doc_id] == "und"
            continue
        padded = " " * (language_id.ORDER - 1) + text
        grams = [padded[i : i + language_id.ORDER] for i in range(len(text))]
        want = []
        for lang in model.languages:
            bits = [math.log2(plain[lang].probability(g)) if g[-1] in characters else None for g in grams]
            want.append(-sum(unseen_bits(plain[lang], g, unseen) if b is None else b for g, b in zip(grams, bits)) / len(text))
        got = model.cross_entropies([codes])[0]
        assert np.allclose(got, want, atol=1e-5), (r.doc_id, got, want)
        if min(abs(a - min(want)) for a in want if a != min(want)) > 1e-4:
            assert predicted[r.doc_id] == model.languages[int(np.argmin(want))]


def unseen_bits(plain, gram, unseen):
    """A character that no language has: what every order leaves over, down to one share for all languages."""
    return unseen + sum(math.log2(plain.left(n, gram[-n:-1])) for n in range(2, len(gram) + 1))


def plain_grams(text):
    whole = f" {' '.join(text.lower().split())} "
    return {whole[i : i + n] for n in toxicity.ORDERS for i in range(len(whole) - n + 1)}


def hash_of(gram):
    codes = np.frombuffer(gram.encode("utf-32-le"), dtype=np.uint32)
    return int(list(toxicity.gram_hashes(codes))[-1][0])


def test_toxicity_features_and_scores_equal_plain_counts(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    learnt = labels.where(language_id.remainder("doc_id", 3) != 1)
    model = toxicity.learn_toxicity(docs, learnt)
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    toxic = {r.doc_id: int(r.toxic > 0) for r in learnt.collect() if r.toxic is not None and r.doc_id in texts}
    n, n1 = len(toxic), sum(toxic.values())
    assert 0 < n1 < n
    stands, stands_toxic = Counter(), Counter()
    for doc_id, label in toxic.items():
        grams = plain_grams(texts[doc_id])
        stands.update(grams)
        if label:
            stands_toxic.update(grams)
    ratio = {g: math.log(((stands_toxic[g] + 1) / (n1 + 2)) / ((c - stands_toxic[g] + 1) / (n - n1 + 2))) for g, c in stands.items() if c >= toxicity.MIN_DOCS}
    telling = {g: abs(r) * math.sqrt(stands[g]) for g, r in ratio.items()}
    least = sorted(telling.values(), reverse=True)[: toxicity.FEATURES][-1]
    chosen = set(model.hashes.tolist())
    assert len(chosen) == min(toxicity.FEATURES, len(telling))
    assert {hash_of(g) for g, t in telling.items() if t > least + 1e-9} <= chosen <= {hash_of(g) for g, t in telling.items() if t > least - 1e-9}
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    for g, t in telling.items():  # a weight is the ratio times what the linear part gives it: none where the ratio says nothing
        if hash_of(g) in weight and abs(ratio[g]) < 1e-12:
            assert weight[hash_of(g)] == 0
    got = toxicity.score_toxicity(docs, model).select("doc.doc_id", "score").toPandas()
    for doc_id, score in zip(got.doc_id, got.score):
        total = model.bias + sum(weight.get(hash_of(g), 0.0) for g in plain_grams(texts[doc_id]))
        assert math.isclose(score, 1 / (1 + math.exp(-max(-60, min(60, total)))), rel_tol=1e-6, abs_tol=1e-12)


def test_linear_part_fits_its_rows():
    """Gradient at the end of the fit: near zero in every direction, so rounds suffice."""
    draw = np.random.default_rng(4)
    rows = [(int(k % 3 == 0), np.unique(draw.integers(0, 20, 6) + (20 if k % 3 == 0 else 10)).astype(np.int32)) for k in range(300)]
    scale = draw.uniform(0.5, 1.5, 40)
    weights, bias = toxicity._fit(rows, scale)
    scores = np.array([weights[f].sum() + bias for _, f in rows])
    y = np.array([t for t, _ in rows])
    assert ((scores > 0) == y).mean() > 0.95


def test_draws_reach_below_a_millionth(spark):
    frame = spark.range(2_000_000).select(language_id.fraction(F.xxhash64(F.lit("language"), "id")).alias("d"))
    found = frame.agg(F.min("d"), F.max("d"), F.count_if(F.col("d") <= 1e-5), F.count_if(F.col("d") <= 1.0)).first()
    assert 0 <= found[0] < 5e-6 and found[1] <= 1 and 2 <= found[2] <= 60 and found[3] == 2_000_000
