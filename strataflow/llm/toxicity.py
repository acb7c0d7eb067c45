"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import fraction, packed, text_or_empty, with_bitmap
from strataflow.session import cut_lineage

#: Labelled rows that the linear part is fitted on, at most about as many; n-grams are counted over all labelled rows.
TRAIN_ROWS = 20_000
#: Features present in all fitted rows together, which are what the driver holds; where texts are long, fewer rows are drawn.
TRAIN_PRESENT = 10_000_000
BROADCAST_LABELS = 500_000  # counted labels up to which they are broadcast
ORDERS = (3, 4, 5, 6)
FEATURES = 8_192
SMOOTHING = 1.0
MIN_DOCS = 3  # an n-gram must stand in so many training rows
CHUNK_CHARS = 400_000
FILTER_BITS = 20
THRESHOLD = 0.7
_MIX = np.uint64(0x9E3779B97F4A7C15)


def codes_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text between blanks, every run of white space as one blank."""
    return np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_hashes(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the hashes of the n-grams that begin at each place of the codes."""
    one = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    key = one
    for n in range(2, max(ORDERS) + 1):
        if len(key) < 2:
            return
        key = ((key[:-1] ^ (key[:-1] >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)) ^ (one[n - 1 :] + np.uint64(n))
        if n in ORDERS:
            yield key ^ (key >> np.uint64(32))


def chunks_of(texts: Sequence[str]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Places and codes of so many characters at a time; a longer text goes alone."""
    at, chunk, size = [], [], 0
    for i, text in enumerate(texts):
        codes = codes_of(text)
        if chunk and size + len(codes) > CHUNK_CHARS:
            yield at, chunk
            at, chunk, size = [], [], 0
        at.append(i)
        chunk.append(codes)
        size += len(codes)
    if chunk:
        yield at, chunk


@dataclass
class ToxicityModel:
    """Sorted hashes of the chosen n-grams and the weight of each; ``filter`` has a bit for each hash's low bits."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    filter: np.ndarray

    def present(self, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of (text, feature), each once, for every chosen n-gram that stands in a text."""
        whole = np.concatenate(codes)
        owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        found = []
        for n, keys in zip(ORDERS, gram_hashes(whole)):
            maybe = np.flatnonzero(self.filter[(keys & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
            maybe = maybe[owner[maybe] == owner[maybe + n - 1]]  # not across two texts
            place = np.minimum(np.searchsorted(self.hashes, keys[maybe]), len(self.hashes) - 1)
            hit = self.hashes[place] == keys[maybe]
            found.append(owner[maybe[hit]].astype(np.int64) * len(self.hashes) + place[hit])
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.int64)
        return pairs // len(self.hashes), pairs % len(self.hashes)

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        if len(self.hashes):
            for at, codes in chunks_of(texts):
                text, feature = self.present(codes)
                np.add.at(out, np.asarray(at)[text], self.weights[feature])
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def with_filter(hashes: np.ndarray, weights: np.ndarray, bias: float) -> ToxicityModel:
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
    return ToxicityModel(hashes, weights, bias, bits)


def training_rows(docs: DataFrame, labels: DataFrame, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """``text, toxic`` of all labelled documents, and a ``draw`` from 0 to 1 by a hash of their id.

    Ids and labels are broadcast while they are few, so that texts are not shuffled. Beyond that only the texts that
    a label names are, once.
    """
    texts = docs.select(F.col("doc_id").alias("_doc"), text_or_empty("text").alias("text"))
    id_type = docs.schema["doc_id"].dataType
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .select(F.col("doc_id").cast(id_type).alias("_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
        .distinct()
    )
    few = known.count() <= broadcast_labels
    if few:
        joined = texts.join(F.broadcast(known), F.col("_doc") == F.col("_id"))
    else:
        joined = with_bitmap(texts, "_doc", known.select("_id"), "_maybe").where("_maybe").join(known, F.col("_doc") == F.col("_id"))
    rows = joined.select("text", "toxic", fraction(F.xxhash64(F.lit("toxic"), "_id")).alias("draw"))
    return rows if few else cut_lineage(rows)


def _gram_counter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many texts of each label an n-gram stands."""
    for batch in batches:
        label = batch["toxic"].to_numpy()
        for at, codes in chunks_of(batch["text"].tolist()):
            owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
            toxic = label[np.asarray(at)]
            for n, keys in zip(ORDERS, gram_hashes(np.concatenate(codes))):
                inside = np.flatnonzero(owner[: len(keys)] == owner[n - 1 :])
                both = np.empty(len(inside), dtype=[("k", np.uint64), ("t", np.int64)])
                both["k"], both["t"] = keys[inside], owner[inside]
                order = np.lexsort((both["t"], both["k"]))
                both = both[order]
                both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
                kinds, start = np.unique(both["k"], return_index=True)
                ones = np.add.reduceat(toxic[both["t"]], start) if len(kinds) else np.empty(0, dtype=np.int64)
                yield pd.DataFrame({"gram": kinds.view(np.int64), "n1": ones.astype(np.int64), "n": np.diff(np.r_[start, len(both)]).astype(np.int64)})


def _fit(rows: Sequence[tuple[int, np.ndarray]], scale: np.ndarray, rounds: int = 300, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on features that are 1 times their ratio where present: accelerated gradient descent."""
    y = np.array([toxic for toxic, _ in rows], dtype=np.float64)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(f) for _, f in rows])
    col = np.concatenate([f for _, f in rows]) if len(row) else np.empty(0, dtype=np.int32)
    value = scale[col]
    weight, bias, n = np.zeros(len(scale)), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), len(y)
    norms = np.bincount(row, value * value, minlength=n) + 1
    step = 4 / np.quantile(norms, 0.9)
    ahead_w, ahead_b, moment = weight.copy(), bias, 1.0
    for _ in range(rounds):
        z = np.bincount(row, value * ahead_w[col], minlength=n) + ahead_b
        off = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / n
        new_w = ahead_w - step * n * 0.25 * (np.bincount(col, value * off[row], minlength=len(scale)) + ridge * ahead_w / 10)
        new_b = ahead_b - step * n * 0.25 * off.sum() / 10
        next_moment = (1 + np.sqrt(1 + 4 * moment * moment)) / 2
        push = (moment - 1) / next_moment
        ahead_w, ahead_b = new_w + push * (new_w - weight), new_b + push * (new_b - bias)
        weight, bias, moment = new_w, new_b, next_moment
    return weight * scale, bias


def learn_toxicity(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> ToxicityModel:
    """A model of the labelled documents ``doc_id, text`` and ``doc_id, toxic``; others are not looked at.

    Spark counts n-grams by label over all labelled rows and computes their log-count ratios; those that tell
    most come to the driver, a fixed number, and the linear part is fitted on which of them stand in each of a
    sample of ``most`` rows, picked by a hash of the id; fewer where their texts are so long that more than
    ``TRAIN_PRESENT`` features would stand in them. A document that is labelled twice counts once with each label; equal
    rows of labels count once, equal rows of documents each. Without both labels the model has no features and scores every text alike.
    """
    labelled = training_rows(docs, labels)
    total = labelled.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    n, n1 = total[0], total[1] or 0
    if not n1 or n1 == n:
        return with_filter(np.empty(0, dtype=np.uint64), np.empty(0), float(np.log((n1 + 0.5) / (n - n1 + 0.5))))
    grams = labelled.select("text", "toxic").mapInPandas(_gram_counter, "gram long, n1 long, n long").groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n").alias("n"))
    ratio = F.log(((F.col("n1") + SMOOTHING) / (n1 + 2 * SMOOTHING)) / ((F.col("n") - F.col("n1") + SMOOTHING) / (n - n1 + 2 * SMOOTHING)))
    telling = F.abs(F.col("ratio")) * F.sqrt(F.col("n"))
    chosen = grams.where(F.col("n") >= MIN_DOCS).withColumn("ratio", ratio).orderBy(telling.desc(), "gram").limit(FEATURES).collect()
    hashes = np.array([r["gram"] for r in chosen], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    scale = np.array([r["ratio"] for r in chosen])[order]
    plain = vars(with_filter(hashes[order], scale, 0.0))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = ToxicityModel(**plain)
        for batch in batches:
            label, draw = batch["toxic"].to_numpy(), batch["draw"].to_numpy()
            for at, codes in chunks_of(batch["text"].tolist()):
                text, feature = model.present(codes)
                cuts = np.searchsorted(text, np.arange(1, len(codes)))
                parts = np.split(feature.astype(np.int32), cuts)
                yield pd.DataFrame({"toxic": label[np.asarray(at)], "draw": draw[np.asarray(at)], "features": [part.tobytes() for part in parts]})

    share = most / n
    sample = labelled.where(F.col("draw") <= share).select("text", "toxic", "draw")
    found = cut_lineage(sample.mapInPandas(features, "toxic int, draw double, features binary"))
    present = found.agg(F.sum(F.octet_length("features"))).first()[0] or 0
    share *= min(1.0, 4 * TRAIN_PRESENT / max(present, 1))
    drawn = found.where(F.col("draw") <= share).select("toxic", "features").collect()
    rows = [(r["toxic"], np.frombuffer(r["features"], dtype=np.int32)) for r in drawn]
    if not rows:
        return with_filter(np.empty(0, dtype=np.uint64), np.empty(0), float(np.log((n1 + 0.5) / (n - n1 + 0.5))))
    weights, bias = _fit(rows, scale)
    return with_filter(hashes[order], weights, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, carry: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``doc`` (carried columns), ``score`` (0 to 1) and ``predicted`` (1 from the threshold on) of every whole text.

    A null text is scored as an empty one. Only texts go to Python, a bounded number of characters at a time
    unless a single text is longer; the model is of fixed size. An empty table gives an empty result. Input
    columns travel inside ``doc``.
    """
    plain = vars(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = ToxicityModel(**plain)
        for batch in batches:
            yield pd.Series(own.scores(batch.tolist()))

    rows = docs.select(packed(carry).alias("doc"), score(text_or_empty(text)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
