"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import fraction, packed, unpacked
from strataflow.session import cut_lineage

UNKNOWN = "und"
#: Characters of training text over all languages, dealt out evenly; the only bound on what is learnt from.
TRAIN_CHARS = 4_000_000
ORDER = 4
CHUNK_CHARS = 400_000  # characters looked up at once
SPACE = 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def letter_table() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def letters_of(text: str, table: np.ndarray) -> np.ndarray:
    """Code points of the lower-cased text; every run of anything but letters is one space. Empty without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = table[codes]
    if not letter.any():
        return np.empty(0, dtype=np.uint32)
    first = np.empty(len(codes), dtype=bool)
    first[0], first[1:] = True, letter[:-1]
    return np.where(letter, codes, SPACE).astype(np.uint32)[letter | first]


def _one(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint64) + np.uint64(1)) * _MIX


def _rolled(before: np.ndarray, one: np.ndarray) -> np.ndarray:
    return ((before ^ (before >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) ^ one * np.uint64(3)


def gram_keys(codes: np.ndarray, starts: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray | None]]:
    """For orders 1..order, hashes of the n-grams that end at each place, and of what stands before that place.

    ``starts`` are the places where texts begin; spaces stand before each text.
    """
    one, pad = _one(codes), _one(np.array([SPACE]))
    keys, contexts, space = [one], [None], pad
    for _ in range(order - 1):
        before = np.empty_like(one)
        before[1:] = keys[-1][:-1]
        before[starts] = pad
        contexts.append(before)
        keys.append(_rolled(before, one))
        pad = _rolled(pad, space)
    return keys, contexts


def gram_hashes(grams: Sequence[str]) -> np.ndarray:
    """Hashes of single n-grams, as ``gram_keys`` makes them at an n-gram's end."""
    n = len(grams[0])
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(grams), n)
    key = _one(codes[:, 0])
    for i in range(1, n):
        key = _rolled(key, _one(codes[:, i]))
    return key


@dataclass
class LanguageModel:
    """Per order: sorted hashes of n-grams and their log2 probability in each language; for contexts, what is left over."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    unseen: float = -20.0  # log2 probability of a character that no language has
    centre: np.ndarray | None = None  # calibrated cross-entropy of each language
    spread: np.ndarray | None = None
    slack: float = 1.0

    def log2(self, keys: list[np.ndarray], contexts: list[np.ndarray | None], order: int, at: np.ndarray) -> np.ndarray:
        """log2 probabilities of the characters at the places ``at``, a row each and a column per language."""
        table, values = self.grams[order - 1]
        wanted = keys[order - 1][at]
        place = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
        hit = table[place] == wanted
        out = values[place]
        missed = np.flatnonzero(~hit)
        if len(missed) and order == 1:
            out[missed] = self.unseen
        elif len(missed):
            lower = self.log2(keys, contexts, order - 1, at[missed])
            known, left = self.contexts[order - 2]
            before = contexts[order - 1][at[missed]]
            where = np.minimum(np.searchsorted(known, before), len(known) - 1)
            seen = known[where] == before
            lower[seen] += left[where[seen]]
            out[missed] = lower
        return out

    def cross_entropies(self, texts: Sequence[np.ndarray]) -> np.ndarray:
        """Bits per character of each text under each language; texts must not be empty."""
        codes = np.concatenate(texts)
        lengths = np.array([len(t) for t in texts])
        starts = np.cumsum(lengths) - lengths
        bits = self.log2(*gram_keys(codes, starts, ORDER), ORDER, np.arange(len(codes)))
        return -np.add.reduceat(bits.astype(np.float64), starts, axis=0) / lengths[:, None]


def kneser_ney(counts: dict[tuple[str, str], int]) -> LanguageModel:
    """The model for counts of (language, n-gram of the highest order).

    Lower orders count in how many different n-grams a shorter one is the end. Each order keeps what its
    discount leaves and hands the rest to the order below, the last one to all characters alike.
    """
    languages = sorted({lang for lang, _ in counts})
    model = LanguageModel(languages)
    column = {lang: i for i, lang in enumerate(languages)}
    levels: list[dict[str, np.ndarray]] = [{} for _ in range(ORDER)]
    for (lang, gram), n in counts.items():
        levels[-1].setdefault(gram, np.zeros(len(languages)))[column[lang]] += n
    for n in range(ORDER - 1, 0, -1):
        for gram, row in levels[n].items():
            short = levels[n - 1].get(gram[1:])
            if short is None:
                short = levels[n - 1][gram[1:]] = np.zeros(len(languages))
            short += row > 0
    below: dict[str, int] = {}
    probability = np.empty(0)
    for n, level in enumerate(levels, 1):
        grams = sorted(level)
        seen = np.stack([level[g] for g in grams])
        ones, twos = (seen == 1).sum(0), (seen == 2).sum(0)
        discount = np.where(ones > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5)
        heads = sorted({g[:-1] for g in grams})
        place = {h: i for i, h in enumerate(heads)}
        head = np.fromiter((place[g[:-1]] for g in grams), dtype=np.int64, count=len(grams))
        total, kinds = np.zeros((len(heads), len(languages))), np.zeros((len(heads), len(languages)))
        np.add.at(total, head, seen)
        np.add.at(kinds, head, seen > 0)
        left = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        kept = np.maximum(seen - discount, 0) / np.maximum(total[head], 1)
        if n == 1:
            lower = np.full(seen.shape, 1.0 / (len(grams) + 1))
            model.unseen = float(np.log2(np.maximum(left[0], 1e-6) / (len(grams) + 1)).mean())
        else:
            lower = probability[np.fromiter((below[g[1:]] for g in grams), dtype=np.int64, count=len(grams))]
            _store(model.contexts, heads, np.log2(np.maximum(left, 1e-9)))
        probability = kept + left[head] * lower
        below = {g: i for i, g in enumerate(grams)}
        _store(model.grams, grams, np.log2(np.maximum(probability, 1e-12)))
    return model


def _store(arrays: list, grams: Sequence[str], values: np.ndarray) -> None:
    hashes = gram_hashes(grams)
    order = np.argsort(hashes)
    arrays.append((hashes[order], values[order].astype(np.float32)))


def chunks_of(texts: Sequence[str | None], table: np.ndarray, chars: int = CHUNK_CHARS) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Places and letters of the texts that have letters, so many characters at a time; a long text goes alone."""
    chunk, size = [], 0
    for i, text in enumerate(texts):
        codes = letters_of(text, table) if isinstance(text, str) and text else ()
        if len(codes):
            if chunk and size + len(codes) > chars:
                yield chunk
                chunk, size = [], 0
            chunk.append((i, codes))
            size += len(codes)
    if chunk:
        yield chunk


def _gram_counter(order: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = letter_table()
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                counts: Counter[str] = Counter()
                for text in part["text"]:
                    codes = letters_of(text, table)
                    if len(codes):
                        padded = " " * (order - 1) + codes.tobytes().decode("utf-32-le", "surrogatepass")
                        counts.update(padded[i : i + order] for i in range(len(padded) - order + 1))
                if counts:
                    yield pd.DataFrame({"lang": lang, "gram": list(counts), "n": list(counts.values())})

    return count


def _share(rows: DataFrame, chars: int) -> dict[str, float]:
    """The share of each language's rows that makes up its part of the training text."""
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    return {lang: min(1.0, chars / len(sizes) / max(n or 0, 1)) for lang, n in sizes.items()}


def learn_languages(labelled: DataFrame, train_chars: int = TRAIN_CHARS) -> LanguageModel | None:
    """The model of the non-null ``lang`` values of ``key, text, lang``; None if nothing can be learnt.

    A hash of the key picks rows until each language has its share of ``train_chars``; one in five of them
    serves to calibrate what is far from every language. A language that this leaves without training text learns
    from its calibration rows, or else from its row of smallest draw, so that none with letters is missing; it is
    calibrated as the others' furthest. The number of languages is taken to be small.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    shares = _share(rows, train_chars)
    if not shares:
        return None
    draw = fraction(F.xxhash64(F.lit("language"), "key"))
    share = F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("lang"))
    picked = rows.where(draw <= share).withColumn("_part", F.pmod(F.xxhash64(F.lit("part"), "key"), F.lit(5)))
    schema = "lang string, gram string, n long"

    def counted(texts: DataFrame) -> dict[tuple[str, str], int]:
        grams = texts.select("lang", "text").mapInPandas(_gram_counter(ORDER), schema)
        return {(r["lang"], r["gram"]): r["n"] for r in grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect()}

    counts = counted(picked.where("_part > 0"))
    trained = sorted({lang for lang, _ in counts})
    lacking = sorted(shares.keys() - set(trained))
    if lacking:
        counts |= counted(picked.where(F.col("lang").isin(lacking)))
        lacking = sorted(shares.keys() - {lang for lang, _ in counts})
    if lacking:
        left = rows.where(F.col("lang").isin(lacking) & F.col("text").rlike("\\p{L}"))
        counts |= counted(left.groupBy("lang").agg(F.min_by("text", F.struct(draw, "text")).alias("text")))
    if not counts:
        return None
    model = kneser_ney(counts)
    shared = labelled.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays: the class need not be known to executors

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, table = LanguageModel(**shared.value), letter_table()
        for batch in batches:
            langs = batch["lang"].tolist()
            for chunk in chunks_of(batch["text"].tolist(), table):
                bits = own.cross_entropies([codes for _, codes in chunk])
                kept = [(langs[i], len(codes), bits[j, own.languages.index(langs[i])]) for j, (i, codes) in enumerate(chunk) if langs[i] in own.languages]
                yield pd.DataFrame(kept, columns=["lang", "n", "bits"])

    apart = picked.where(F.col("_part") == 0)
    if trained:  # texts that were learnt from after all tell nothing of others
        apart = apart.where(F.col("lang").isin(trained))
    measured = cut_lineage(apart.select("lang", "text").mapInPandas(measure, "lang string, n long, bits double"))
    centre, spread = np.full(len(model.languages), np.nan), np.full(len(model.languages), 3.0)
    middle = {r["lang"]: r["c"] for r in measured.groupBy("lang").agg((F.sum(F.col("bits") * F.col("n")) / F.sum("n")).alias("c")).collect()}
    if middle:
        off = (F.col("bits") - F.element_at(F.create_map(*[F.lit(x) for pair in middle.items() for x in pair]), F.col("lang"))) * F.sqrt(F.col("n"))
        wide = {r["lang"]: r["q"] for r in measured.groupBy("lang").agg(F.percentile_approx(off, 0.995).alias("q")).collect()}
        for i, lang in enumerate(model.languages):
            if lang in middle:
                centre[i], spread[i] = middle[lang], max(3.0, wide[lang])
    centre[np.isnan(centre)] = np.nanmax(centre) if middle else 8.0
    model.centre, model.spread = centre, spread
    return model


def predict(model: LanguageModel, texts: Sequence[str | None], table: np.ndarray) -> pd.DataFrame:
    """``lang_pred, score, bits, rejected`` of each text."""
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    best, score = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
    bits, rejected = np.full(len(texts), np.nan), np.ones(len(texts), dtype=bool)
    for chunk in chunks_of(texts, table):
        at = np.array([i for i, _ in chunk])
        n = np.array([len(codes) for _, codes in chunk])
        entropy = model.cross_entropies([codes for _, codes in chunk])
        pick = entropy.argmin(1)
        least = entropy.min(1)
        weight = np.exp2(np.maximum((least[:, None] - entropy) * np.minimum(n, 64)[:, None], -60))
        best[at], score[at], bits[at] = pick, 1 / weight.sum(1), least
        rejected[at] = least - model.centre[pick] > model.spread[pick] / np.sqrt(n) + model.slack
    return pd.DataFrame({"lang_pred": names[best], "score": score, "bits": bits, "rejected": rejected})


def identify(docs: DataFrame, model: LanguageModel | None, carry: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Language of every whole text: ``doc`` (carried columns), ``lang_pred, score, bits, rejected``.

    The language of least cross-entropy per character, the first by name of equal ones; ``score`` is its
    share among all languages' likelihoods of 64 characters at most. ``rejected``: the text is further from
    its language than calibration texts are, or has no letter or is null (``und``, score 0, no bits). Without
    a model all are ``und``. Only texts go to Python, a bounded number of characters at a time unless a single
    text is longer. An empty table gives an empty result. Input columns travel inside ``doc``.
    """
    rows = docs.select(packed(carry).alias("doc"), F.col(text).cast("string").alias("_text"))
    if model is None:
        none = F.lit(None).cast("double")
        return rows.select("doc", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("bits"), F.lit(True).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays: the class need not be known to executors

    @F.pandas_udf("lang_pred string, score double, bits double, rejected boolean")
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, table = LanguageModel(**shared.value), letter_table()
        for batch in batches:
            yield predict(own, batch.tolist(), table)

    return rows.withColumn("_v", verdict("_text")).select("doc", "_v.lang_pred", "_v.score", "_v.bits", "_v.rejected")


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; a null id has the remainder of an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(divisor))


def learn_from_documents(docs: DataFrame, divisor: int = 4, held_out: int = 2) -> LanguageModel | None:
    """The model of all documents' ``lang`` but for those held out by their id."""
    return learn_languages(docs.where(remainder("doc_id", divisor) != held_out).select(F.col("doc_id").alias("key"), "text", "lang"))


def keep_known_languages(docs: DataFrame) -> DataFrame:
    """The documents, all columns as they came, whose text belongs to a language of the table."""
    return unpacked(identify(docs, learn_from_documents(docs), docs.columns).where("NOT rejected"), docs.columns)
