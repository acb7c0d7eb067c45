"""Language-model scores by subword lattices: the probability of a text over all its segmentations."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import ascii_lower, packed, text_or_empty
from strataflow.session import cut_lineage

SPACE = "▁"
WORD = re.compile("[^\\x20\\x09-\\x0D]+")  # fixed by the contract of the queries
BLOCK_DOCS = 4096  # documents whose words are looked up together
BLOCK_CHARS = 16_000_000  # or fewer, if they hold so many characters
WORDS_AT_ONCE = 20_000
LONG_WORD = 64
FILTER_BITS = 20
PRIOR_TOKENS = 1000.0  # weight of what the vocabulary's ranks say beside the counts
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOG10 = np.log(10.0)


def _roll(key: np.ndarray, one: np.ndarray) -> np.ndarray:
    return ((key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)) ^ one


def _ones(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint64) + np.uint64(1)) * _MIX


def _final(key: np.ndarray) -> np.ndarray:
    return key ^ (key >> np.uint64(32))


def _spelling(code: int) -> np.ndarray:
    return np.frombuffer(chr(code).encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.int64)


@dataclass
class PieceModel:
    """Unigram probabilities of a fixed vocabulary: sorted hashes of its pieces, and natural logarithms.

    ``logs`` holds those of the pieces, then of the 256 bytes that spell characters without a piece, then of
    the end of a text.
    """

    hashes: np.ndarray
    logs: np.ndarray
    longest: int
    filter: np.ndarray

    @property
    def pieces(self) -> int:
        return len(self.hashes)

    def edges(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces that stand in the words, each word with a blank before it.

        Returns the words' lengths and, by piece length and place of its first character, the piece (-1: none)
        and its logarithm. A character without a piece is an edge of the vocabulary's bytes (piece -2).
        """
        lengths = np.array([len(w) + 1 for w in words])
        codes = np.frombuffer((SPACE + SPACE.join(words)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.repeat(np.cumsum(lengths), lengths)
        most = min(self.longest, int(lengths.max()))
        piece = np.full((most, len(codes)), -1, dtype=np.int32)
        logs = np.full((most, len(codes)), -np.inf)
        one = _ones(codes)
        key = one
        for k in range(1, most + 1):
            if k > 1:
                key = _roll(key[:-1], one[k - 1 :])
            final = _final(key)
            maybe = np.flatnonzero(self.filter[(final & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] & (np.arange(k, k + len(key)) <= ends[: len(key)]))
            place = np.minimum(np.searchsorted(self.hashes, final[maybe]), self.pieces - 1)
            hit = self.hashes[place] == final[maybe]
            piece[k - 1, maybe[hit]] = place[hit]
            logs[k - 1, maybe[hit]] = self.logs[place[hit]]
        bare = np.flatnonzero(piece[0] < 0)
        if len(bare):
            kinds, which = np.unique(codes[bare], return_inverse=True)
            spelled = np.array([self.logs[self.pieces + _spelling(c)].sum() for c in kinds])
            piece[0, bare], logs[0, bare] = -2, spelled[which]
        return lengths, piece, logs

    def forward(self, lengths: np.ndarray, logs: np.ndarray, backward: bool = False) -> np.ndarray:
        """Logarithms of the probability of what stands before (or from) each place, over all segmentations.

        One place more than the word has characters, word after word; words of one length go together.
        """
        starts = np.cumsum(lengths) - lengths
        out = np.empty(lengths.sum() + len(lengths))
        first = starts + np.arange(len(lengths))
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            if n > LONG_WORD and len(at) > 1:
                parts = [at[i : i + 1] for i in range(len(at))]
            else:
                parts = [at]
            for part in parts:
                table = np.full((len(part), n + 1), -np.inf)
                table[:, n if backward else 0] = 0.0
                for j in range(n - 1, -1, -1) if backward else range(1, n + 1):
                    if backward:
                        k = np.arange(1, min(len(logs), n - j) + 1)
                        terms = logs[k[None] - 1, starts[part][:, None] + j] + table[:, j + k]
                    else:
                        k = np.arange(1, min(len(logs), j) + 1)
                        terms = logs[k[None] - 1, starts[part][:, None] + j - k[None]] + table[:, j - k]
                    top = terms.max(1)
                    safe = np.where(np.isfinite(top), top, 0.0)
                    with np.errstate(divide="ignore"):
                        table[:, j] = safe + np.log(np.exp(terms - safe[:, None]).sum(1))
                out[first[part][:, None] + np.arange(n + 1)] = table
        return out

    def word_logs(self, words: Sequence[str]) -> np.ndarray:
        """Natural logarithm of each word's probability, summed over all its segmentations."""
        if not len(words):
            return np.empty(0)
        lengths, _, logs = self.edges(words)
        return self.forward(lengths, logs)[np.cumsum(lengths + 1) - 1]

    def expected(self, words: Sequence[str], counts: np.ndarray) -> np.ndarray:
        """How often each piece and byte is expected in words that occur so many times, over all segmentations."""
        lengths, piece, logs = self.edges(words)
        before, after = self.forward(lengths, logs), self.forward(lengths, logs, backward=True)
        owner = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(owner)) + owner  # of the tables, which have one more place per word
        total = before[np.cumsum(lengths + 1) - 1][owner]
        weight = np.asarray(counts, dtype=np.float64)[owner]
        out = np.zeros(len(self.logs))
        codes = None
        for k in range(1, len(piece) + 1):
            at = np.flatnonzero(piece[k - 1] != -1)
            share = np.exp(before[place[at]] + logs[k - 1, at] + after[place[at] + k] - total[at]) * weight[at]
            known = piece[k - 1, at] >= 0
            out += np.bincount(piece[k - 1, at[known]], share[known], minlength=len(out))
            if not known.all():
                if codes is None:
                    codes = np.frombuffer((SPACE + SPACE.join(words)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                kinds, which = np.unique(codes[at[~known]], return_inverse=True)
                for c, n in zip(kinds, np.bincount(which, share[~known])):
                    np.add.at(out, self.pieces + _spelling(c), n)
        return out


def vocabulary_model(model: bytes) -> PieceModel:
    """The vocabulary of a model file with the scores it has: its order of merit, as frequencies by rank."""
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain = [i for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
    plain.sort(key=lambda i: (-lib.get_score(i), i))
    texts = [lib.id_to_piece(i) for i in plain]
    frequency = np.r_[1.0 / (np.arange(len(texts)) + 2.7), np.full(256, 1.0 / (len(texts) * 10)), 0.01]
    by_length: dict[int, list[int]] = {}
    for r, text in enumerate(texts):
        by_length.setdefault(len(text), []).append(r)
    hashes = np.empty(len(texts), dtype=np.uint64)
    for n, ranks in by_length.items():
        one = _ones(np.frombuffer("".join(texts[r] for r in ranks).encode("utf-32-le"), dtype=np.uint32).reshape(len(ranks), n))
        key = one[:, 0]
        for i in range(1, n):
            key = _roll(key, one[:, i])
        hashes[ranks] = _final(key)
    order = np.argsort(hashes)
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
    logs = np.log(frequency / frequency.sum())
    return PieceModel(hashes[order], np.r_[logs[: len(texts)][order], logs[len(texts) :]], max(by_length), bits)


def _reweighted(model: PieceModel, expected: np.ndarray, texts: int) -> PieceModel:
    """The model with probabilities from expected counts, the old ones counting as a few tokens beside them."""
    counts = expected + PRIOR_TOKENS * np.exp(model.logs)
    counts[-1] += texts
    return PieceModel(model.hashes, np.log(counts / counts.sum()), model.longest, model.filter)


def _block_schema(rows: DataFrame) -> str:
    doc = rows.schema["doc"].dataType.simpleString()
    return f"block long, words array<string>, counts array<bigint>, docs array<struct<doc:{doc},held_out:boolean,n_words:bigint,bag:binary>>"


def _into_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of documents: their distinct words with counts in training texts, and each document's bag of words.

    A bag holds the places of the document's words in the block's list, ascending, as differences, then how
    often each occurs; both as 32-bit numbers, compressed.
    """
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32
    place: dict[str, int] = {}
    counts: list[int] = []
    docs: list[dict] = []
    chars = 0

    def flush() -> pd.DataFrame:
        nonlocal number, place, counts, docs, chars
        row = pd.DataFrame({"block": [number], "words": [list(place)], "counts": [counts], "docs": [docs]})
        number, place, counts, docs, chars = number + 1, {}, [], [], 0
        return row

    for batch in batches:
        for doc, held, text in zip(batch["doc"], batch["held_out"], batch["text"]):
            words = WORD.findall(text)
            bag = Counter(words)
            at = np.empty(len(bag), dtype=np.int64)
            for j, (word, n) in enumerate(bag.items()):
                i = place.get(word)
                if i is None:
                    i = place[word] = len(counts)
                    counts.append(0)
                at[j] = i
                if not held:
                    counts[i] += n
            order = np.argsort(at, kind="stable")
            times = np.fromiter(bag.values(), dtype=np.uint32, count=len(bag))[order]
            packed_bag = zlib.compress(np.diff(at[order], prepend=0).astype(np.uint32).tobytes() + times.tobytes(), 1)
            docs.append({"doc": doc, "held_out": bool(held), "n_words": len(words), "bag": packed_bag})
            chars += len(text)
            if len(docs) >= BLOCK_DOCS or chars >= BLOCK_CHARS:
                yield flush()
    if docs:
        yield flush()


def _scores_of_words(plain: dict):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = PieceModel(**plain)
        for batch in batches:
            for at in range(0, len(batch), WORDS_AT_ONCE):
                part = batch.iloc[at : at + WORDS_AT_ONCE]
                yield pd.DataFrame({"w": part["w"], "c": part["c"], "log": model.word_logs(part["w"].tolist())})

    return score


def _expected_pieces(plain: dict):
    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = PieceModel(**plain)
        total = np.zeros(len(model.logs))
        for batch in batches:
            for at in range(0, len(batch), WORDS_AT_ONCE):
                part = batch.iloc[at : at + WORDS_AT_ONCE]
                total += model.expected(part["w"].tolist(), part["c"].to_numpy())
        some = np.flatnonzero(total)
        yield pd.DataFrame({"piece": some.astype(np.int32), "n": total[some]})

    return expect


def _score_block(n_all: int, n_distinct: int, n_texts: int, end_log: float):
    rest = np.log10(n_all + 0.1 * (n_distinct + 1))

    def score(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        size = int(words["i"].max()) + 1 if len(words) else 0
        count, log = np.zeros(size), np.zeros(size)
        count[words["i"]], log[words["i"]] = words["c"], words["log"]
        base = np.log10(count + 0.1) - rest
        out = []
        for bag in docs["bag"]:
            both = np.frombuffer(zlib.decompress(bag), dtype=np.uint32)
            at, times = np.cumsum(both[: len(both) // 2], dtype=np.int64), both[len(both) // 2 :].astype(np.int64)
            out.append((int(times[count[at] > 0].sum()), float(base[at] @ times), float(log[at] @ times)))
        known, base_score, score_ = (np.array(x) for x in zip(*out))
        return pd.DataFrame({
            "doc": docs["doc"].tolist(),
            "held_out": docs["held_out"].to_numpy(),
            "n_tokens": docs["n_words"].to_numpy() + 1,
            "n_known": known + (n_texts > 0),
            "train_tokens": n_all,
            "base_score": base_score + np.log10(n_texts + 0.1) - rest,
            "score": (score_ + end_log) / _LOG10,
        })

    return score


def score_texts(docs: DataFrame, model: bytes, held_out: Column, carry: Sequence[str] = ("doc_id",), text: str = "text", rounds: int = 1) -> DataFrame:
    """``doc`` (carried columns), ``held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    Words are cut into pieces of the given vocabulary in every way there is; the logarithms of all ways are
    summed by a forward recursion. A word's pieces do not reach into the next, so a text's probability is the
    product of its words' and of its end's. The pieces' probabilities start from their ranks in the
    vocabulary, which holds no probabilities of its own; each of ``rounds`` rounds replaces them by what is expected in the training texts' words.

    Texts stay where they are: each block of documents is stored as its distinct words and a bag of words per
    document. Words are counted, scored once each, and their scores go back to the blocks, where documents add
    them up. So neither the words of the corpus nor those of a document pass through one task, and what is
    gathered grows with the corpus.

    A null text is empty: one token, its end. Without training texts all words are unknown. Repeated rows are
    scored alike. A text of any length is scored whole, as a bag of its words. An empty table gives an empty result. Input columns travel inside ``doc``.
    """
    rows = docs.select(packed(carry).alias("doc"), F.coalesce(held_out, F.lit(False)).alias("held_out"), ascii_lower(text_or_empty(text)).alias("text"))
    blocks = cut_lineage(rows.mapInPandas(_into_blocks, _block_schema(rows)))
    words = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("i", "x")).select("block", "i", F.col("x.words").alias("w"), F.col("x.counts").alias("n"))
    totals = cut_lineage(words.groupBy("w").agg(F.sum("n").alias("c")))
    row = totals.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    texts = blocks.select(F.explode("docs.held_out").alias("h")).where("NOT h").count()
    n_all, n_distinct = row[0] + texts, row[1] + (texts > 0)
    pieces = vocabulary_model(model)
    for _ in range(rounds if row[0] else 0):
        counted = totals.where("c > 0").mapInPandas(_expected_pieces(vars(pieces)), "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        expected = np.zeros(len(pieces.logs))
        for r in counted.collect():  # one row per piece of the vocabulary
            expected[r["piece"]] = r["n"]
        pieces = _reweighted(pieces, expected, texts)
    scored = cut_lineage(totals.mapInPandas(_scores_of_words(vars(pieces)), "w string, c long, log double"))
    back = words.drop("n").join(scored, "w").select(F.col("block").alias("_b"), "i", "c", "log")
    bags = blocks.select("block", F.explode("docs").alias("d")).select("block", "d.*")
    doc = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {doc}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    score = _score_block(n_all, n_distinct, texts, float(pieces.logs[-1]))
    return bags.groupBy("block").cogroup(back.groupBy("_b")).applyInPandas(score, schema)
