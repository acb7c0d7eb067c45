"""Importance resampling towards a target distribution: hashed words, their buckets worked out by CRC matrices."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import packed, text_or_empty
from strataflow.operators.ordered import dense_number
from strataflow.session import cut_lineage

BUCKETS = 10_000
#: Bytes of a feature up to which it is a row of a matrix; a longer one would be a matrix with more columns than rows.
WIDEST_ROW = 2048
#: Bytes of texts that are taken apart at once, so that a batch's arrays stay a small multiple of this. A text is never cut.
BYTES_AT_ONCE = 4 << 20


def _byte_table() -> np.ndarray:
    """Lower-cased byte of a word, 0 for bytes between words: ASCII other than letters and digits."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    between = np.ones(128, dtype=bool)
    between[48:58] = between[65:91] = between[97:123] = False
    table[:128][between] = 0
    return table


def _crc_table() -> np.ndarray:
    """The step of CRC-32 for each byte, from its reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


WORD_BYTE, CRC_STEP = _byte_table(), _crc_table()


def distinct_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct rows of a byte matrix and, for each row, which of them it equals."""
    n, width = matrix.shape
    wide = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    wide[:, :width] = matrix
    columns = wide.view(np.uint64)
    code, seen = pd.factorize(columns[:, 0])
    for j in range(1, columns.shape[1]):
        more, kinds = pd.factorize(columns[:, j])
        code, seen = pd.factorize(code * np.int64(len(kinds)) + more)
    first = np.empty(len(seen), dtype=np.int64)
    first[code[::-1]] = np.arange(n - 1, -1, -1)
    return first, code


def crc_rows(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every row, all rows moved on by one column at a time."""
    crc = np.full(len(matrix), 0xFFFFFFFF, dtype=np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = CRC_STEP[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return crc ^ np.uint32(0xFFFFFFFF)


def crc_of_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of the bytes: spans of one length make a matrix, its distinct rows are worked out once."""
    crc = np.empty(len(starts), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts) if len(order) else ():
        length = lengths[group[0]]
        if length > WIDEST_ROW:
            crc[group] = [zlib.crc32(data[s : s + length]) for s in starts[group]]
            continue
        matrix = np.lib.stride_tricks.sliding_window_view(data, length)[starts[group]]
        first, code = distinct_rows(matrix)
        crc[group] = crc_rows(matrix[first])[code]
    return crc


def feature_buckets(data: np.ndarray, ends: np.ndarray, max_words: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and text and bucket of each feature, of texts laid end to end (``ends``: where each one ends)."""
    lower = WORD_BYTE[data]
    inside = lower != 0
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[ends] = True
    before = np.r_[False, inside[:-1]] & ~begins[:-1]
    after = np.r_[inside[1:], False] & ~begins[1:]
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(ends, starts, side="right")
    if max_words > 1:  # words of a text stand one blank apart, so that a run of them is a span
        kept = inside | np.r_[False, inside[:-1]]
        place = np.cumsum(kept) - 1
        lower = np.where(inside, lower, np.uint8(32))[kept]
        starts, stops = place[starts], place[stops - 1] + 1
    texts, spans = [text], [(starts, stops - starts)]
    for n in range(1, max_words):
        whole = np.flatnonzero(text[n:] == text[:-n])
        texts.append(text[whole])
        spans.append((starts[whole], stops[whole + n] - starts[whole]))
    where, length = (np.concatenate([s[i] for s in spans]) for i in (0, 1))
    bucket = crc_of_spans(lower, where, length) % np.uint32(buckets)
    return np.bincount(text, minlength=len(ends)), np.concatenate(texts), bucket.astype(np.int64)


def _laid_out(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts ``first, last, bytes, ends`` of an Arrow column, without a copy of the texts."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    n, offset = len(column), column.offset
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[offset : offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + BYTES_AT_ONCE, side="right")) - 1)
        last = min(last, n)
        yield first, last, data[ends[first] : ends[last]], ends[first + 1 : last + 1] - ends[first]
        first = last


def _counter(max_words: int, buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, data, ends in _laid_out(batch.column("_text")):
                total += np.bincount(feature_buckets(data, ends, max_words, buckets)[2], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    return count


def count_features(texts: DataFrame, text: str = "text", max_words: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all texts; every task counts its own, the driver gets a number per bucket."""
    counted = texts.select(text_or_empty(text).alias("_text")).mapInArrow(_counter(max_words, buckets), "bucket long, n long")
    counts = np.zeros(buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of smoothed shares in target and source, rounded down."""
    buckets = len(source)
    s, t = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(source, target)], dtype=np.int64)


def _weigher(gains: np.ndarray, max_words: int):
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, sums = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for first, last, data, ends in _laid_out(batch.column("_text")):
                words[first:last], text, bucket = feature_buckets(data, ends, max_words, buckets)
                features[first:last] = np.bincount(text, minlength=last - first)
                np.add.at(sums, first + text, gains[bucket])
            weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *map(pa.array, (words, features, weight))], names=["doc", "n_words", "n_features", "weight"])

    return weigh


def resample(
    docs: DataFrame,
    target: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 10,
    min_words: int = 20,
    max_words: int = 1,
    seed: str = "2024",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Draw documents whose words are likely in ``target``: ``doc`` (carried columns), ``n_words``, ``n_features``,
    ``weight``, ``score``, ``rank`` (null where not drawn).

    Features are runs of up to ``max_words`` words; a document's weight is the mean gain of its features' buckets, its
    score adds Gumbel noise from a hash of seed and id, so the highest scores are a draw without replacement. Texts are
    read twice and never stored; between the passes stand two numbers per bucket. The ranks come from a global range
    sort of ids and scores.

    A null or empty text has no features and weight 0; a text of any length is taken apart whole, alone if it is long.
    A null id hashes as an empty one; documents that cannot be told apart by score and id are ordered by their other
    measures, and repeated rows are drawn one by one. Equal scores go to the smaller id, nulls last. With an empty
    target all gains come from the smoothing; an empty table gives an empty result. Input columns travel in ``doc``.
    """
    gains = bucket_gains(count_features(docs, text, max_words, buckets), count_features(target, target_text, max_words, buckets))
    rows = docs.select(packed([*carry]).alias("doc"), F.col(doc_id).alias("_id"), text_or_empty(text).alias("_text"))
    rows = rows.select(F.struct("doc", "_id").alias("doc"), "_text")
    shape = T.StructType([T.StructField("doc", rows.schema["doc"].dataType), *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = cut_lineage(
        rows.mapInArrow(_weigher(gains, max_words), shape)
        .select("doc.doc", F.col("doc._id").alias("_id"), "n_words", "n_features", "weight")
        .withColumn("score", F.col("weight") + noise)
        .withColumn("_in", F.col("n_words") >= min_words)
    )
    size = scored.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_in").alias("n")).first()
    order = [F.col("_in").desc(), F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("n_words"), F.col("n_features")]
    ranked = dense_number(scored, order, "_rank", rows=size["rows"])
    drawn = F.when(F.col("_rank") <= percent * size["n"] // 100, F.col("_rank"))
    return ranked.select("doc", "n_words", "n_features", "weight", "score", drawn.alias("rank"))
