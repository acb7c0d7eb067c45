"""Host-level quality rules: failures by host, shrunk by an empirical beta prior, joined back to documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import packed, split_words, text_or_empty, unpacked
from strataflow.session import cut_lineage

SYMBOLS = "[#*$%&|<>]+"
BLANK = "[\\x20\\x09-\\x0D]+"
MEASURES = ("word_chars", "n_words", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("short", "repeated", "symbols", "lines")


@dataclass(frozen=True)
class Limits:
    """When a document breaks a rule, and from which shrunk rate on a host is rejected."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    max_host_rate: float = 0.6


def _with_measures(df: DataFrame) -> DataFrame:
    """Columns of ``MEASURES`` from ``_text``, all from whole texts, without leaving the row.

    A window of three words is found again if its like stands next to it once all windows are sorted. Most
    texts have no such window, which their distinct hashes tell without sorting; only the others are sorted,
    by the words themselves, so that no hash decides a count.
    """
    words, starts = F.col("_words"), F.col("_starts")
    lines = F.filter(F.split(F.col("_text"), "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    third = F.greatest(F.size(words) - 2, F.lit(0))
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    windows = F.transform(words, lambda w, i: F.struct(F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("g"), i.alias("i")))
    same = lambda x, k: x["g"] == F.get(F.col("_sorted"), k)["g"]
    # A repeated window covers three words, fewer if the next repeated one begins among them.
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return (
        df.withColumn("_words", split_words(F.col("_text")))
        .withColumn("_lines", lines)
        .withColumn("_hashes", F.slice(hashes, F.lit(1), third))
        .withColumn("_again", F.size("_hashes") > F.size(F.array_distinct("_hashes")))
        .withColumn("_sorted", F.when(F.col("_again"), F.sort_array(F.slice(windows, F.lit(1), third))))
        .withColumn("_twice", F.filter("_sorted", lambda x, k: F.coalesce(same(x, k - 1), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False))))
        .withColumn("_starts", F.sort_array(F.transform("_twice", lambda x: x["i"])))
        .withColumn("word_chars", F.length(F.regexp_replace("_text", BLANK, "")).cast("long"))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("n_symbols", (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.when(F.col("_again"), covered).otherwise(F.lit(0)).cast("long"))
    )


def _broken(limits: Limits) -> dict[str, Column]:
    c = F.col
    return {
        "short": c("n_words") < limits.min_words,
        "repeated": 100 * c("n_repeat_words") > limits.max_repeat_percent * c("n_words"),
        "symbols": 100 * c("n_symbols") > limits.max_symbol_percent * c("word_chars"),
        "lines": 100 * c("n_dup_lines") > limits.max_dup_line_percent * c("n_lines"),
    }


def beta_prior(n: float, f: float, nn: float, ffn: float, k: int) -> tuple[float, float]:
    """Prior failures and prior documents, by moments of the beta-binomial over ``k`` hosts.

    ``n``, ``f``: documents and failures of all hosts; ``nn``: sum of squared documents; ``ffn``: sum of
    squared failures over documents. Hosts that differ no more than chance has it share one rate, those that
    differ wholly keep their own.
    """
    if not n:
        return 0.0, 1.0
    mean = f / n
    spread, room = mean * (1 - mean), n - nn / n - (k - 1)
    likeness = 1.0 if room <= 0 or spread <= 0 else (ffn - n * mean * mean - spread * (k - 1)) / (spread * room)
    likeness = min(max(likeness, 1e-4), 0.999) if room > 0 and spread > 0 else 1e-4
    strength = 1 / likeness - 1
    return mean * strength, strength


def host_verdicts(measured: DataFrame, limits: Limits) -> DataFrame:
    """One row per host: documents, shrunk rate of the rule it breaks most, and whether it is rejected."""
    counts = cut_lineage(
        measured.groupBy("_host").agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"_{r}")).alias(r) for r in RULES]
        )
    )
    sums = [F.sum(e).cast("double") for r in RULES for e in (F.col(r), F.col(r) * F.col(r) / F.col("n"))]
    whole = counts.agg(F.sum("n").cast("double"), F.sum(F.col("n").cast("double") * F.col("n")), F.count(F.lit(1)), *sums).first()
    n, nn, k = whole[0] or 0.0, whole[1] or 0.0, whole[2]
    rates = []
    for j, rule in enumerate(RULES):
        failures, documents = beta_prior(n, whole[3 + 2 * j] or 0.0, nn, whole[4 + 2 * j] or 0.0, k)
        rates.append((F.col(rule) + F.lit(failures)) / (F.col("n") + F.lit(documents)))
    rate = F.greatest(*rates)
    return counts.select("_host", F.col("n").alias("host_docs"), F.round(rate, 6).alias("host_rate"), (rate > limits.max_host_rate).alias("host_failed"))


def quality_rules(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text", host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Measures and verdict of every document: ``doc`` (the carried columns as a struct) and the columns below.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_docs, host_rate,
    host_failed, kept``. Texts are read once; the measures are stored, counted by host, and meet the hosts'
    verdicts, which Spark broadcasts only if their stored size is below its threshold.

    A null or empty text has no words and fails. A text of any length is measured whole, within its row. Documents without a
    host form one host. Repeated rows count
    as often as they stand there. An empty table gives an empty result. Columns of the input never clash with
    the operator's, since they travel inside ``doc``.
    """
    measured = cut_lineage(_flagged(docs, carry, text, host, limits).select("doc", "_host", "n_lines", *MEASURES, *[f"_{r}" for r in RULES]))
    return _with_verdict(measured, limits).select("doc", *MEASURES, "base_failed", "host_docs", "host_rate", "host_failed", "kept")


def _flagged(docs: DataFrame, carry: Sequence[str], text: str, host: str, limits: Limits) -> DataFrame:
    """``doc``, ``_host``, the measures, and a boolean ``_<rule>`` for each rule."""
    rows = docs.select(packed(carry).alias("doc"), F.col(host).cast("string").alias("_host"), text_or_empty(text).alias("_text"))
    return _with_measures(rows).withColumns({f"_{name}": F.coalesce(broken, F.lit(False)) for name, broken in _broken(limits).items()})


def _with_verdict(measured: DataFrame, limits: Limits) -> DataFrame:
    """The hosts' verdicts joined back, ``base_failed`` and ``kept``.

    ``kept`` is a sum over both sides of the join, so a filter on it stays above the join and the measures below it
    are worked out once; two conditions would be parted, and the own one worked out anew word by word in the scan.
    """
    hosts = cut_lineage(host_verdicts(measured, limits)).withColumnRenamed("_host", "_h")
    failed = F.col("_short") | F.col("_repeated")
    return (
        measured.join(hosts, F.col("_host").eqNullSafe(F.col("_h")), "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", failed.cast("int") + F.coalesce("host_failed", F.lit(False)).cast("int") == 0)
    )


def keep_quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents, all columns as they came, that pass their own rules and whose host is not rejected.

    The texts are read twice and never stored: the first pass leaves only counts by host, the second works out
    the two base rules again beside the text. A null, empty or blank text fails; a text of any length is
    measured whole within its row; repeated rows stand or fall together; an empty table stays empty.
    """
    return unpacked(_with_verdict(_flagged(docs, docs.columns, "text", "source", limits), limits).where("kept"), docs.columns)
