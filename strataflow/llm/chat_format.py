"""Chat formatting from an event log: fold deltas, edits and regenerations into messages, then render."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.llm.common import text_or_empty

START, END = "<|im_start|>", "<|im_end|>"
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"
#: Kinds that begin a message's text anew, in the order in which events of one sequence number count.
FRESH = (MESSAGE, EDIT, REGENERATE)


def escaped(text: Column) -> Column:
    """The text without any control string: a backslash before every backslash and before the bar of ``<|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given."""
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _role_line(role: Column) -> Column:
    """A role on one line; a line break in it becomes an escape that texts do not have."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _role_read(line: Column) -> Column:
    return unescaped(F.regexp_replace(line, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, turn, part, role, text`` of ``conv_id, turn, seq, kind, role, text``.

    Events of a conversation's turn are taken in the order of ``seq`` (equal ones by kind, role and text); one that is
    equal in all of these was delivered twice and counts once. Events of another kind, or of none, are ignored. A
    ``message`` begins a message; an ``edit`` or a ``regenerate`` begins the text of the message before it anew;
    a ``delta`` adds to it. Several messages of one turn are parts of it, in their order. The role is that of
    the last event that names one. Events before any message belong to the first part.

    Work is dealt out by conversation *and* turn, so a long conversation is folded by many tasks.
    """
    kinds = F.array(*[F.lit(k) for k in (*FRESH, DELTA)])
    order = [F.col("seq").asc_nulls_last(), F.array_position(kinds, F.col("kind")), F.col("role"), F.col("text")]
    line = W.partitionBy("conv_id", "turn").orderBy(*order)
    turn = line.rowsBetween(W.unboundedPreceding, 0)
    same = F.struct("seq", "kind", "role", "text")
    placed = (
        events.where(F.col("kind").isin(*FRESH, DELTA))
        .withColumn("text", text_or_empty("text"))
        .withColumn("again", same.eqNullSafe(F.lag(same).over(line)))
        .where("NOT again")
        .withColumn("part", F.greatest(F.sum((F.col("kind") == MESSAGE).cast("long")).over(turn), F.lit(1)))
        .withColumn("n", F.row_number().over(line))
        .withColumn("fresh", F.col("kind").isin(*FRESH))
    )
    steps = F.array_sort(F.collect_list(F.struct("n", "fresh", "text")))
    last = F.coalesce(F.array_max(F.transform(F.filter("steps", lambda s: s["fresh"]), lambda s: s["n"])), F.lit(0))
    return (
        placed.groupBy("conv_id", "turn", "part")
        .agg(steps.alias("steps"), F.max(F.when(F.col("role").isNotNull(), F.struct("n", "role")))["role"].alias("role"))
        .withColumn("last", last)
        .withColumn("text", F.array_join(F.transform(F.filter("steps", lambda s: s["n"] >= F.col("last")), lambda s: s["text"]), ""))
        .select("conv_id", "turn", "part", F.coalesce("role", F.lit("")).alias("role"), "text")
    )


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, spans``.

    Every message becomes ``<|im_start|>role``, a line break, the escaped text, ``<|im_end|>`` and a line break.
    ``spans`` are the first character (from 0) and the length of each text of the trained role in ``formatted``.
    A conversation is one row, so it is brought together once, as rendered pieces.
    """
    head = F.concat(F.lit(START), _role_line(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    piece = F.struct(
        F.col("turn").isNull().alias("last"), "turn", "part", F.concat(head, body, F.lit(END + "\n")).alias("piece"), F.length(head).alias("before"), F.length(body).alias("size"), (F.col("role") == trained).alias("trained")
    )
    field = lambda name: F.transform("pieces", lambda p: p[name])
    lengths = F.transform("pieces", lambda p: F.length(p["piece"]))
    return (
        messages.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
        .select(
            "conv_id",
            F.size("pieces").cast("long").alias("n_turns"),
            F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
            _spans_udf()(lengths, field("before"), field("size"), field("trained")).alias("spans"),
        )
    )


def _spans_udf():
    @F.pandas_udf("array<struct<start:bigint,size:bigint>>")
    def spans(lengths: pd.Series, before: pd.Series, size: pd.Series, trained: pd.Series) -> pd.Series:
        """Where the trained texts begin in the whole, from the pieces' lengths, and how long they are."""

        def of(length, head, body, wanted):
            starts = np.cumsum(length, dtype=np.int64) - length + head
            return [{"start": int(s), "size": int(n)} for s, n, w in zip(starts, body, wanted) if w]

        return pd.Series([of(*row) for row in zip(lengths, before, size, trained)])

    return spans


def format_chats(events: DataFrame) -> DataFrame:
    """Conversations of an event log, folded and rendered; see ``fold_events`` and ``render``.

    Null texts are empty, null roles too. Rows without a conversation form one. An empty log gives an empty
    result. Only the named columns are looked at.
    """
    return render(fold_events(events))


def read_messages(formatted: Column) -> Column:
    """The messages of a formatted conversation, read back: an array of role and text."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda piece, i: i > 0)

    def read(piece: Column) -> Column:
        line = F.instr(piece, F.lit("\n"))
        body = F.substring(piece, line + 1, F.length(piece) - line - len(END) - 1)
        return F.struct(_role_read(F.substring(piece, F.lit(1), line - 1)).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, read)


def read_trained(formatted: Column, spans: Column) -> Column:
    """The trained texts of a formatted conversation, read back from their spans."""
    return F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["size"].cast("int"))))


def _numbered(turns: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text``, without nulls in the last two; rows of one turn are numbered by these."""
    row = W.partitionBy("conv_id", "turn").orderBy("role", "text")
    filled = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text_or_empty("text").alias("text"))
    return filled.withColumn("n", F.row_number().over(row).cast("long"))


def events_of_turns(turns: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` as a log in which every row is one whole message."""
    return _numbered(turns).select("conv_id", "turn", F.col("n").alias("seq"), F.lit(MESSAGE).alias("kind"), "role", "text")


def streamed_turns(turns: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` as the log of a chat that streamed them.

    Each begins as a draft that one more delta extends and a regeneration takes back; the text then arrives in three
    deltas. Where the number of turn and row together is odd it arrives with a slip that an edit puts right. Events
    come last first, and every third delta twice; only ``seq`` tells their order.
    """
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    cut = lambda first, length: F.substring(F.col("text"), first, length)
    slip = F.pmod(F.coalesce(F.col("turn"), F.lit(0)) + F.col("n"), F.lit(2)) == 1

    def event(step: int, kind: str, text: Column, role: Column | None = None) -> Column:
        own = F.lit(None).cast("string") if role is None else role
        return F.struct((F.col("n") * 8 + step).alias("seq"), F.lit(kind).alias("kind"), own.alias("role"), text.alias("text"))

    last = event(5, DELTA, cut(2 * third + 1, size))
    steps = F.array(
        event(6, EDIT, F.col("text")),
        last,
        event(4, DELTA, F.concat(cut(third + 1, third), F.when(slip, F.lit(" slip")).otherwise(F.lit("")))),
        event(3, DELTA, cut(F.lit(1), third)),
        event(2, REGENERATE, F.lit("")),
        event(1, DELTA, F.lit(", more of it")),
        event(0, MESSAGE, F.concat(F.lit("draft of "), cut(F.lit(1), F.lit(5))), F.col("role")),
    )
    sent = F.when(slip, steps).otherwise(F.slice(steps, 2, 6))
    sent = F.when(F.col("n") % 3 == 1, F.concat(sent, F.array(last))).otherwise(sent)
    return _numbered(turns).select("conv_id", "turn", F.explode(sent).alias("e")).select("conv_id", "turn", "e.*")
