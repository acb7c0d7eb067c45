"""Data-quality rules compiled to columns.

A violation of a key rule (unique, foreign key) is first found on the key columns alone, combined
map-side, and written down. The rows themselves only meet the violating keys, which are few in any usable
table: Spark sees the size of what was written and broadcasts it, or shuffles where there are too many.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.scalars import safe_ratio
from strataflow.operators.ordered import same_keys
from strataflow.session import cut_lineage

CRITICAL, WARNING = "critical", "warning"
# This column name, and the formats of the rules' ids below.
REASON = "_dq_failure_reason"


@dataclass(frozen=True)
class Rule:
    source: str
    severity: str = CRITICAL

    @property
    def rule_id(self) -> str:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(Rule):
    """Q1."""

    columns: tuple[str, ...] = ()

    @property
    def rule_id(self) -> str:
        return f"not_null:{self.source}:{','.join(self.columns)}"


@dataclass(frozen=True)
class Range(Rule):
    """Q2: inclusive bounds; NULL and NaN pass, text that is no number fails."""

    column: str = ""
    minimum: float | None = None
    maximum: float | None = None

    @property
    def rule_id(self) -> str:
        return f"range:{self.source}:{self.column}"


@dataclass(frozen=True)
class Unique(Rule):
    """Q3: every row of a repeated key fails."""

    columns: tuple[str, ...] = ()

    @property
    def rule_id(self) -> str:
        return f"unique:{self.source}:{','.join(self.columns)}"


@dataclass(frozen=True)
class ForeignKey(Rule):
    """Q4: NULL passes; an absent target passes every row, an empty one fails every non-NULL value."""

    column: str = ""
    references_source: str = ""
    references_column: str = ""

    @property
    def rule_id(self) -> str:
        return f"foreign_key:{self.source}.{self.column}->{self.references_source}.{self.references_column}"


@dataclass(frozen=True)
class HasColumns(Rule):
    """Q5: fails every row if the table lacks an expected column."""

    expected: tuple[str, ...] = ()

    @property
    def rule_id(self) -> str:
        return f"schema:{self.source}"


References = Mapping[tuple[str, str], DataFrame | None]


def _present(df: DataFrame, name: str) -> Column:
    """Whether the column exists and holds a value."""
    if name not in df.columns:
        return F.lit(False)
    value = F.col(name)
    present = value.isNotNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan(value)
    return present


def row_failure(df: DataFrame, rule: Rule) -> Column:
    """Failure of a rule that looks at one row only."""
    if isinstance(rule, NotNull):
        failed = F.lit(False)
        for name in rule.columns:
            failed = failed | ~_present(df, name)
        return failed
    if isinstance(rule, Range):
        if rule.column not in df.columns:
            return F.lit(False)
        number = F.col(rule.column).try_cast("double")
        outside = number.isNull()
        if rule.minimum is not None:
            outside = outside | (number < rule.minimum)
        if rule.maximum is not None:
            outside = outside | (number > rule.maximum)
        not_a_number = F.coalesce(F.isnan(number), F.lit(False))
        return _present(df, rule.column) & ~not_a_number & outside
    if isinstance(rule, HasColumns):
        return F.lit(not set(rule.expected) <= set(df.columns))
    raise TypeError(f"{type(rule).__name__} does not look at one row only")


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULLs count as equal."""
    return df.groupBy(*columns).count().where("count > 1").select(*columns)


def orphan_keys(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Values without a partner in the target."""
    values = df.where(_present(df, column)).select(F.col(column)).distinct()
    known = target.select(F.col(target_column).alias("_known"))
    return values.join(known, F.col(column) == F.col("_known"), "left_anti")


def _mark(df: DataFrame, keys: Sequence[str], bad: DataFrame, flag: str) -> DataFrame:
    renamed = bad.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)])
    listed = cut_lineage(renamed).withColumn("_bad", F.lit(True))
    joined = df.join(listed, same_keys(keys, [f"_b{i}" for i in range(len(keys))]), "left")
    return joined.select(*df.columns, F.coalesce("_bad", F.lit(False)).alias(flag))


def flag_name(rule: Rule, rules: Sequence[Rule]) -> str:
    return f"_failed_{list(rules).index(rule)}"


def annotate(df: DataFrame, rules: Sequence[Rule], references: References | None = None) -> DataFrame:
    """Q8: one failure flag per rule, plus the critical rule ids a row fails, joined by ``;``."""
    references = references or {}
    out = df
    cheap = {}
    for rule in rules:
        flag = flag_name(rule, rules)
        if isinstance(rule, Unique):
            # A column the table lacks is NULL in every row, so it does not tell keys apart.
            keys = [c for c in rule.columns if c in df.columns]
            if keys:
                out = _mark(out, keys, repeated_keys(df, keys), flag)
            else:
                cheap[flag] = F.lit(df.limit(2).count() > 1)
        elif isinstance(rule, ForeignKey):
            target = references.get((rule.references_source, rule.references_column))
            if target is None or rule.column not in df.columns:
                cheap[flag] = F.lit(False)
            else:
                bad = orphan_keys(df, rule.column, target, rule.references_column)
                out = _mark(out, [rule.column], bad, flag)
        else:
            cheap[flag] = row_failure(df, rule)
    if cheap:
        out = out.withColumns(cheap)
    named = [
        F.when(F.col(flag_name(r, rules)), F.lit(r.rule_id)) for r in rules if r.severity == CRITICAL
    ]
    reason = F.concat_ws(";", *named) if named else F.lit("")
    flags = [flag_name(r, rules) for r in rules]
    return out.select(*df.columns, *flags, reason.alias(REASON))


def clean_rows(annotated: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows without a critical failure, in the columns of the input."""
    return annotated.where(F.col(REASON) == "").drop(REASON, *[flag_name(r, rules) for r in rules])


def failing_rows(annotated: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows with a critical failure and the reason."""
    return annotated.where(F.col(REASON) != "").drop(*[flag_name(r, rules) for r in rules])


def count_failures(annotated: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row with the rows of a table, the quarantined ones, and the failures of each rule."""
    flags = [flag_name(r, rules) for r in rules]
    return annotated.agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col(REASON) != "").alias("rows_quarantined"),
        *[F.count_if(F.col(flag)).alias(flag) for flag in flags],
    )


def outcomes(counted: DataFrame, rules: Sequence[Rule], source: str) -> DataFrame:
    """Q9: a row per rule with its counts and pass rate.

    A table without rules or without rows has no outcomes.
    """
    per_rule = [
        F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(r.severity).alias("severity"),
            F.col(flag_name(r, rules)).alias("rows_failed"),
        )
        for r in rules
    ]
    none = F.array().cast("array<struct<rule_id:string,severity:string,rows_failed:bigint>>")
    passed = F.col("rows_in") - F.col("rows_failed")
    return (
        counted.where("rows_in > 0")
        .select("rows_in", F.inline(F.array(*per_rule) if per_rule else none))
        .select(
            F.lit(source).alias("source_name"),
            "rule_id",
            "severity",
            F.col("rows_in").alias("rows_evaluated"),
            "rows_failed",
            F.round(safe_ratio(passed, F.col("rows_in")), 6).alias("pass_rate"),
        )
    )


def source_totals(counted: DataFrame, source: str) -> DataFrame:
    """Rows in, clean and quarantined of one table."""
    return counted.select(
        F.lit(source).alias("source_name"),
        "rows_in",
        (F.col("rows_in") - F.col("rows_quarantined")).alias("rows_clean"),
        "rows_quarantined",
    )


def below_minimum(totals: DataFrame, minimums: Mapping[str, int]) -> DataFrame:
    """Q13: a WARN row for each table with fewer rows than it should have."""
    table = totals.sparkSession.createDataFrame(list(minimums.items()), "source_name string, expected_min_rows long")
    return (
        totals.join(F.broadcast(table), "source_name")
        .where(F.col("rows_in") < F.col("expected_min_rows"))
        .select("source_name", "rows_in", "expected_min_rows", F.lit("WARN").alias("severity"))
    )
