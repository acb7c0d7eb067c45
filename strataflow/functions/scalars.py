"""Column expressions of the domain: dates, seasons, outcomes, ratios, JSON and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(value: Column) -> Column:
    """A date from a date, a timestamp or ISO text with or without a time; junk gives NULL."""
    text = F.trim(value.cast("string"))
    day = F.regexp_extract(text, r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ].*)?$", 1)
    return F.nullif(day, F.lit("")).try_cast("date")


def day_of(df: DataFrame, name: str) -> Column:
    """The named column as a date, parsing text only where the column holds text."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return as_date(F.col(name))


def literal_like(df: DataFrame, name: str, value) -> Column:
    """A constant in the type of a column; by way of text, so that no time zone comes between them."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast(df.schema[name].dataType)


def season(day: Column) -> Column:
    """label ``YYYY-YY`` of the season that starts in August; ``day`` is a date."""
    # Seven months back, every day of a season lies in the year the season starts in.
    start = F.year(F.add_months(day, -7))
    return F.concat(start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def date_key(day: Column) -> Column:
    """integer yyyymmdd of a date."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    """the attributes of a calendar row."""
    weekday = F.weekday(day)
    return {
        "date_key": date_key(day),
        "date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": weekday >= 5,
        "season": season(day),
    }


def match_outcome(home: Column, away: Column) -> Column:
    """which side won; a missing score gives ``unknown``, fractions are cut off."""
    # The cast cuts fractions off and makes NULL of what is no number.
    h, a = home.try_cast("long"), away.try_cast("long")
    return (
        F.when(h.isNull() | a.isNull(), "unknown")
        .when(h > a, "home_win")
        .when(a > h, "away_win")
        .otherwise("draw")
    )


def side_result(outcome: Column, home_side: Column) -> Column:
    """a match outcome seen from one side."""
    won = F.when(home_side, F.lit("home_win")).otherwise(F.lit("away_win"))
    lost = F.when(home_side, F.lit("away_win")).otherwise(F.lit("home_win"))
    return (
        F.when(outcome == won, "win")
        .when(outcome == lost, "loss")
        .when(outcome == "draw", "draw")
        .otherwise("unknown")
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """A10: quotient as a double, 0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double")).otherwise(F.lit(0.0))


def zero_if_null(value: Column) -> Column:
    """F9."""
    return F.coalesce(value, F.lit(0))


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """zero-safe percentage."""
    return F.round(safe_ratio(part, whole) * 100, digits)


def clipped_text(value: Column, length: int = 4000) -> Column:
    """F18."""
    return F.substring(value, 1, length)
