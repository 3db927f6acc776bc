"""Casts that turn unusable text into null, and wall-clock differences.

All of them are built-in expressions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"

# Accepted timestamp shapes. The regex makes the cast strict; the cast itself works
# on wall-clock time, so the session time zone has no part in it.
TIMESTAMP_SHAPES = {
    "yyyy-MM-dd HH:mm:ss": r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z",
    "yyyy-MM-dd": r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z",
}
DEFAULT_TIMESTAMP_SHAPES = ("yyyy-MM-dd HH:mm:ss",)

TRUE_FLAGS = ("Y", "TRUE", "1")

STORAGE_TYPES = {"string": "string", "date": "date", "timestamp": "timestamp_ntz", "flag": "boolean"}


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date_or_null(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(as_col(c), fmt)


def to_timestamp_or_null(c: Column | str, shapes: tuple[str, ...] = DEFAULT_TIMESTAMP_SHAPES) -> Column:
    """First accepted shape that parses; null otherwise."""
    text = as_col(c)
    matches = [text.rlike(TIMESTAMP_SHAPES[shape]) for shape in shapes]
    anyone = matches[0]
    for m in matches[1:]:
        anyone = anyone | m
    return F.when(anyone, text.try_cast("timestamp_ntz"))


def to_decimal_or_null(c: Column | str, precision: int, scale: int) -> Column:
    """Rounds half away from zero; text that is no number or does not fit is null."""
    return as_col(c).try_cast(f"decimal({precision},{scale})")


def to_integer_or_null(c: Column | str, precision: int = 38) -> Column:
    """'12.5' is 13, '-12.5' is -13."""
    return to_decimal_or_null(c, precision, 0)


def to_flag(c: Column | str) -> Column:
    """True for Y, TRUE and 1 in any case; false for all else, null included."""
    return F.coalesce(F.upper(as_col(c)).isin(*TRUE_FLAGS), F.lit(False))


def cast_text(c: Column | str, kind: str) -> Column:
    """Cast landing text to the type a feed field declares."""
    text = as_col(c)
    if kind == "string":
        return text
    if kind == "date":
        return to_date_or_null(text)
    if kind == "timestamp":
        return to_timestamp_or_null(text)
    if kind == "flag":
        return to_flag(text)
    return text.try_cast(kind)


def storage_type(kind: str) -> str:
    return STORAGE_TYPES.get(kind, kind)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:01 is 1. Null while either end is open."""
    a, b = as_col(start), as_col(end)
    days = F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    return days * 1440 + (F.hour(b) - F.hour(a)) * 60 + (F.minute(b) - F.minute(a))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed."""
    return minutes_between(start, end) * 60 + (F.second(as_col(end)) - F.second(as_col(start)))


def month_of(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def percent(part: Column, whole: Column, digits: int = 3) -> Column:
    """100 * part / whole, null when the whole is zero."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)
