"""Guarded numbers, rounding, moods and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import strip


# What reads as a number: no type letter after it ("320d"), which a cast would take.
_NUMBER = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity)$"


def safe_double(x: Column) -> Column:
    """Text to double; anything unreadable, and NaN, is null."""
    text = strip(x.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def safe_long(x: Column) -> Column:
    """Text to a truncated integer through double ("320.9" becomes 320)."""
    return safe_double(x).try_cast("bigint")


def number_or_zero(x: Column) -> Column:
    return F.coalesce(safe_double(x), F.lit(0.0))


def round_even(x: Column, digits: int = 2) -> Column:
    """Half-even rounding on the decimal reading of a double, back to double."""
    return F.bround(x.cast("decimal(18,6)"), digits).cast("double")


def hours(ms: Column) -> Column:
    return ms / F.lit(1000.0 * 3600.0)


def minutes_seconds(ms: Column) -> Column:
    """``m:ss`` from milliseconds; absent or zero gives the empty string."""
    total = ms.cast("bigint")
    text = F.format_string(
        "%d:%02d", F.floor(total / 60000), F.floor((total % 60000) / 1000)
    )
    return F.when(total != 0, text).otherwise("")


def mood(energy: Column, valence: Column, energetic: float = 0.5, positive: float = 0.4) -> Column:
    """Quadrant of the energy/valence plane; unknown when either is missing."""
    high = F.when(valence >= positive, "energetic").otherwise("aggressive")
    low = F.when(valence >= positive, "chill").otherwise("melancholic")
    known = energy.isNotNull() & valence.isNotNull()
    return F.when(known, F.when(energy >= energetic, high).otherwise(low)).otherwise("")


def year_of(date_tag: Column) -> Column:
    return F.substring(F.coalesce(date_tag, F.lit("")), 1, 4)


def first_value(values: Column) -> Column:
    """First value of a multi-value tag, empty when there is none."""
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))
