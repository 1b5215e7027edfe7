"""Column expressions; a missing value is always NULL (never NaN or infinity)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-15  # probabilities are kept this far from 0 and 1 before a logarithm


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where den is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def zero_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(0).cast("double"))


def last_word(col: Column) -> Column:
    """Last run of word characters, NULL where the text does not end in one."""
    return F.nullif(F.regexp_extract(col, r"(\w+)$", 1), F.lit(""))


def week_floor(day: Column, start: str = "TU") -> Column:
    """Latest day on or before ``day`` that is the given weekday."""
    return F.date_sub(F.next_day(day, start), 7)


def result_code(home: Column, away: Column, scheme: str) -> Column:
    """Outcome of a contest from its two scores.

    ``elo``: 1 / 0 / 0.5, NULL while unplayed; ``label``: H, otherwise A (draws and unplayed count
    as A); ``odds``: 1 for a home win, otherwise 0.
    """
    if scheme == "elo":
        unplayed = home.isNull() | away.isNull()
        return (
            F.when(unplayed, F.lit(None).cast("double"))
            .when(home > away, F.lit(1.0))
            .when(home < away, F.lit(0.0))
            .otherwise(F.lit(0.5))
        )
    if scheme == "label":
        return F.when(home > away, F.lit("H")).otherwise(F.lit("A"))
    if scheme == "odds":
        return F.when(home > away, F.lit(1.0)).otherwise(F.lit(0.0))
    raise ValueError(f"unknown scheme {scheme!r}")


def binary_loss(outcome: Column, p: Column) -> Column:
    """Log loss of one row; outcome may be fractional."""
    q = F.greatest(F.least(p, F.lit(1.0 - EPS)), F.lit(EPS))
    return -(outcome * F.ln(q) + (1.0 - outcome) * F.ln(1.0 - q))
