"""Ratios as SQL text; rounding, durations and averages as columns.

Ratios that end up in a text are rounded with whole-number arithmetic, so the
shown digits do not depend on how a double happens to be stored.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0


def percentage(part: str, total: str) -> str:
    """``part / total * 100`` as a double; 0 when there is nothing to divide by."""
    return f"coalesce(cast({part} AS DOUBLE) / nullif({total}, 0) * 100.0D, 0.0D)"


def _scaled_ratio(part: str, total: str, scale: int) -> str:
    """``round_half_up(part * scale / total)`` for counts, as a whole number."""
    safe = f"greatest({total}, 1L)"
    return f"((({part}) * {2 * scale}L + {safe}) div ({safe} * 2L))"


def percentage_text(part: str, total: str) -> str:
    """The percentage with one decimal, as text."""
    tenths = _scaled_ratio(part, total, 1000)
    return f"concat(cast({tenths} div 10 AS STRING), '.', cast({tenths} % 10 AS STRING))"


def percentage_2(part: str, total: str) -> str:
    """The percentage rounded to two decimals."""
    return f"({_scaled_ratio(part, total, 10000)} / 100.0D)"


def days_between(start: Column, end: Column) -> Column:
    """Days from start to end, each end cut to whole seconds, two decimals."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds / F.lit(SECONDS_PER_DAY), 2)


def clamp_negative(value: Column) -> Column:
    """Negative becomes 0; NULL stays NULL."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def mean_of_hundredths(value: Column) -> Column:
    """Average of values that carry two decimals, rounded half up to two decimals.

    The values are summed as whole hundredths: the result is exact and does not
    depend on the order in which partitions are merged.
    """
    total = F.sum(F.round(value * 100).cast("bigint"))
    count = F.count(value)
    magnitude = F.call_function("div", F.abs(total) * 2 + count, count * 2)
    return F.when(count > 0, F.signum(total.cast("double")) * magnitude / F.lit(100.0))


SUM_PLACES = 6


def exact_sum(value: Column) -> Column:
    """Sum as a double that does not depend on the order in which partitions are merged.

    Each value is rounded half up to six places and added as a decimal; only the total
    becomes a double again. NULL, text that is no number, NaN and the infinities are left
    out. The total is NULL if there is no number, if a number has more than 22 digits
    before the point, or if the total has more than 32.
    """
    number = value.try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    exact = number.try_cast(f"decimal(28,{SUM_PLACES})")
    too_long = F.max(finite & exact.isNull())
    return F.when(~too_long, F.try_sum(F.when(finite, exact)).cast("double"))
