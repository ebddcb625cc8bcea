"""Bins, limits, rates and exact distinct-day counting, by column name.

Long CASE expressions are written as SQL text: the plan is the same, and the driver builds
one expression instead of dozens.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.params import DEFAULTS, FREQUENCY_LABELS, FREQUENCY_SHARES, Params, sql_text


def clean_double(column: str) -> Column:
    """NaN becomes NULL, so that comparisons with it are unknown rather than false."""
    return F.expr(f"CASE WHEN NOT isnan({column}) THEN {column} END")


def right_closed_bin(column: str, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (lower, upper] holding the value; NULL outside all of them."""
    if len(breaks) != len(labels) + 1:
        raise ValueError("a bin needs one more break than labels")
    cases = []
    for lower, upper, label in zip(breaks, breaks[1:], labels):
        top = "" if upper == float("inf") else f" AND {column} <= {float(upper)!r}D"
        cases.append(f"WHEN {column} > {float(lower)!r}D{top} THEN {sql_text(label)}")
    return F.expr(f"CASE {' '.join(cases)} END")


def band(column: str, bands: Mapping[str, float] = DEFAULTS.bands) -> Column:
    """Severity band of a value; zero and everything above the last limit is NULL."""
    return right_closed_bin(column, [0, *bands.values()], list(bands))


def frequency_bin(days_over: str, days: int) -> Column:
    """Share-of-days bin of a count of days over a limit."""
    return right_closed_bin(days_over, [days * s for s in FREQUENCY_SHARES], FREQUENCY_LABELS)


def mean_of(column: str, params: Params = DEFAULTS) -> Column:
    """Mean of a column, NULL for no values, rounded so that the order of adding is no matter."""
    return F.expr(f"round(avg({column}), {params.mean_decimals})")


def merged_mean(params: Params = DEFAULTS) -> Column:
    """The same out of a rollup's sums and counts."""
    return F.expr(f"round(try_divide(sum(value_sum), sum(value_n)), {params.mean_decimals})")


def rounded_percent(part: str, total: str) -> Column:
    """Whole percent, halves to even, NULL for 0/0."""
    return F.expr(f"bround(try_divide({part}, {total}) * 100, 0)")


def days_mask(date: str) -> Column:
    """Days of one month seen in a group, as a bit mask.

    Masks merge with ``bit_or`` and hold 31 bits, so exact distinct-day counts need one
    partial aggregate and no shuffle of (entity, date) pairs.
    """
    return F.expr(f"bit_or(shiftleft(1L, dayofmonth({date}) - 1))")


def with_flags(df: DataFrame, value: str, params: Params = DEFAULTS) -> DataFrame:
    """Three compliance flags; a NULL value gives NULL flags."""
    limits = {
        "pass_who": params.who_limit,
        "pass_naaqs": params.naaqs_limit,
        "pass_naaqs2": 2 * params.naaqs_limit,
    }
    return df.withColumns({f: F.expr(f"{value} <= {x}") for f, x in limits.items()})


def number_text(column: str) -> Column:
    """Number as people write it: 4 rather than 4.0, at most six decimals."""
    return F.regexp_replace(F.round(column, 6).cast("string"), r"\.0$", "")
