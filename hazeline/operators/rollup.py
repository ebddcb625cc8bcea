"""The monthly rollup: the only pass over daily rows that most of a report needs.

One row per entity and calendar month carries sums, limit and band counts and a mask of the
days seen. All of them merge, so means, compliance, bands, rankings and completeness over any
run of months come from this table, some thirty times smaller than the daily rows. The shuffle
carries partial aggregates only, so an entity with a third of all rows is no heavier than others.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.numbers import band, clean_double, days_mask, with_flags
from hazeline.operators.prepare import keep_keys, with_year_month
from hazeline.params import DEFAULTS, Params, column_name, sql_text

KEYS = [
    "location_id", "city_id", "city_name", "gadm1_id", "gadm1_name",
    "pollutant", "pollutant_name", "year", "month",
]

COUNTS = [
    "total", "pass_who", "not_pass_who", "pass_naaqs", "not_pass_naaqs",
    "pass_naaqs2", "not_pass_naaqs2",
]

UNBANDED = "unbanded"


def band_columns(params: Params = DEFAULTS) -> list[str]:
    return [*map(column_name, params.bands), UNBANDED]


def flag_counts(prefix: str = "") -> list[Column]:
    """Rows, and rows on each side of the three limits; a NULL flag is on neither side."""
    counts = {"total": "count(*)"}
    for flag in ("pass_who", "pass_naaqs", "pass_naaqs2"):
        counts[flag] = f"count_if({flag})"
        counts[f"not_{flag}"] = f"count_if(NOT {flag})"
    return [F.expr(f"{count} AS {prefix}{name}") for name, count in counts.items()]


def band_counts(band_col: str, params: Params = DEFAULTS) -> list[Column]:
    counts = {column_name(label): f"{band_col} = {sql_text(label)}" for label in params.bands}
    counts[UNBANDED] = f"{band_col} IS NULL"
    return [F.expr(f"count_if({test}) AS {name}") for name, test in counts.items()]


def monthly_rollup(m: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    rows = with_year_month(m).withColumn("value", clean_double("value"))
    rows = with_flags(rows, "value", params).withColumn("_band", band("value", params.bands))
    return rows.groupBy(*KEYS).agg(
        F.sum("value").alias("value_sum"),
        F.count("value").alias("value_n"),
        days_mask("date").alias("days_mask"),
        *flag_counts(),
        *band_counts("_band", params),
    )


MADE_WITH = "made_with"


def rollup_mark(params: Params = DEFAULTS) -> str:
    """The parameters that a rollup's counts depend on, as text."""
    return json.dumps(
        {
            "who_limit": float(params.who_limit), "naaqs_limit": float(params.naaqs_limit),
            "bands": {label: float(top) for label, top in params.bands.items()},
            "mean_decimals": params.mean_decimals,
        }
    )


def rollup_to_keep(r: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """A rollup with the parameters it was made with in every row, for later reports."""
    return r.withColumn(MADE_WITH, F.lit(rollup_mark(params)))


def foreign_rollup_rows(kept: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Other parameters that rows of a kept rollup were made with, and their numbers."""
    made = F.col(MADE_WITH) if MADE_WITH in kept.columns else F.lit(None).cast("string")
    counts = kept.groupBy(made.alias(MADE_WITH)).agg(F.count("*").alias("rows"))
    return counts.where(~F.col(MADE_WITH).eqNullSafe(F.lit(rollup_mark(params))))


def repeated_rollup_rows(kept: DataFrame) -> DataFrame:
    """Entity months that a kept rollup has more than once."""
    counts = kept.groupBy(*KEYS).agg(F.count("*").alias("entries"))
    return counts.where(F.col("entries") > 1)


def united_rollup(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two rollups of different days as one: sums and counts add up, masks unite."""
    merge = {c: f"bit_or({c})" if c == "days_mask" else f"sum({c})" for c in a.columns if c not in KEYS}
    both = a.unionByName(b).groupBy(*KEYS).agg(*[F.expr(f"{e} AS {c}") for c, e in merge.items()])
    return both.select(*a.columns)


def days_in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entity months with days that two rollups share, and how many."""
    keys = ["location_id", "year", "month"]
    masks = [r.groupBy(*keys).agg(F.bit_or("days_mask").alias(f"_{i}")) for i, r in enumerate((a, b))]
    right = masks[1].withColumnsRenamed({c: f"_{c}" for c in keys})
    same = reduce(lambda x, y: x & y, [masks[0][c].eqNullSafe(right[f"_{c}"]) for c in keys])
    days = F.bit_count(F.col("_0").bitwiseAND(F.col("_1")))
    return masks[0].join(right, same).select(*keys, days.alias("days")).where("days > 0")


def rollup_days(r: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct days with a row, per key; masks of one month are united before counting."""
    months = [c for c in ("year", "month") if c not in keys]
    masks = r.groupBy(*keys, *months).agg(F.bit_or("days_mask").alias("_mask"))
    return masks.groupBy(*keys).agg(F.sum(F.bit_count("_mask")).alias("days_with_data"))


def complete_rollup(r: DataFrame, day_threshold: float) -> DataFrame:
    """Rollup rows of city-years with enough days. Reads ``r`` twice: pass it staged."""
    keys = ["city_id", "year"]
    enough = rollup_days(r, keys).where(F.col("days_with_data") >= day_threshold)
    return keep_keys(r, enough, keys)


def merged(r: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return r.groupBy(*keys).agg(*[F.expr(f"sum({c}) AS {c}") for c in columns])
