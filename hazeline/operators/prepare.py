"""Periods, completeness, group tags and compliance flags on measurement rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.attributes import CORRUPT, parse_attributes
from hazeline.functions.numbers import band, clean_double, days_mask, with_flags
from hazeline.functions.periods import Period, within, within_years
from hazeline.params import DEFAULTS, Params
from hazeline.plans.staging import stage


def filter_period(m: DataFrame, period: Period) -> DataFrame:
    return m.where(within(F.col("date"), period))


def with_year_month(m: DataFrame) -> DataFrame:
    return m.withColumns({"year": F.year("date"), "month": F.month("date")})


def flatten_attributes(df: DataFrame, column: str, schema, strict: bool = False) -> DataFrame:
    """Replace a text column by the fields it holds."""
    rest = [c for c in df.columns if c != column]
    parsed = df.select(*rest, parse_attributes(F.col(column), schema, strict).alias("_fields"))
    return parsed.select(*rest, "_fields.*").drop(CORRUPT)


def month_counts(m: DataFrame) -> DataFrame:
    """Rows, and the days they fall on, per location and month."""
    months = m.groupBy("location_id", F.trunc("date", "MM").alias("month"))
    return months.agg(F.count("*").alias("rows"), days_mask("date").alias("days_mask"))


def distinct_days(m: DataFrame, keys: list[str]) -> DataFrame:
    """Days with a row, per key. Exact; rows meet as one mask per key and month."""
    masks = m.groupBy(*keys, F.trunc("date", "MM").alias("_month")).agg(
        days_mask("date").alias("_mask")
    )
    return masks.groupBy(*keys).agg(F.sum(F.bit_count("_mask")).alias("days_with_data"))


def keep_keys(df: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur in another frame; NULL matches NULL."""
    other = keys_of.select(*[F.col(k).alias(f"_{k}") for k in keys])
    matches = [df[k].eqNullSafe(other[f"_{k}"]) for k in keys]
    return df.join(other, matches, "left_semi")


def complete_entities(
    m: DataFrame, day_threshold: float, keys: list[str] | None = None
) -> DataFrame:
    """Rows of entities with enough days. A row counts its day even if its value is NULL."""
    keys = keys or ["city_id"]
    enough = distinct_days(m, keys).where(F.col("days_with_data") >= day_threshold)
    # Staged: one row per entity, broadcast to the measurements only if its size allows.
    return keep_keys(m, stage(enough, "complete"), keys)


def previous_periods(
    m: DataFrame, period: Period, day_threshold: float, years: int = DEFAULTS.history_years
) -> DataFrame:
    """The same window in each earlier year, complete entities only, in one scan.

    The threshold is the focus period's own, whatever the length of the earlier window.
    """
    earlier = list(range(period.year - years, period.year))
    rows = with_year_month(m.where(within_years(F.col("date"), period, earlier)))
    return complete_entities(rows, day_threshold, ["city_id", "year"])


def tag_group(
    df: DataFrame, groups: DataFrame, group: str, other: str | None = None
) -> DataFrame:
    """Membership of one group as column ``name``; the rest get ``other``, if given.

    An id that repeats within the group tags a row once (``many_to_one`` reports it).
    """
    members = groups.where(F.col("name") == group).select(
        F.col("location_id").alias("_member"), F.col("name").alias("name")
    ).distinct()
    tagged = df.join(members, df["location_id"].eqNullSafe(members["_member"]), "left")
    tagged = tagged.drop("_member")
    return tagged if other is None else tagged.fillna(other, subset=["name"])


def tag_measurements(m: DataFrame, groups: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Daily rows with group, compliance flags and severity band."""
    rows = m.withColumn("value", clean_double("value"))
    tagged = tag_group(rows, groups, params.group, params.other_group)
    return with_flags(tagged, "value", params).withColumn("band", band("value", params.bands))
