"""Means, compliance, bands and frequency tables, all out of the monthly rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.numbers import band, frequency_bin, merged_mean, rounded_percent, with_flags
from hazeline.operators.prepare import tag_group
from hazeline.operators.rollup import (
    COUNTS, band_columns, band_counts, flag_counts, merged,
)
from hazeline.params import DEFAULTS, FREQUENCY_LABELS, Params, column_name, sql_text

ENTITY = ["location_id", "city_name", "pollutant", "pollutant_name", "gadm1_name"]
REPORTED = [
    "total", "pass_who", "not_pass_who", "pass_naaqs", "not_pass_naaqs", "not_pass_naaqs2",
]


def entity_means(r: DataFrame, keys: list[str], params: Params = DEFAULTS) -> DataFrame:
    return r.groupBy(*keys).agg(merged_mean(params).alias("mean"))


def with_coordinates(df: DataFrame, cities: DataFrame) -> DataFrame:
    places = cities.select(F.col("id").alias("_id"), "latitude", "longitude")
    return df.join(places, df["location_id"].eqNullSafe(places["_id"]), "left").drop("_id")


def entity_year_summary(
    r: DataFrame, groups: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Mean per entity and year with its flags and band. Means first, tags after."""
    means = entity_means(r, [*ENTITY, "year"], params)
    tagged = tag_group(means, groups, params.group, params.other_group)
    return with_flags(tagged, "mean", params).withColumn("band", band("mean", params.bands))


def entity_summary(
    r: DataFrame, groups: DataFrame, cities: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """The same with coordinates."""
    return with_coordinates(entity_year_summary(r, groups, params), cities)


def pass_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows on either side of the limits, per key, for a frame that carries flags."""
    return df.groupBy(*keys).agg(*flag_counts()).select(*keys, *REPORTED)


def group_compliance(summary: DataFrame) -> DataFrame:
    """Entities whose mean passes, per group."""
    return pass_count(summary, ["name"])


def entity_compliance(
    r: DataFrame, groups: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Days that pass, per entity."""
    counts = merged(r, ["location_id"], COUNTS)
    tagged = tag_group(counts, groups, params.group, params.other_group)
    return tagged.select("name", "location_id", *REPORTED)


def exceedance_pct(r: DataFrame) -> DataFrame:
    """Whole percent of days over the national limit, per entity."""
    counts = merged(r, ["location_id"], ["not_pass_naaqs", "total"])
    pct = rounded_percent("not_pass_naaqs", "total")
    return counts.select("location_id", pct.alias("exceedance_pct"))


def years_seen(r: DataFrame):
    """Sorted array of the years in a table, as a scalar: one element per calendar year."""
    return r.agg(F.array_sort(F.collect_set("year"))).scalar()


def exceedance_pct_by_year(r: DataFrame) -> DataFrame:
    """Per entity and year, for every year seen anywhere; NULL percent where no days.

    The years an entity lacks are added from the list of years, not by a join. Reads ``r``
    twice: pass it staged.
    """
    counts = merged(r, ["location_id", "year"], ["not_pass_naaqs", "total"])
    own = counts.groupBy("location_id").agg(
        F.collect_list(F.struct("year", "not_pass_naaqs", "total")).alias("_own")
    )
    zero = F.lit(0).cast("bigint")
    absent = F.transform(
        F.array_except(F.col("_years"), F.col("_own.year")),
        lambda y: F.struct(y.alias("year"), zero.alias("not_pass_naaqs"), zero.alias("total")),
    )
    rows = own.withColumn("_years", years_seen(r)).select(
        "location_id", F.explode(F.concat("_own", absent)).alias("_row")
    )
    return rows.select(
        "location_id",
        F.col("_row.year").alias("year"),
        F.col("_row.not_pass_naaqs").alias("not_pass_naaqs"),
        rounded_percent("_row.not_pass_naaqs", "_row.total").alias("exceedance_pct"),
    )


def exceedance_frequency(compliance: DataFrame, days: int) -> DataFrame:
    """Bin of the share of days over each limit, per entity."""
    return compliance.withColumns(
        {
            "who_bin": frequency_bin("not_pass_who", days),
            "naaqs_bin": frequency_bin("not_pass_naaqs", days),
        }
    )


def frequency_histogram(frequency: DataFrame, which: str) -> DataFrame:
    """Entities per group and bin, every bin present. ``which`` is who_bin or naaqs_bin."""
    bins = list(enumerate(FREQUENCY_LABELS, start=1))
    counts = frequency.groupBy("name").agg(
        *[F.expr(f"count_if({which} = {sql_text(label)}) AS _{i}") for i, label in bins]
    )
    rows = ", ".join(f"{i}, {sql_text(label)}, _{i}" for i, label in bins)
    return counts.select("name", F.expr(f"stack({len(bins)}, {rows}) AS (bin_ord, {which}, value)"))


def band_pivot_by_region(summary: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Entities per region and band of their mean; fixed columns, zero-filled."""
    return summary.groupBy("gadm1_name").agg(*band_counts("band", params))


def monitored(params: Params = DEFAULTS):
    """Days in the listed bands. Severe days are left out unless asked for."""
    labels = list(params.bands)
    counted = labels if params.include_severe else labels[:-1]
    return F.expr(" + ".join(column_name(label) for label in counted))


def band_days(r: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Days per entity and band."""
    days = merged(r, ["location_id"], band_columns(params))
    return days.withColumn("monitored_days", monitored(params))


def band_days_by_year(r: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    days = merged(r, ["location_id", "year"], band_columns(params))
    return days.withColumn("monitored_days", monitored(params))


def entity_days(
    r: DataFrame, params: Params = DEFAULTS, keys: list[str] | None = None
) -> DataFrame:
    """Bands, compliance counts and exceedance of an entity in a single aggregate."""
    days = merged(r, keys or ["location_id"], [*band_columns(params), *COUNTS])
    return days.withColumns(
        {
            "monitored_days": monitored(params),
            "exceedance_pct": rounded_percent("not_pass_naaqs", "total"),
        }
    )
