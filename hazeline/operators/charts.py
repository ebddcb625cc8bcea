"""The tables behind the charts; drawing is left to the reader of the tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazeline.functions.labels import lookup
from hazeline.functions.numbers import mean_of, right_closed_bin
from hazeline.functions.periods import Period
from hazeline.operators.rankings import _tracked
from hazeline.params import BAND_COLOURS, CALENDAR_BINS, DEFAULTS, Params


def calendar_cells(
    m: DataFrame, period: Period, ids: Iterable[str] | DataFrame | None = None,
    params: Params = DEFAULTS,
) -> DataFrame:
    """A cell per entity, year and day of the period's months, weeks starting on Monday.

    Values meet as one map per entity and year, whose absent days stay empty. An entity's years
    run from its first to its last in ``m``; a year without rows has empty cells.
    """
    rows = m if ids is None else _tracked(m, ids)
    rows = rows.where(F.month("date").between(period.start.month, period.end.month))
    daily = rows.groupBy("location_id", "city_name", "date").agg(
        mean_of("value", params).alias("value")
    )
    years = daily.groupBy("location_id", "city_name", F.year("date").alias("year")).agg(
        F.map_from_entries(F.collect_list(F.struct("date", "value"))).alias("_values")
    )
    # A year stands for those up to the entity's next one too, which have no values.
    following = F.lead("year").over(Window.partitionBy("location_id", "city_name").orderBy("year"))
    until = F.coalesce(following - 1, "year")
    spans = years.withColumn("_until", until)
    shown = spans.withColumn("_year", F.explode(F.sequence("year", "_until"))).select(
        "location_id", "city_name", F.col("_year").alias("year"),
        F.when(F.col("_year") == F.col("year"), F.col("_values")).alias("_values"),
    )
    first = F.make_date("year", F.lit(period.start.month), F.lit(1))
    last = F.last_day(F.make_date("year", F.lit(period.end.month), F.lit(1)))
    days = shown.withColumn("date", F.explode(F.sequence(first, last)))
    value = F.try_element_at("_values", "date")
    offset = F.weekday(F.trunc("date", "MM"))
    bins = right_closed_bin("value", [0, *CALENDAR_BINS.values()], list(CALENDAR_BINS))
    cells = days.select("location_id", "city_name", "year", "date", value.alias("value"))
    return cells.withColumns(
        {
            "month": F.month("date"),
            "week_row": F.floor((F.dayofmonth("date") - 1 + offset) / 7) + 1,
            "weekday": F.weekday("date"),
            "bin": bins,
        }
    )


def map_points(summary: DataFrame) -> DataFrame:
    """Entities that have a place, with the colour of their band."""
    placed = summary.where("latitude IS NOT NULL AND longitude IS NOT NULL")
    return placed.select(
        "location_id", "city_name", "longitude", "latitude", "mean", "band",
        lookup(F.col("band"), BAND_COLOURS).alias("colour"),
    )


def donut_slices(histogram: DataFrame) -> DataFrame:
    """Histogram slices with the number in the middle of their group's ring."""
    ring = Window.partitionBy("name")
    return histogram.withColumn("centre", F.sum("value").over(ring))
