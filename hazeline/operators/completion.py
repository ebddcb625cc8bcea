"""Monthly completion diagnostics over landed measurement files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.numbers import days_mask, mean_of
from hazeline.params import DEFAULTS, Params
from hazeline.plans.staging import stage

#: The first and last day in the name of a period file.
FILE_DAYS = r"_(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})(?:[.][A-Za-z]+)?$"
PLACE = ["location_id", "city_name", "gadm1_name", "gadm1_id"]


def days_in_month(month):
    return F.dayofmonth(F.last_day(month))


def file_period(name: Column) -> tuple[Column, Column]:
    """First and last day of the period in a file's name; NULL where it has none."""
    days = [F.try_to_date(F.regexp_extract(name.cast("string"), FILE_DAYS, k)) for k in (1, 2)]
    return days[0], days[1]


def observed_completion(m: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Distinct days per file and location, over the days of the file's first month.

    A file whose name has a period of several months counts by month instead: a location has a
    row for each month of the period, of no days if it has no rows there, and one for each other
    month with rows. So no share passes 100 %, whatever the file's length. Without a period in
    its name, a file counts by its first month with rows.
    """
    # The one pass over the rows; all else comes from its small result.
    masks = m.groupBy(F.col(file_col).alias("_file"), *PLACE, F.trunc("date", "MM").alias("_month"))
    masks = stage(masks.agg(days_mask("date").alias("_mask")), "file-months")
    first, last = (F.trunc(day, "MM") for day in file_period(F.col("_file")))
    several = F.coalesce(first < last, F.lit(False))

    short = masks.where(~several)
    starts = short.groupBy(F.col("_file").alias("_f")).agg(F.min("_month").alias("month"))
    # Staged, so that the few files are what the join sends around, not all locations of one.
    starts = stage(starts, "file-starts")
    days = short.groupBy("_file", *PLACE).agg(F.sum(F.bit_count("_mask")).alias("days_with_data"))
    dated = days.join(starts, days["_file"].eqNullSafe(starts["_f"])).select(*PLACE, "days_with_data", "month")

    own = F.collect_list(F.struct(F.col("_month").alias("month"), F.bit_count("_mask").cast("bigint").alias("days_with_data")))
    long = masks.where(several).groupBy("_file", *PLACE).agg(own.alias("_own"))
    asked = F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    absent = F.transform(
        F.array_except(asked, F.col("_own.month")),
        lambda month: F.struct(month.alias("month"), F.lit(0).cast("bigint").alias("days_with_data")),
    )
    by_month = long.select(*PLACE, F.inline(F.concat("_own", absent))).select(*PLACE, "days_with_data", "month")

    length = days_in_month(F.col("month"))
    return dated.unionByName(by_month).select(
        *PLACE, "days_with_data", "month",
        F.date_format("month", "yyyy-MM").alias("snapshot_month"),
        length.alias("days_in_month"),
        (F.col("days_with_data") / length).alias("percent_days"),
    )


def _first_place():
    """Names of the oldest month, the least of them if it has several."""
    names = ["city_name", "gadm1_name", "gadm1_id"]
    return F.min_by(F.struct(*names), F.struct("month", *names))


def entity_metadata(observed: DataFrame) -> DataFrame:
    """First known names per location."""
    first = observed.groupBy("location_id").agg(_first_place().alias("_place"))
    return first.select("location_id", "_place.*")


def month_dimension(observed: DataFrame) -> DataFrame:
    months = observed.select("month", "snapshot_month").distinct()
    return months.withColumn("days_in_month", days_in_month(F.col("month")))


def completion_grid(observed: DataFrame) -> DataFrame:
    """A row per location and month seen anywhere; no data counts as zero days.

    A location's own months and the months it lacks are put together per location, so the
    full grid needs neither a cross join nor a join back. Reads ``observed`` twice: pass it
    staged.
    """
    months = observed.agg(F.array_sort(F.collect_set("month"))).scalar()
    own = observed.groupBy("location_id").agg(
        _first_place().alias("_place"),
        F.collect_list(F.struct("month", "days_with_data")).alias("_own"),
    )
    zero = F.lit(0).cast("bigint")
    absent = F.transform(
        F.array_except(F.col("_months"), F.col("_own.month")),
        lambda month: F.struct(month.alias("month"), zero.alias("days_with_data")),
    )
    cells = own.withColumn("_months", months).select(
        "location_id", "_place.*", F.inline(F.concat("_own", absent))
    )
    length = days_in_month(F.col("month"))
    return cells.select(
        "month", F.date_format("month", "yyyy-MM").alias("snapshot_month"), *PLACE,
        "days_with_data", length.alias("days_in_month"),
        (F.col("days_with_data") / length).alias("percent_days"),
    )


def _by_completion(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.asc_nulls_last("mean_percent_days"), F.asc_nulls_last("city_name"),
        F.asc_nulls_last("gadm1_name"), F.asc_nulls_last("location_id"),
    )


def _location_means(grid: DataFrame, keys: list[str], params: Params) -> DataFrame:
    mean = mean_of("percent_days", params)
    return grid.groupBy(*keys).agg(mean.alias("mean_percent_days"))


def completion_order(grid: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Mean completion per location, least complete first."""
    means = _location_means(grid, ["location_id", "city_name", "gadm1_name"], params)
    return _by_completion(means.select("location_id", "mean_percent_days", "city_name", "gadm1_name"))


def completion_summary(grid: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Locations and their completion per month.

    The exact median keeps one counter per distinct percentage, and a month has few of those.
    """
    return grid.groupBy("month", "snapshot_month").agg(
        F.count_distinct("location_id").alias("total_locations"),
        F.count_if(F.col("days_with_data") > 0).alias("locations_with_any_data"),
        F.count_if(F.col("percent_days") >= params.day_share).alias(
            "locations_with_80_percent_data"
        ),
        mean_of("percent_days", params).alias("mean_percent_days"),
        F.median("percent_days").alias("median_percent_days"),
    )


def under_threshold_entities(order: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Locations at or below the threshold on average."""
    label = F.concat(
        F.coalesce("city_name", F.lit("NA")), F.lit(", "), F.coalesce("gadm1_name", F.lit("NA"))
    )
    low = order.where(F.col("mean_percent_days") <= params.day_share)
    return _by_completion(low.withColumn("location_label", label))


def under_threshold_grid(grid: DataFrame, under: DataFrame) -> DataFrame:
    """Grid rows of those locations, with their labels."""
    labels = under.select(F.col("location_id").alias("_id"), "location_label")
    return grid.join(labels, grid["location_id"].eqNullSafe(labels["_id"])).drop("_id")


def under_threshold_order(under_grid: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Their order on the chart, least complete first."""
    keys = ["location_id", "location_label", "city_name", "gadm1_name"]
    return _by_completion(_location_means(under_grid, keys, params))
