"""Views of the given tables in the shapes the operators read. Whole tables, no row limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ids of two standards.
YEARLY_WHO, YEARLY_INDIA = (
    "ae5dc5c0-863c-11ef-b57b-e6cf434e9f43", "ae5e689a-863c-11ef-b57b-e6cf434e9f43",
)

# Regions that get a name with a known short form; the rest keep their nation's name.
REGION_NAMES = {"NATION_0": "Andhra Pradesh", "NATION_1": "West Bengal"}


# Declared, so that opening a table reads no footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
    "lineitem": """l_suppkey bigint, l_quantity double, l_extendedprice double, l_discount double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _loc(col: str):
    return F.concat(F.lit("loc_"), F.col(col).cast("string"))


def _region_name(col: str):
    name = F.col(col)
    for nation, region in REGION_NAMES.items():
        name = F.when(F.col(col) == nation, region).otherwise(name)
    return name


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """January 2024: a city per user, its value the day's largest; a region per nation."""
    events = table(spark, folder, "events").select(
        "user_id", F.col("ts").cast("date").alias("date"), "value"
    )
    days = events.groupBy("user_id", "date").agg(F.max("value").alias("value"))
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    placed = days.join(nation, F.col("user_id") % 25 == F.col("n_nationkey"))
    # Users ending in 0 and 1 share a city name.
    city = F.when(F.col("user_id") % 10 == 1, F.col("user_id") - 1).otherwise(F.col("user_id"))
    return placed.select(
        _loc("user_id").alias("location_id"), _loc("user_id").alias("city_id"),
        F.concat(F.lit("City "), city.cast("string")).alias("city_name"),
        F.concat(F.lit("IND."), F.col("n_nationkey").cast("string"), F.lit("_1")).alias("gadm1_id"),
        _region_name("n_name").alias("gadm1_name"),
        F.lit("pm25").alias("pollutant"), F.lit("PM2.5").alias("pollutant_name"),
        "date", "value",
    )


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """The same with all columns of a landed file."""
    fixed = {
        "process_id": "city_day_mad", "variable": "observed", "unit": "µg/m3",
        "source": "cpcb", "country_id": "IN", "level": "city",
    }
    return daily(spark, folder).withColumns({c: F.lit(v) for c, v in fixed.items()})


def mixed(spark: SparkSession, folder: str) -> DataFrame:
    """An event per landed row, of which levels, sources, pollutants, units and years vary."""
    kind, id = F.col("event_type"), F.col("event_id")
    back = F.when(id % 3 == 1, 1).when(id % 3 == 2, 9).otherwise(0)
    level = F.when(kind == "click", "station").otherwise("city")
    return table(spark, folder, "events").select(
        F.add_months(F.col("ts").cast("date"), -12 * back).alias("date"),
        F.concat(level, F.lit("_day_mad")).alias("process_id"), _loc("user_id").alias("location_id"),
        F.lit("observed").alias("variable"), "value",
        F.when(kind == "error", "ppm").when(kind != "signup", "µg/m3").alias("unit"),
        F.when(kind == "purchase", "other").otherwise("cpcb").alias("source"),
        F.when(kind == "error", "no2").otherwise("pm25").alias("pollutant"),
        F.lit("PM2.5").alias("pollutant_name"),
        F.when(F.col("user_id") % 50 != 0, "IN").alias("country_id"), level.alias("level"),
        _loc("user_id").alias("city_id"),
        F.concat(F.lit("City "), F.col("user_id").cast("string")).alias("city_name"),
        F.lit("Region").alias("gadm1_name"), F.lit("r").alias("gadm1_id"),
    )


def groups(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "events").select("user_id").distinct()
    rest = F.col("user_id") % 3
    name = F.when(rest == 0, "ncap_cities").when(rest == 1, "igp_cities").otherwise("other_cities")
    return users.select(name.alias("name"), _loc("user_id").alias("location_id"))


def cities(spark: SparkSession, folder: str) -> DataFrame:
    """Every 17th user has no place."""
    users = table(spark, folder, "events").select("user_id").distinct()
    known = F.col("user_id") % 17 != 0
    return users.select(
        _loc("user_id").alias("id"),
        F.when(known, (68 + F.col("user_id") % 29).cast("double")).alias("longitude"),
        F.when(known, (8 + F.col("user_id") % 28).cast("double")).alias("latitude"),
    )


def _registry(events: DataFrame, seen, half, states: dict) -> DataFrame:
    """A station per user, two to a city; its status is the last event of a half of the month."""
    when_half = F.when(half, F.col("event_id"))
    last = F.max_by(F.when(half, F.col("event_type")), when_half)
    stations = (
        events.groupBy("user_id")
        .agg(last.alias("last"), F.max("day").alias("latest"), F.count_if(seen).alias("seen"))
        .where("seen > 0")
    )
    status = F.lit(None).cast("string")
    for kind, text in states.items():
        status = F.when(F.col("last") == kind, text).otherwise(status)
    city = F.col("user_id") - F.col("user_id") % 2
    return stations.select(
        _loc("user_id").alias("id"),
        F.concat(F.lit("Station "), F.col("user_id").cast("string")).alias("name"),
        F.concat(F.lit("loc_"), city.cast("string")).alias("city_id"),
        F.concat(F.lit("City "), city.cast("string")).alias("city_name"),
        F.col("latest").cast("string").alias("latest_data"), status.alias("status"),
    )


def _event_days(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "user_id", "event_id", "event_type", F.col("ts").cast("date").alias("day")
    )


STATES = {"view": "Live", "click": "live", "purchase": "Delay", "signup": "Inactive"}


def registry_old(spark: SparkSession, folder: str) -> DataFrame:
    """Stations known since the first day."""
    events = _event_days(spark, folder)
    seen = (F.col("day") == "2024-01-01") & F.col("event_type").isin("view", "click")
    return _registry(events, seen, F.dayofmonth("day") <= 15, STATES)


def registry_new(spark: SparkSession, folder: str) -> DataFrame:
    """Stations heard of on the last day."""
    events = _event_days(spark, folder)
    states = STATES | {"error": F.when(F.col("user_id") % 2 == 0, "Under repair")}
    return _registry(events, F.col("day") >= "2024-01-30", F.dayofmonth("day") > 15, states)


def registries(spark: SparkSession, folder: str) -> DataFrame:
    """Both registries as they land, with the month of each."""
    fixed = {"source": "cpcb", "country_id": "IN", "level": "station"}
    now = registry_text(spark, folder).withColumn("snapshot_month", F.lit("2024-01"))
    old = registry_old(spark, folder).withColumn("snapshot_month", F.lit("2023-12"))
    old = old.withColumn("infos", F.to_json(F.struct("latest_data", "status")))
    both = now.unionByName(old.select(*now.columns))
    return both.withColumns({c: F.lit(v) for c, v in fixed.items()})


def landed_cities(spark: SparkSession, folder: str) -> DataFrame:
    fixed = {"name": "City", "gadm1_id": "IND", "country_id": "IN", "level": "city"}
    return cities(spark, folder).withColumns({c: F.lit(v) for c, v in fixed.items()})


def registry_text(spark: SparkSession, folder: str) -> DataFrame:
    """The new registry with its attributes as text: JSON for odd users, a dict for even ones."""
    stations = registry_new(spark, folder)
    road = F.concat(F.col("name"), F.lit("'s Road"))

    def quoted(col, quote, empty):
        return F.coalesce(F.concat(F.lit(quote), F.col(col), F.lit(quote)), F.lit(empty))

    python = F.concat(
        F.lit("{'address': \""), road, F.lit("\", 'latest_data': "), quoted("latest_data", "'", "None"),
        F.lit(", 'status': "), quoted("status", "'", "None"), F.lit(", 'open': True}"),
    )
    json = F.concat(
        F.lit('{"address": "'), road, F.lit('", "latest_data": '), quoted("latest_data", '"', "null"),
        F.lit(', "status": '), quoted("status", '"', "null"), F.lit(', "open": false}'),
    )
    odd = F.substring("id", -1, 1).cast("int") % 2 == 1
    return stations.select("id", "name", "city_id", "city_name", F.when(odd, json).otherwise(python).alias("infos"))


def _shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their day and the supplier's nation and region."""
    days = table(spark, folder, "lineitem").select(
        "l_suppkey", F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").alias("value"),
    )
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        days.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Years of days: a city per nation, its value the quantity shipped that day."""
    days = _shipments(spark, folder).groupBy(
        F.col("n_name").alias("location_id"), F.col("n_name").alias("city_id"),
        F.col("n_name").alias("city_name"), F.col("r_name").alias("gadm1_id"),
        F.col("r_name").alias("gadm1_name"), "date",
    )
    return days.agg(F.sum("value").alias("value")).withColumns(
        {"pollutant": F.lit("pm25"), "pollutant_name": F.lit("PM2.5")}
    )


def history_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Nations of the even region keys are one group, the rest the other."""
    nation = table(spark, folder, "nation")
    name = F.when(F.col("n_regionkey") % 2 == 0, "ncap_cities").otherwise("igp_cities")
    return nation.select(name.alias("name"), F.col("n_name").alias("location_id"))


def history_tracked(spark: SparkSession, folder: str) -> DataFrame:
    """The nation with the most suppliers in each region, the first name of equals."""
    per_nation = (
        table(spark, folder, "supplier")
        .groupBy("s_nationkey").agg(F.count("*").alias("n"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    best = F.max_by("n_name", F.struct("n", -F.col("n_nationkey")))
    return per_nation.groupBy("n_regionkey").agg(best.alias("location_id")).select("location_id")


def period_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Shipments as rows of monthly period files."""
    month = F.trunc("date", "MM")
    name = F.concat(
        F.lit("measurements_"), month.cast("string"), F.lit("_"),
        F.last_day("date").cast("string"), F.lit(".csv"),
    )
    return _shipments(spark, folder).select(
        F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("city_name"),
        F.col("r_name").alias("gadm1_name"), F.col("n_regionkey").alias("gadm1_id"),
        "date", name.alias("file_name"),
    )


def period_file_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Shipments with all columns of a landed file, and the name of their monthly file."""
    fixed = {
        "process_id": "city_day_mad", "variable": "observed", "unit": "µg/m3", "source": "cpcb",
        "pollutant": "pm25", "pollutant_name": "PM2.5", "country_id": "IN", "level": "city",
    }
    month = F.trunc("date", "MM")
    rows = _shipments(spark, folder).select(
        "date", F.col("n_name").alias("location_id"), "value", F.col("n_name").alias("city_id"),
        F.col("n_name").alias("city_name"), F.col("r_name").alias("gadm1_name"),
        F.col("r_name").alias("gadm1_id"),
        F.concat_ws("_", F.lit("measurements"), month, F.last_day("date")).alias("file"),
    )
    return rows.withColumns({c: F.lit(v) for c, v in fixed.items()})


def overshoot_records(spark: SparkSession, folder: str) -> DataFrame:
    """A record per line item; one in three standards is unknown."""
    lines = table(spark, folder, "lineitem")
    standard = (
        F.when(F.col("l_returnflag") == "A", YEARLY_WHO)
        .when(F.col("l_returnflag") == "N", YEARLY_INDIA)
        .otherwise("unknown")
    )
    record = F.struct(
        F.col("l_shipdate").cast("date").alias("date"), _loc("l_suppkey").alias("location_id"),
        F.lit("µg/m3").alias("unit"), F.lit("cpcb").alias("source"),
        F.lit("pm25").alias("pollutant"), F.lit("IN").alias("country_id"),
        standard.alias("target_id"), F.col("l_quantity").alias("target_value"),
        F.col("l_extendedprice").alias("value_overshoot"), F.lit("1y").alias("averaging_period"),
        F.col("l_discount").alias("value_avg_so_far"),
        (F.col("l_discount") > 0.05).alias("is_overshoot"),
        (F.col("l_linestatus") == "O").alias("is_overshoot_estimated"),
    )
    return lines.select("l_suppkey", record.alias("record"))


def overshoot_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A document for each record."""
    return overshoot_records(spark, folder).select(F.array("record").alias("data"))
