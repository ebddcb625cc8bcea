"""Station registries: change of status, completeness and the status report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.labels import in_list
from hazeline.operators.prepare import keep_keys
from hazeline.params import DEFAULTS, NEW_CITY_NOTICE, Params
from hazeline.plans.staging import global_row_number, stage

REGISTRY = ["id", "name", "city_id", "city_name", "latest_data", "status"]

# States, classes and report texts.
ACTIVE = ["live", "delay"]
INACTIVE = "inactive"
NEW = "New"
NO_CHANGE = "No change"
REACTIVATED = "Reactivated"
REMOVED_NOW = "Removed this month"
REMOVED_BEFORE = "Removed in a previous month"
UNDEFINED = "Change undefined"
NO_DATA = "No data"
BELOW = "<80% data"
ABOVE = ">80% data"
NO_VALUE = "No value"
SECTIONS = [
    "Station Statuses", "City Statuses", "Changes in Stations", "Changes in Cities",
    "NCAP cities", "Non-NCAP cities",
]
CHANGE_STATS = {
    NEW: "New stations",
    REACTIVATED: "Reactivated stations",
    REMOVED_NOW: "Removed stations",
}
STATION_LISTS = [(SECTIONS[2], stat) for stat in CHANGE_STATS.values()]
CITY_LISTS = [(SECTIONS[3], "Cities with new stations")]
STATION_STATS = ["CAAQMS installed in India", "CAAQMS with"]
CITY_STATS = ["Cities covered by CAAQMS", "Cities with"]
IN_GROUP_STATS = ["NCAP cities covered by CAAQMS", "NCAP cities with"]
OUT_GROUP_STATS = ["Non-NCAP cities covered by CAAQMS", "Non-NCAP cities with"]
SHARE_STATS = [">80% data", "<80% data but >1% data", "<1% data"]


def change_class(in_old: Column, old: Column, new: Column) -> Column:
    """Change of a station from its two lower-case states; the first match wins."""
    old_active, new_active = in_list(old, ACTIVE), in_list(new, ACTIVE)
    old_inactive = old.isNull() | (old == INACTIVE)
    new_inactive = new.isNull() | (new == INACTIVE)
    return (
        F.when(~in_old & new_active, NEW)
        .when((old_active & new_active) | (~in_old & new_inactive), NO_CHANGE)
        .when(old_inactive & new_active, REACTIVATED)
        .when(old_active & new_inactive, REMOVED_NOW)
        .when(old_inactive & new_inactive, REMOVED_BEFORE)
        .otherwise(UNDEFINED)
    )


def status_change(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every station of either registry, as the new one describes it, with its change."""
    before = old.select(
        F.col("id").alias("_id"), F.lower("status").alias("_old"), F.lit(True).alias("_in_old")
    )
    both = new.select(*REGISTRY).join(before, new["id"].eqNullSafe(before["_id"]), "full")
    in_old = F.coalesce(F.col("_in_old"), F.lit(False))
    status = F.lower("status")
    return both.select(
        F.coalesce("id", "_id").alias("id"), "name", "city_id", "city_name", "latest_data",
        status.alias("status"), change_class(in_old, F.col("_old"), status).alias("change"),
    )


def completeness_class(share: Column, params: Params = DEFAULTS) -> Column:
    """An unknown share falls to the last class."""
    return F.when(share < 0.01, NO_DATA).when(share < params.day_share, BELOW).otherwise(ABOVE)


def entity_completeness(months: DataFrame, days: int, params: Params = DEFAULTS) -> DataFrame:
    """Rows - not distinct days - as a share of the days, out of ``month_counts``."""
    share = F.sum("rows") / F.lit(days)
    counted = months.groupBy(F.col("location_id").alias("id")).agg(
        share.alias("percent_complete")
    )
    return counted.withColumn("percent_category", completeness_class(F.col("percent_complete"), params))


def status_table(
    old: DataFrame, new: DataFrame, months: DataFrame, days: int, params: Params = DEFAULTS
) -> DataFrame:
    """Change and completeness of every station; ``months`` are its ``month_counts``."""
    statuses = status_change(old, new)
    complete = entity_completeness(months, days, params).withColumnRenamed("id", "_id")
    joined = statuses.join(complete, statuses["id"].eqNullSafe(complete["_id"]), "left")
    return joined.drop("_id").withColumns(
        {
            "percent_complete": F.coalesce("percent_complete", F.lit(0.0)),
            "percent_category": F.coalesce("percent_category", F.lit(NO_DATA)),
        }
    )


def _stat_rows(counts: DataFrame, section: str, stats: list[str], columns: list[str]) -> DataFrame:
    """Four counts in one row to (section, ord, pos, stat, value) rows."""
    texts = [stats[0], *[f"{stats[1]} {share}" for share in SHARE_STATS]]
    rows = ", ".join(
        f"'{section}', {i}, 1L, '{text}', CAST({column} AS STRING)"
        for i, (text, column) in enumerate(zip(texts, columns), start=1)
    )
    return counts.select(F.expr(f"stack({len(texts)}, {rows}) AS (section, ord, pos, stat, value)"))


COUNT_COLUMNS = ["total", "above", "below", "no_data"]


def status_counts(statuses: DataFrame) -> DataFrame:
    """Stations in all and per completeness class."""
    category = F.col("percent_category")
    counts = statuses.agg(
        F.count("*").alias("total"),
        F.count_if(category == ABOVE).alias("above"),
        F.count_if(category == BELOW).alias("below"),
        F.count_if(category == NO_DATA).alias("no_data"),
    )
    return _stat_rows(counts, SECTIONS[0], STATION_STATS, COUNT_COLUMNS)


def city_shares(statuses: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """A city is as complete as its best station."""
    cities = statuses.groupBy("city_id").agg(F.max("percent_complete").alias("percent_complete"))
    return cities.withColumn(
        "percent_category", completeness_class(F.col("percent_complete"), params)
    )


def _city_counts(shares: DataFrame) -> DataFrame:
    category, share = F.col("percent_category"), F.col("percent_complete")
    return shares.agg(
        F.count("*").alias("total"),
        F.count_if(category == ABOVE).alias("above"),
        F.count_if((category == BELOW) & (share > 0.01)).alias("below"),
        F.count_if(category == NO_DATA).alias("no_data"),
    )


def group_completeness(statuses: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Cities in all and per class."""
    counts = _city_counts(city_shares(statuses, params))
    return _stat_rows(counts, SECTIONS[1], CITY_STATS, COUNT_COLUMNS)


def _members(groups: DataFrame, params: Params) -> DataFrame:
    members = groups.where(F.col("name") == params.group)
    return members.select(F.col("location_id").alias("_member"))


def group_completeness_in(
    statuses: DataFrame, groups: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """The same for cities in the group."""
    shares, members = city_shares(statuses, params), _members(groups, params)
    inside = shares.join(members, shares["city_id"].eqNullSafe(members["_member"]), "left_semi")
    return _stat_rows(_city_counts(inside), SECTIONS[4], IN_GROUP_STATS, COUNT_COLUMNS)


def group_completeness_out(
    statuses: DataFrame, groups: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """The same for cities outside the group; a station without a city counts as outside."""
    shares, members = city_shares(statuses, params), _members(groups, params)
    outside = shares.join(members, shares["city_id"].eqNullSafe(members["_member"]), "left_anti")
    return _stat_rows(_city_counts(outside), SECTIONS[5], OUT_GROUP_STATS, COUNT_COLUMNS)


def _name_lists(named: DataFrame, stats: list[tuple[str, str]]) -> DataFrame:
    """A row per name under each (section, stat), numbered by name; a stat without any says so.

    ``named`` has columns place, name, id, with place the number of the stat.
    """
    order = [F.asc("place"), F.asc_nulls_last("name"), F.asc_nulls_last("id")]
    placed = global_row_number(named, order, "pos", "place")
    text = F.coalesce("name", F.lit("NA"))
    lists = placed.select("place", "pos", F.when(F.trim(text) == "", NO_VALUE).otherwise(text).alias("value"))
    wanted, seen = [], {}
    for place, (section, stat) in enumerate(stats, start=1):
        seen[section] = seen.get(section, 0) + 1
        wanted.append(f"{place}, '{section}', {seen[section]}, '{stat}'")
    all_stats = named.sparkSession.range(1).select(
        F.expr(f"stack({len(stats)}, {', '.join(wanted)}) AS (place, section, ord, stat)")
    )
    # From the names' side, so that the few stats are what a join may send around.
    filled = lists.join(all_stats, "place")
    empty = all_stats.join(named.select("place").distinct(), "place", "left_anti").select(
        "section", "ord", F.lit(1).cast("bigint").alias("pos"), "stat", F.lit(NO_VALUE).alias("value")
    )
    return filled.select("section", "ord", F.col("pos").cast("bigint"), "stat", "value").unionByName(empty)


def _changed_names(statuses: DataFrame) -> DataFrame:
    place = F.coalesce(
        *[F.when(F.col("change") == c, i) for i, c in enumerate(CHANGE_STATS, start=1)]
    )
    return statuses.select(place.alias("place"), "name", "id").where("place IS NOT NULL")


def _new_city_names(statuses: DataFrame, place: int) -> DataFrame:
    return new_cities(statuses).select(
        F.lit(place).alias("place"), F.col("city_name").alias("name"), F.col("city_id").alias("id")
    )


def change_lists(statuses: DataFrame) -> DataFrame:
    """Names of new, reactivated and removed stations, a row each, numbered by name."""
    return _name_lists(_changed_names(statuses), STATION_LISTS)


def new_cities(statuses: DataFrame) -> DataFrame:
    """Cities whose stations are all new, under every name their stations give them."""
    is_new = F.col("change") == NEW
    fresh = statuses.groupBy("city_id").agg(
        F.count_if(is_new).alias("_new"), F.count_if(~is_new).alias("_rest")
    )
    fresh = fresh.where("_new > 0 AND _rest = 0")
    return keep_keys(statuses.select("city_id", "city_name").distinct(), fresh, ["city_id"])


def new_city_lists(statuses: DataFrame) -> DataFrame:
    return _name_lists(_new_city_names(statuses, 1), CITY_LISTS)


def new_city_notice(statuses: DataFrame) -> DataFrame:
    """The notice to add when there is a new city: one row or none."""
    found = new_cities(statuses).agg(F.count("*").alias("n")).where("n > 0")
    return found.select(F.lit("new_cities").alias("type"), F.lit(NEW_CITY_NOTICE).alias("message"))


def status_report(statuses: DataFrame, groups: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """All sections as (section_ord, section, ord, pos, stat, value). Pass statuses staged."""
    names = _changed_names(statuses).unionByName(
        _new_city_names(statuses, len(STATION_LISTS) + 1)
    )
    lists = stage(_name_lists(stage(names, "names"), STATION_LISTS + CITY_LISTS), "lists")
    listed = (F.col("section") == SECTIONS[3]) & (F.col("pos") == 1) & (F.col("value") != NO_VALUE)
    notice = lists.where(listed).select(
        "section", F.lit(2).alias("ord"), "pos", F.lit(None).cast("string").alias("stat"),
        F.lit(NEW_CITY_NOTICE).alias("value"),
    )
    parts = [
        status_counts(statuses),
        group_completeness(statuses, params),
        lists,
        notice,
        group_completeness_in(statuses, groups, params),
        group_completeness_out(statuses, groups, params),
    ]
    report = reduce(DataFrame.unionByName, parts)
    place = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("section"))
    return report.select(place.cast("int").alias("section_ord"), *report.columns)


def report_lines(report: DataFrame) -> DataFrame:
    """The report as ordered Markdown lines (section_ord, ord, pos, line), one for each value."""
    first = (F.col("ord") == 1) & (F.col("pos") == 1)
    header = F.concat(
        F.when(F.col("section_ord") > 1, "\n").otherwise(""),
        F.lit("## "), "section", F.lit("\n\n"),
    )
    text = F.when(F.col("stat").isNull(), F.concat(F.lit("*"), "value", F.lit("*"))).otherwise(
        F.concat(F.lit("- "), "stat", F.lit(": "), "value")
    )
    line = F.when(first, F.concat(header, text)).otherwise(text)
    return report.select("section_ord", "ord", "pos", line.alias("line")).orderBy(
        "section_ord", "ord", "pos"
    )
