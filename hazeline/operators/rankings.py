"""Rankings with ties, year-on-year comparison, named subsets and display labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazeline.functions.labels import abbreviate, footnote_label, in_list_ci
from hazeline.functions.numbers import band, clean_double
from hazeline.operators.prepare import keep_keys, tag_group
from hazeline.operators.rollup import UNBANDED, band_columns
from hazeline.operators.summaries import (
    ENTITY, entity_days, entity_means, entity_year_summary, with_coordinates,
)
from hazeline.params import DEFAULTS, Params
from hazeline.plans.staging import global_row_number, stage


def top_with_ties(
    df: DataFrame, by: str, n: int, keys: Iterable[str] = (), highest: bool = True
) -> DataFrame:
    """Rows whose ``rank()`` by a column is at most n, per key: ties stay, NULLs rank last.

    The n-th value is found first, with bounded state in every task (n rows per key before
    the shuffle); all rows at or beyond it follow by a filter. So neither a key holding most
    rows nor any number of ties ends in one task. Reads ``df`` twice, keys and value alone at
    first: pass a table of entity size staged, and a scan of daily rows as it is.
    """
    keys = list(keys)
    order = F.desc_nulls_last(by) if highest else F.asc_nulls_last(by)
    last = F.min(by) if highest else F.max(by)
    # Fewer than n values: every row is in, NULLs too.
    limit = F.when(F.count(by) >= n, last)
    if not keys:
        cut = df.select(by).orderBy(order).limit(n).agg(limit.alias("_cut")).scalar()
        marked = df.withColumn("_cut", cut)
    else:
        first = Window.partitionBy(*keys).orderBy(order)
        best = df.select(*keys, by).withColumn("_n", F.row_number().over(first))
        cuts = best.where(F.col("_n") <= n).groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
        # Staged, so that the join below knows how small it is before any row moves.
        cuts = stage(cuts.agg(limit.alias("_cut")), "cuts")
        matches = [df[k].eqNullSafe(cuts[f"_{k}"]) for k in keys]
        marked = df.join(cuts, matches, "inner").drop(*[f"_{k}" for k in keys])
    beyond = F.col(by) >= F.col("_cut") if highest else F.col(by) <= F.col("_cut")
    return marked.where(F.col("_cut").isNull() | beyond).drop("_cut")


# --- labels ---


def display_labels(
    df: DataFrame, region_col: str = "gadm1_name", group_col: str | None = None,
    group: str = DEFAULTS.group,
) -> DataFrame:
    """City names, with the region's short form where two locations share a name.

    Members of the group are starred when ``group_col`` is given. Reads ``df`` twice.
    """
    # More than one distinct id, without a distinct: the least differs from the greatest,
    # or a NULL id stands beside a known one.
    ids = F.col("location_id")
    several = (F.min(ids) != F.max(ids)) | ((F.count(ids) > 0) & (F.count(ids) < F.count("*")))
    names = df.groupBy(F.col("city_name").alias("_city")).agg(
        F.coalesce(several, F.lit(False)).alias("show_state")
    )
    joined = df.join(names, df["city_name"].eqNullSafe(names["_city"]), "left").drop("_city")
    short = abbreviate(F.col(region_col))
    label = F.when(
        F.col("show_state"),
        F.concat(
            F.coalesce(F.col("city_name"), F.lit("NA")), F.lit(", "),
            F.coalesce(F.col("state_abbreviation"), F.lit("NA")),
        ),
    ).otherwise(F.col("city_name"))
    if group_col is not None:
        label = F.when(F.col(group_col) == group, F.concat(label, F.lit("*"))).otherwise(label)
    return joined.withColumn("state_abbreviation", short).withColumn("city_label", label)


def footnote_labels(df: DataFrame, group: str = DEFAULTS.group) -> DataFrame:
    """Axis text per entity. The group to star is a parameter."""
    label = footnote_label(F.col("city_name"), F.col("gadm1_name"), F.col("name"), group)
    return df.withColumn("label", label)


# --- national rankings ---


def _bands(params: Params) -> list[str]:
    return [c for c in band_columns(params) if c != UNBANDED]


def _with_days(summary: DataFrame, days: DataFrame, columns: list[str]) -> DataFrame:
    facts = days.select(F.col("location_id").alias("_id"), *columns)
    joined = summary.join(facts, summary["location_id"].eqNullSafe(facts["_id"]), "left")
    return joined.drop("_id")


def ranked_entities(
    summary: DataFrame, r: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Every entity by mean, highest first. pass_* are counts of days."""
    columns = [*_bands(params), "monitored_days", "pass_who", "pass_naaqs"]
    base = summary.drop("pass_who", "pass_naaqs", "pass_naaqs2", "band")
    rows = _with_days(base, entity_days(r, params), columns)
    order = [F.desc_nulls_last("mean"), F.asc("location_id"), F.asc("city_name"), F.asc("year")]
    numbered = global_row_number(rows, order, "row_number")
    return numbered.select(
        "row_number", "city_name", F.col("gadm1_name").alias("state_name"),
        F.col("name").alias("is_ncap"), "mean", *reversed(_bands(params)),
        "monitored_days", "pass_who", "pass_naaqs",
    )


def _extreme_entities(summary, r, params, n, highest):
    n = params.top_n if n is None else n
    picked = top_with_ties(summary, "mean", n, highest=highest).select(
        "location_id", "city_name", "gadm1_name", "mean", "name"
    )
    columns = ["monitored_days", "exceedance_pct", *_bands(params)]
    rows = _with_days(picked, entity_days(r, params), columns)
    return rows.select(
        "location_id", "city_name", "gadm1_name", "name", "monitored_days", "mean",
        "exceedance_pct", *_bands(params),
    )


def top_entities(
    summary: DataFrame, r: DataFrame, params: Params = DEFAULTS, n: int | None = None
) -> DataFrame:
    """The n highest means, ties kept, with bands and exceedance."""
    return _extreme_entities(summary, r, params, n, True)


def bottom_entities(
    summary: DataFrame, r: DataFrame, params: Params = DEFAULTS, n: int | None = None
) -> DataFrame:
    """The n lowest means, ties kept, with bands and exceedance."""
    return _extreme_entities(summary, r, params, n, False)


def same_entities_previous_year(
    top: DataFrame, r_previous: DataFrame, groups: DataFrame, year: int,
    params: Params = DEFAULTS,
) -> DataFrame:
    """The top entities one year earlier."""
    before = r_previous.where(F.col("year") == year - 1)
    before = keep_keys(before, top, ["location_id"])
    summary = entity_year_summary(before, groups, params)
    columns = ["monitored_days", "exceedance_pct", *_bands(params)]
    rows = _with_days(summary, entity_days(before, params), columns)
    return rows.select(
        "location_id", "city_name", "gadm1_name", "name", "year", "monitored_days", "mean",
        "exceedance_pct", *_bands(params),
    )


def year_on_year(
    top: DataFrame, top_before: DataFrame, year: int, params: Params = DEFAULTS
) -> DataFrame:
    """Both years of the top entities, one below the other, under the focus year's labels."""
    labels = display_labels(top, group_col="name", group=params.group).select(
        F.col("location_id").alias("_id"), "city_label"
    )
    rows = top.withColumn("year", F.lit(year)).unionByName(top_before)
    return rows.join(labels, rows["location_id"].eqNullSafe(labels["_id"]), "left").drop("_id")


def top_n_frequency(m: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """How often each entity is among the day's n highest, ties kept.

    Two passes over the daily rows, neither of which writes them: the first reads keys and
    value alone to find each day's n-th value, the second filters and counts.
    """
    keys = ["date", "pollutant", "pollutant_name"]
    names = ["location_id", "city_name", "gadm1_name"]
    rows = m.select(*keys, *names, clean_double("value").alias("value"))
    daily = top_with_ties(rows, "value", params.top_n, keys)
    counts = daily.groupBy(*names).agg(F.count("*").alias("count"))
    # Staged, since the labels look at the counted entities twice.
    labelled = display_labels(stage(counts, "frequency")).orderBy(
        F.desc("count"), F.asc_nulls_last("city_name"), F.asc_nulls_last("gadm1_name"),
        F.asc("location_id"),
    )
    return labelled.select("location_id", "city_label", "count")


def top_per_region(summary: DataFrame, n: int = 1) -> DataFrame:
    """The n highest means in each region, ties kept."""
    return top_with_ties(summary, "mean", n, ["gadm1_name"]).orderBy(
        F.desc_nulls_last("mean"), F.asc("location_id")
    )


# --- named subsets ---


def _named(df: DataFrame, names: Iterable[str] | DataFrame, ignore_case: bool) -> DataFrame:
    """Rows whose city is on the list; a list too long for literals is a one-column frame."""
    city = F.col("city_name")
    if not isinstance(names, DataFrame):
        # A bare isin, which scans can take; a NULL city is dropped by the filter anyway.
        return df.where(in_list_ci(city, names) if ignore_case else city.isin(list(names)))
    listed = F.col(names.columns[0])
    if ignore_case:
        city, listed = F.lower(city), F.lower(listed)
    return df.withColumn("_name", city).join(
        names.select(listed.alias("_name")), "_name", "left_semi"
    ).drop("_name")


def named_subset_means(
    r: DataFrame, groups: DataFrame, names: Iterable[str] | DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Means of the listed cities whatever the case; ``name`` is NULL outside the group."""
    means = entity_means(_named(r, names, True), ENTITY, params)
    return tag_group(means, groups, params.group).orderBy(
        F.desc_nulls_last("mean"), F.asc("location_id")
    )


def group_subset_means(
    r: DataFrame, groups: DataFrame, cities: DataFrame, names: Iterable[str] | DataFrame,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Means of cities both in the subset group and on the list, with place and band."""
    means = entity_means(_named(r, names, False), ENTITY, params)
    tagged = tag_group(means, groups, params.subset_group).where(F.col("name").isNotNull())
    placed = with_coordinates(tagged, cities)
    return placed.withColumn("band", band("mean", params.bands)).orderBy(
        F.desc_nulls_last("mean"), F.asc("location_id")
    )


def _tracked(df: DataFrame, ids: Iterable[str] | DataFrame) -> DataFrame:
    if isinstance(ids, DataFrame):
        return keep_keys(df, ids, ["location_id"])
    return df.where(F.col("location_id").isin(list(ids)))


def tracked_entities_all_years(
    r: DataFrame, r_previous: DataFrame, ids: Iterable[str] | DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Listed entities now (year is NULL) and in every previous year."""
    now = _tracked(r, ids)
    keys = [*ENTITY, "year"]
    columns = [*band_columns(params), "monitored_days", "exceedance_pct"]
    current = _with_days(entity_means(now, keys, params), entity_days(now, params), columns)
    current = current.select("location_id", "city_name", "mean", *columns)

    then = _tracked(r_previous, ids)
    means = entity_means(then, keys, params).select("location_id", "city_name", "year", "mean")
    facts = entity_days(then, params, ["location_id", "year"]).select(
        F.col("location_id").alias("_id"), F.col("year").alias("_year"), *columns, "not_pass_naaqs"
    )
    same = means["location_id"].eqNullSafe(facts["_id"]) & means["year"].eqNullSafe(facts["_year"])
    earlier = means.join(facts, same, "left").drop("_id", "_year")
    return current.unionByName(earlier, allowMissingColumns=True)


def tracked_daily_series(
    m: DataFrame, m_previous: DataFrame, ids: Iterable[str] | DataFrame
) -> DataFrame:
    """Daily rows of the listed entities, this period and earlier ones."""
    return _tracked(m.unionByName(m_previous, allowMissingColumns=True), ids)
