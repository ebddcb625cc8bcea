"""A whole period report: inputs to named result tables.

Daily rows are read in few passes, whatever the number of results:

1. city rows of the period and its earlier years, once, into the staged monthly rollup;
2. city rows of the period for single low values and for the daily top list;
3. station rows of the period, once, for completeness and duplicates (and once more for the
   dates of duplicates, if there are any);
4. the period files for the completion diagnostics.

Everything else reads staged tables of entity size.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.periods import Period, within_years
from hazeline.operators import charts, checks, completion, rankings, status, summaries
from hazeline.operators.prepare import (
    filter_period, flatten_attributes, keep_keys, month_counts, with_year_month,
)
from hazeline.operators.rollup import (
    MADE_WITH, complete_rollup, foreign_rollup_rows, monthly_rollup, repeated_rollup_rows,
    rollup_to_keep,
)
from hazeline.params import DEFAULTS, PLAIN_CITIES_MILLION, STATE_CAPITALS, TRACKED_CITIES, Params
from hazeline.plans.kept import KeptStore, earlier_periods
from hazeline.plans.staging import stage, staged_tables
from hazeline.sources import manifests, readers, writers


@dataclass
class Inputs:
    """Tables a report reads. Stations carry ``latest_data`` and ``status`` columns.

    ``earlier_rollup`` may be a monthly rollup of earlier years kept from other reports (see
    ``rollup_to_keep``); the measurements are then read for the period alone, and the calendar
    takes the tracked entities' earlier days from ``earlier_tracked``, which must be given.
    ``store`` has both, kept by the reports of the earlier years, and replaces them.

    ``landed_rows`` are the landed tables before any filter, by name; rules are evaluated on
    them, and there is no rule report without them.
    """

    measurements: DataFrame
    station_measurements: DataFrame
    stations: DataFrame
    stations_previous: DataFrame
    groups: DataFrame
    cities: DataFrame
    overshoots: DataFrame | None = None
    period_files: DataFrame | None = None
    earlier_rollup: DataFrame | None = None
    earlier_tracked: DataFrame | None = None
    landed_rows: dict[str, DataFrame] | None = None
    store: KeptStore | None = None

    @classmethod
    def landed(
        cls, spark: SparkSession, folder: str, period: Period, params: Params = DEFAULTS,
        fmt: str = "parquet", store: str | None = None,
    ) -> Inputs:
        """Inputs under one folder, one sub-folder per table.

        With ``store``, the folder of a kept store, no earlier days are read.
        """
        years = 0 if store else params.history_years
        history = readers.history_periods(period, years)
        raw = {
            "measurements": readers.landed_measurements(
                spark, f"{folder}/measurements", history, fmt
            ),
            "station_measurements": readers.landed_measurements(
                spark, f"{folder}/station_measurements", [(period.start, period.end)], fmt
            ),
            "stations": readers.landed_stations(spark, f"{folder}/stations", period.start, fmt),
            "stations_previous": readers.landed_stations(
                spark, f"{folder}/stations", period.previous_month, fmt
            ),
            "location_presets": readers.landed_groups(spark, f"{folder}/location_presets", fmt),
            "cities": readers.landed_cities(spark, f"{folder}/cities", fmt),
        }

        def registry(name):
            return flatten_attributes(readers.parsed(raw[name]), "infos", readers.STATION_INFOS)

        return cls(
            measurements=readers.chosen_measurements(raw["measurements"], "city"),
            station_measurements=readers.chosen_measurements(
                raw["station_measurements"], "station"
            ),
            stations=registry("stations"),
            stations_previous=registry("stations_previous"),
            groups=readers.parsed(raw["location_presets"]),
            cities=readers.parsed(raw["cities"]).select("id", "longitude", "latitude"),
            overshoots=readers.load_overshoots(
                spark, f"{folder}/overshooting", dt.date(period.year, 1, 1)
            ),
            period_files=readers.load_period_files(spark, f"{folder}/period_files"),
            landed_rows=raw,
            store=KeptStore(spark, store) if store else None,
        )


class Snapshot:
    def __init__(
        self, inputs: Inputs, period: Period, params: Params = DEFAULTS,
        tracked: Iterable[str] | DataFrame = tuple(TRACKED_CITIES),
        capitals: Iterable[str] | DataFrame = tuple(STATE_CAPITALS),
        plain_cities: Iterable[str] | DataFrame = tuple(PLAIN_CITIES_MILLION),
    ):
        self.inputs, self.period, self.params = inputs, period, params
        self.tracked, self.capitals, self.plain_cities = tracked, capitals, plain_cities
        self.threshold = period.day_threshold(params.day_share)

    @property
    def earlier(self) -> list[str]:
        return earlier_periods(self.period, self.params.history_years)

    # --- staged tables ---

    @cached_property
    def rollup(self) -> DataFrame:
        m, kept, period = self.inputs.measurements, self.inputs.earlier_rollup, self.period
        if self.inputs.store is not None:
            kept = stage(self.inputs.store.rollup(self.earlier, self.params), "kept-rollup")
        first = period.year - self.params.history_years
        if kept is None:
            years = list(range(first, period.year + 1))
            r = monthly_rollup(m.where(within_years(F.col("date"), period, years)), self.params)
        else:
            checks.enforce(
                foreign_rollup_rows(kept, self.params),
                "The kept rollup was made with other parameters",
            )
            checks.enforce(repeated_rollup_rows(kept), "Months more than once in the kept rollup")
            earlier = F.col("year").between(first, period.year - 1) & F.col("month").between(
                period.start.month, period.end.month
            )
            r = monthly_rollup(filter_period(m, period), self.params)
            r = r.unionByName(kept.where(earlier).drop(MADE_WITH))
        return stage(r, "rollup")

    @cached_property
    def complete(self) -> DataFrame:
        return stage(complete_rollup(self.rollup, self.threshold), "complete")

    @property
    def current(self) -> DataFrame:
        return self.complete.where(F.col("year") == self.period.year)

    @property
    def previous(self) -> DataFrame:
        return self.complete.where(F.col("year") < self.period.year)

    @cached_property
    def summary(self) -> DataFrame:
        args = self.current, self.inputs.groups, self.inputs.cities, self.params
        return stage(summaries.entity_summary(*args), "summary")

    @cached_property
    def station_months(self) -> DataFrame:
        return stage(month_counts(self.inputs.station_measurements), "station-months")

    @cached_property
    def statuses(self) -> DataFrame:
        i = self.inputs
        table = status.status_table(
            i.stations_previous, i.stations, self.station_months, self.period.days, self.params
        )
        return stage(table, "statuses")

    @cached_property
    def top(self) -> DataFrame:
        return stage(rankings.top_entities(self.summary, self.current, self.params), "top")

    @cached_property
    def daily(self) -> DataFrame:
        """Rows of the period for entities with enough days."""
        rows = filter_period(self.inputs.measurements, self.period)
        kept = self.current.select("city_id").distinct()
        return keep_keys(rows, stage(kept, "kept"), ["city_id"])

    # --- checks ---

    def check(self) -> None:
        """Every hard stop, in the order a reader would want to hear of them."""
        i, p = self.inputs, self.params
        raw = self.rollup.where(F.col("year") == self.period.year)
        limits = checks.limit_checks(raw, i.groups, self.threshold, p)
        checks.enforce(limits.where(~F.col("ok")), "Limits not met")
        duplicates = checks.duplicate_entries(i.station_measurements, self.station_months)
        checks.enforce(
            duplicates, "Duplicate entries found for the following locations and dates"
        )
        checks.enforce(
            checks.vanished_stations(i.stations, self.statuses),
            "Stations with a status missing from the new registry",
        )
        counts = checks.reconcile_counts(i.stations, self.statuses)
        checks.enforce(counts.where(~F.col("ok")), "Mismatch in number of stations")
        for group in (p.group, p.subset_group):
            members = i.groups.where(F.col("name") == group)
            repeated = checks.many_to_one(members, "location_id")
            checks.enforce(repeated, f"Location more than once in {group}")
        broken = checks.broken_counts(self.complete, ["location_id", "year", "month"])
        checks.enforce(broken, "Days neither passed nor not passed")

    def rule_reports(self) -> DataFrame:
        """How many rows break each rule of the landed tables; nothing is stopped."""
        given = self.inputs.landed_rows
        reports = [
            checks.rule_report(given[name], rules | readers.parse_rules(given[name]), readers.type_rules(schema))
            .select(F.lit(name).alias("table"), "*")
            for name, (schema, rules) in readers.table_rules().items()
            if name in given
        ]
        return reduce(DataFrame.unionByName, reports)

    def warnings(self) -> DataFrame:
        raw = self.rollup.where(F.col("year") == self.period.year)
        rows = filter_period(self.inputs.measurements, self.period)
        return checks.collect_warnings(
            checks.warn_high_season_mean(raw, self.params),
            checks.warn_unexpected_top(raw, self.params),
            checks.warn_low_values(rows, self.params),
            status.new_city_notice(self.statuses),
            checks.warn_region_coverage(self.summary, self.params),
        )

    # --- results ---

    def outputs(self) -> dict[str, DataFrame]:
        """The written tables, by file name."""
        i, p, year = self.inputs, self.params, self.period.year
        current, previous, summary = self.current, self.previous, self.summary
        before = rankings.same_entities_previous_year(self.top, previous, i.groups, year, p)
        clean = rankings.bottom_entities(summary, current, p)
        region, id = "State/UT", F.asc("location_id")
        lists = {
            "top10_polluted_cities": self.top.orderBy(F.desc_nulls_last("mean"), id),
            "top10_cleanest_cities": clean.orderBy(F.asc_nulls_last("mean"), id),
            "top10_polluted_cities_prev": before.orderBy(id),
        }
        outputs = {
            "statuses": self.statuses.orderBy("id"),
            "statuses_summary.md": self.report_text(),
            "monthly_compliance": summaries.group_compliance(summary).orderBy("name"),
            "cities_grap_distribution": summaries.band_pivot_by_region(summary, p)
            .withColumnRenamed("gadm1_name", region).orderBy(region),
            "all_cities_ordered": rankings.ranked_entities(summary, current, p)
            .orderBy("row_number"),
            **{
                name: df.drop("name").withColumnRenamed("gadm1_name", region)
                for name, df in lists.items()
            },
            "top5_populous_cities": rankings.tracked_entities_all_years(
                current, previous, self.tracked, p
            ).orderBy(F.asc_nulls_first("year"), id),
            "warnings": self.warnings(),
        }
        if i.landed_rows:
            outputs["rule_reports"] = self.rule_reports().orderBy("table", "rule")
        if i.overshoots is not None:
            outputs["overshooting"] = i.overshoots
        if i.period_files is not None:
            outputs |= self.diagnostics()
        return outputs

    def report_text(self) -> DataFrame:
        report = status.status_report(self.statuses, self.inputs.groups, self.params)
        return status.report_lines(report).select("line")

    @cached_property
    def completion_tables(self) -> tuple[DataFrame, DataFrame]:
        """The completion grid, and the entities under the share of days."""
        observed = stage(completion.observed_completion(self.inputs.period_files), "observed")
        grid = stage(completion.completion_grid(observed), "grid")
        order = completion.completion_order(grid, self.params)
        return grid, stage(completion.under_threshold_entities(order, self.params), "under")

    def diagnostics(self) -> dict[str, DataFrame]:
        grid, under = self.completion_tables
        name = "measurement_completion"
        return {
            f"{name}_monthly": grid.orderBy("month", "city_name", "gadm1_name", "location_id"),
            f"{name}_monthly_summary": completion.completion_summary(grid, self.params)
            .orderBy("month"),
            f"{name}_period_under_80": under,
        }

    def chart_tables(self) -> dict[str, DataFrame]:
        """The tables behind the charts."""
        i, p, year = self.inputs, self.params, self.period.year
        current, previous, summary = self.current, self.previous, self.summary
        compliance = summaries.entity_compliance(current, i.groups, p)
        frequency = stage(
            summaries.exceedance_frequency(compliance, self.period.days), "frequency"
        )
        before = rankings.same_entities_previous_year(self.top, previous, i.groups, year, p)
        capitals = rankings.named_subset_means(current, i.groups, self.capitals, p)
        plain = rankings.group_subset_means(current, i.groups, i.cities, self.plain_cities, p)
        if self.period.mode == "month":
            cells = charts.calendar_cells(self.tracked_series(), self.period, None, p)
        else:
            cells = charts.calendar_cells(self.daily, self.period, self.top, p)
        tables = {
            "compliance_naaqs": charts.donut_slices(
                summaries.frequency_histogram(frequency, "naaqs_bin")
            ),
            "compliance_who": charts.donut_slices(
                summaries.frequency_histogram(frequency, "who_bin")
            ),
            "map_points": charts.map_points(summary),
            "top10_labels": rankings.footnote_labels(self.top, p.group),
            "top10_year_on_year": rankings.year_on_year(self.top, before, year, p),
            "top10_frequency": rankings.top_n_frequency(self.daily, p),
            "top_city_per_region": rankings.footnote_labels(
                rankings.top_per_region(summary), p.group
            ),
            "state_capitals": rankings.footnote_labels(capitals, p.group),
            "plain_cities": rankings.footnote_labels(plain, p.subset_group),
            "plain_map_points": charts.map_points(plain),
            "calendar": cells,
        }
        if i.period_files is not None:
            grid, under = self.completion_tables
            under_grid = stage(completion.under_threshold_grid(grid, under), "under-grid")
            tables["under_threshold_grid"] = under_grid
            tables["under_threshold_order"] = completion.under_threshold_order(under_grid)
        return tables

    def tracked_series(self) -> DataFrame:
        """Daily rows of the tracked entities in complete years, now and before."""
        i = self.inputs
        kept = i.earlier_tracked
        if i.store is not None:
            kept = i.store.tracked_days(self.earlier, self.tracked)
        elif i.earlier_rollup is not None and kept is None:
            raise checks.DataCheckError(
                "With a kept rollup the calendar needs the tracked entities' earlier days"
            )
        first = self.period.year - self.params.history_years
        years = list(range(first, self.period.year))
        source = i.measurements if kept is None else kept
        now = with_year_month(filter_period(i.measurements, self.period))
        before = with_year_month(source.where(within_years(F.col("date"), self.period, years)))
        series = rankings.tracked_daily_series(now, before, self.tracked)
        return keep_keys(series, self.complete.select("city_id", "year"), ["city_id", "year"])

    def missing_coordinates(self) -> DataFrame:
        return checks.missing_coordinates(self.summary)


def keep_period(snapshot: Snapshot, store: KeptStore) -> dict:
    """Keep a report's own rollup and its tracked entities' days for the reports of later years."""
    own = snapshot.rollup.where(F.col("year") == snapshot.period.year)
    return store.keep(snapshot.period, own, snapshot.inputs.measurements, snapshot.tracked, snapshot.params)


def build_snapshot(
    inputs: Inputs, period: Period, folder: str, params: Params = DEFAULTS, fmt: str = "csv",
    keep_rollup: str | None = None, store: str | None = None, publish: bool = False, **lists,
) -> DataFrame:
    """Check the inputs, write every result and return the entities without a place.

    Results lie below the period's name, those behind the charts in ``charts`` there. With
    ``publish`` they lie in a fresh folder there instead, which ``published_output`` sees once
    all are complete; a report that dies changes nothing for its readers. With ``keep_rollup``
    the period's own rollup is kept in that folder for later reports, with ``store`` its rollup
    and its tracked days in that kept store. What the report staged is dropped at the end; the
    returned frame reads a written table.
    """
    spark = inputs.measurements.sparkSession
    snapshot = Snapshot(inputs, period, params, **lists)

    def write(out: str) -> list[str]:
        outputs = snapshot.outputs()
        writers.write_outputs(outputs, out, fmt)
        tables = snapshot.chart_tables()
        writers.write_outputs(tables, f"{out}/charts", fmt)
        snapshot.missing_coordinates().write.mode("overwrite").parquet(f"{out}/missing_coordinates")
        return [*outputs, *[f"charts/{name}" for name in tables], "missing_coordinates"]

    with staged_tables(spark):
        snapshot.check()
        out = f"{folder}/{period.text}"
        if publish:
            out = manifests.publish(spark, out, write, {"period": period.text, "format": fmt})["path"]
        else:
            write(out)
        if keep_rollup is not None:
            own = snapshot.rollup.where(F.col("year") == period.year)
            rollup_to_keep(own, params).write.mode("overwrite").parquet(f"{keep_rollup}/{period.text}")
        if store is not None:
            keep_period(snapshot, KeptStore(spark, store))
    return spark.read.parquet(f"{out}/missing_coordinates")


def published_output(spark: SparkSession, folder: str, period: Period, name: str) -> DataFrame:
    """A result of the newest whole report of a period, as it was written."""
    versions = manifests.versions(spark, f"{folder}/{period.text}")
    if not versions:
        raise FileNotFoundError(f"No report of {period.text} is published in {folder}")
    newest = versions[-1]
    if name not in newest["tables"]:
        raise FileNotFoundError(f"The report of {period.text} has no {name}")
    fmt = "parquet" if name == "missing_coordinates" else "text" if name.endswith(".md") else newest["format"]
    return spark.read.options(header=True, nullValue="NA").format(fmt).load(f"{newest['path']}/{name}")
