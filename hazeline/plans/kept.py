"""The kept store: what reports keep of their periods for the reports of later years.

A version per report holds the period's monthly rollup, the daily rows of the tracked entities,
their ids, and the entity months it speaks for; its manifest has the period and the parameters.
A correction is one more version that speaks for some entity months: of every entity month only
the newest version counts, for sums, masks and days alike. Versions are published whole (see
``sources.manifests``), so a report that dies keeps nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.periods import Period, period_bounds
from hazeline.operators import checks
from hazeline.operators.prepare import filter_period, keep_keys, with_year_month
from hazeline.operators.rollup import (
    KEYS, MADE_WITH, days_in_both, monthly_rollup, rollup_mark, rollup_to_keep, united_rollup,
)
from hazeline.params import DEFAULTS, Params
from hazeline.plans.staging import stage
from hazeline.sources import manifests

MONTH = ["location_id", "year", "month"]
VERSION = "_version"


def _ids(spark: SparkSession, ids: Iterable[str] | DataFrame) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select("location_id").distinct()
    return spark.createDataFrame([(i,) for i in dict.fromkeys(ids)], "location_id string")


class KeptStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    # --- writing ---

    def keep(
        self, period: Period, rollup: DataFrame, days: DataFrame,
        tracked: Iterable[str] | DataFrame, params: Params = DEFAULTS,
    ) -> dict:
        """Keep a period: its own rollup and, out of its days, those of the tracked entities.

        A period that is kept again replaces all that was kept of it.
        """
        ids = stage(_ids(self.spark, tracked), "tracked-ids")
        return self._publish(period, rollup, days, ids, None, params)

    def _publish(self, period, rollup, days, ids, months, params) -> dict:
        rows = keep_keys(with_year_month(filter_period(days, period)), ids, ["location_id"])
        tables = {"rollup": rollup_to_keep(rollup, params), "days": rows, "ids": ids}
        if months is not None:
            tables["months"] = months
        about = {"period": period.text, "whole": months is None, MADE_WITH: rollup_mark(params)}
        return manifests.publish_tables(self.spark, self.folder, tables, about)

    def correct(self, days: DataFrame, late: DataFrame, params: Params = DEFAULTS) -> list[str]:
        """Make the entity months of late or corrected rows anew, out of all their days.

        ``days`` has every right row of these months, ``late`` at least the location_id and date
        of the rows that came late. Months of periods that aren't kept are left alone. Returns
        the periods that got a new version.
        """
        months = stage(with_year_month(late).select(*MONTH).distinct(), "late-months")
        done = []
        for period, touched in self._touched(months):
            rows = keep_keys(with_year_month(filter_period(days, period)), touched, MONTH)
            rows = stage(rows, "corrected")
            ids = self._read(self._of(period.text)[-1], "ids")
            rollup = monthly_rollup(rows.drop("year", "month"), params)
            self._publish(period, rollup, rows.drop("year", "month"), ids, touched, params)
            done.append(period.text)
        return done

    def add(self, late: DataFrame, params: Params = DEFAULTS) -> list[str]:
        """Add late days to kept months whose other days are gone: sums add up, masks unite.

        A day that is kept already can't be told from its correction, so such rows are an error;
        ``correct`` is the way for them.
        """
        late = stage(late, "late")
        months = stage(with_year_month(late).select(*MONTH).distinct(), "late-months")
        work = []
        for period, touched in self._touched(months):
            rows = filter_period(late, period)
            old = keep_keys(self.rollup([period.text], params).drop(MADE_WITH), touched, MONTH)
            old, new = stage(old, "old-months"), stage(monthly_rollup(rows, params), "new-months")
            checks.enforce(days_in_both(old, new), "Late days that are kept already")
            work.append((period, touched, rows, old, new))
        for period, touched, rows, old, new in work:
            ids = self._read(self._of(period.text)[-1], "ids")
            before = keep_keys(self._newest([period.text], "days"), touched, MONTH).drop("year", "month")
            days = before.unionByName(rows.select(*before.columns))
            self._publish(period, united_rollup(old, new), days, ids, touched, params)
        return [period.text for period, *_ in work]

    # --- reading ---

    def periods(self) -> list[str]:
        return sorted({v["period"] for v in manifests.versions(self.spark, self.folder)})

    def _of(self, period: str) -> list[dict]:
        """A period's versions that count, oldest first: the last whole one and its corrections."""
        found = [v for v in manifests.versions(self.spark, self.folder) if v["period"] == period]
        last = max((i for i, v in enumerate(found) if v["whole"]), default=len(found))
        return found[last:]

    def _touched(self, months: DataFrame):
        """Kept periods with the late months in them."""
        seen = {tuple(r) for r in months.select("year", "month").distinct().collect()}
        for text in self.periods():
            period = period_bounds(text)
            own = {(y, m) for y, m in seen if y == period.year and period.start.month <= m <= period.end.month}
            if own:
                inside = F.col("year").eqNullSafe(period.year) & F.col("month").between(
                    period.start.month, period.end.month
                )
                yield period, months.where(inside)

    def _read(self, version: dict, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{version['path']}/{name}")

    def _kept(self, periods: list[str]) -> list[dict]:
        found = {p: self._of(p) for p in periods}
        absent = [p for p, versions in found.items() if not versions]
        if absent:
            raise checks.DataCheckError(f"Periods that were not kept: {', '.join(absent)}")
        return [v for versions in found.values() for v in versions]

    def _newest(self, periods: list[str], name: str) -> DataFrame:
        """Rows of a table, each entity month out of the newest version that speaks for it."""
        kept = self._kept(periods)
        whole = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True),
            [self._read(v, name).withColumn(VERSION, F.lit(v["number"])) for v in kept],
        )
        spoken = [self._read(v, "months").withColumn("_newest", F.lit(v["number"])) for v in kept if not v["whole"]]
        if not spoken:
            return whole.drop(VERSION)
        newest = reduce(DataFrame.unionByName, spoken).groupBy(*MONTH).agg(F.max("_newest").alias("_newest"))
        newest = newest.withColumnsRenamed({c: f"_{c}" for c in MONTH})
        same = reduce(lambda a, b: a & b, [whole[c].eqNullSafe(newest[f"_{c}"]) for c in MONTH])
        rows = whole.join(newest, same, "left")
        return rows.where(F.col("_newest").isNull() | (F.col(VERSION) >= F.col("_newest"))).select(
            *[c for c in whole.columns if c != VERSION]
        )

    def rollup(self, periods: list[str], params: Params = DEFAULTS) -> DataFrame:
        """The rollups of kept periods; refused if one was made with other parameters."""
        foreign = sorted({v["period"] for v in self._kept(periods) if v[MADE_WITH] != rollup_mark(params)})
        if foreign:
            raise checks.DataCheckError(f"Periods kept with other parameters: {', '.join(foreign)}")
        return self._newest(periods, "rollup")

    def tracked_days(self, periods: list[str], tracked: Iterable[str] | DataFrame) -> DataFrame:
        """Daily rows of tracked entities in kept periods; refused if one's were not kept."""
        ids = stage(_ids(self.spark, tracked), "tracked-ids")
        for period in periods:
            kept = self._read(self._kept([period])[-1], "ids")
            checks.enforce(
                ids.join(kept, "location_id", "left_anti"), f"Entities whose days were not kept in {period}"
            )
        return keep_keys(self._newest(periods, "days"), ids, ["location_id"]).drop("year", "month")


def earlier_periods(period: Period, years: int) -> list[str]:
    """The same period in each of the years before, as text."""
    return [f"{year}{period.text[4:]}" for year in range(period.year - years, period.year)]
