import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazeline.functions.periods import period_bounds
from hazeline.operators.checks import DataCheckError
from hazeline.operators.rollup import days_in_both, monthly_rollup, united_rollup
from hazeline.params import DEFAULTS, Params
from hazeline.plans.kept import KeptStore, earlier_periods
from hazeline.sources import landing, manifests

SCHEMA = (
    "location_id string, city_id string, city_name string, gadm1_id string, gadm1_name string, "
    "pollutant string, pollutant_name string, date date, value double"
)
JANUARY = period_bounds("2023-01")


def days_of(frame, values, city="c", year=2023, month=1):
    """A row per (day, value)."""
    return frame([(city, city, city, "r", "R", "pm25", "PM2.5", dt.date(year, month, d), v) for d, v in values], SCHEMA)


@pytest.fixture
def store(spark, tmp_path):
    return KeptStore(spark, str(tmp_path / "kept"))


def keep(store, days, period=JANUARY, tracked=("c",), params=DEFAULTS):
    return store.keep(period, monthly_rollup(days, params), days, list(tracked), params)


def values_of(df):
    return sorted((r["location_id"], r["date"].day, r["value"]) for r in df.collect())


def rollup_of(df):
    found = ((r["location_id"], r["value_sum"], r["value_n"], r["days_mask"].bit_count()) for r in df.collect())
    return sorted(found, key=str)


def test_a_period_is_read_back_as_it_was_kept(frame, store):
    days = days_of(frame, [(1, 10.0), (2, 20.0)]).union(days_of(frame, [(1, 5.0)], "d"))
    keep(store, days)
    assert rollup_of(store.rollup(["2023-01"])) == [("c", 30.0, 2, 2), ("d", 5.0, 1, 1)]
    assert values_of(store.tracked_days(["2023-01"], ["c"])) == [("c", 1, 10.0), ("c", 2, 20.0)]
    assert store.tracked_days(["2023-01"], ["c"]).columns == days.columns


def test_kept_again_replaces_all_that_was_kept(frame, store):
    keep(store, days_of(frame, [(1, 10.0)]).union(days_of(frame, [(1, 5.0)], "d")))
    keep(store, days_of(frame, [(3, 1.0)]))
    assert rollup_of(store.rollup(["2023-01"])) == [("c", 1.0, 1, 1)]


def test_corrected_months_are_replaced_and_others_stay(frame, store):
    keep(store, days_of(frame, [(1, 10.0), (2, 999.0)]).union(days_of(frame, [(1, 5.0)], "d")))
    right = days_of(frame, [(1, 10.0), (2, 20.0), (9, 30.0)])
    late = right.where("day(date) > 1")
    assert store.correct(right, late) == ["2023-01"]
    assert rollup_of(store.rollup(["2023-01"])) == [("c", 60.0, 3, 3), ("d", 5.0, 1, 1)]
    assert values_of(store.tracked_days(["2023-01"], ["c"])) == [("c", 1, 10.0), ("c", 2, 20.0), ("c", 9, 30.0)]
    # Once more, newer still; and a month that isn't kept is left alone.
    assert store.correct(days_of(frame, [(4, 7.0)]), days_of(frame, [(4, 7.0)])) == ["2023-01"]
    assert rollup_of(store.rollup(["2023-01"])) == [("c", 7.0, 1, 1), ("d", 5.0, 1, 1)]
    assert store.correct(right, days_of(frame, [(1, 1.0)], month=2)) == []


def test_a_corrected_month_may_lose_all_its_rows(frame, store):
    keep(store, days_of(frame, [(1, 10.0)]).union(days_of(frame, [(1, 5.0)], "d")))
    store.correct(days_of(frame, [(1, 5.0)], "d"), days_of(frame, [(1, 0.0)]))
    assert rollup_of(store.rollup(["2023-01"])) == [("d", 5.0, 1, 1)]


def test_late_days_are_added_and_kept_ones_refused(frame, store):
    keep(store, days_of(frame, [(1, 10.0), (2, 20.0)]))
    assert store.add(days_of(frame, [(3, 30.0)]).union(days_of(frame, [(4, 4.0)], "new"))) == ["2023-01"]
    assert rollup_of(store.rollup(["2023-01"])) == [("c", 60.0, 3, 3), ("new", 4.0, 1, 1)]
    assert values_of(store.tracked_days(["2023-01"], ["c"])) == [("c", 1, 10.0), ("c", 2, 20.0), ("c", 3, 30.0)]
    with pytest.raises(DataCheckError, match="kept already: first 1 of 1: c, 2023, 1, 1"):
        store.add(days_of(frame, [(3, 31.0), (5, 1.0)]))
    assert rollup_of(store.rollup(["2023-01"]))[0] == ("c", 60.0, 3, 3)


def test_a_null_location_and_null_values(frame, store):
    keep(store, days_of(frame, [(1, None), (2, 2.0)], None), tracked=[])
    store.add(days_of(frame, [(3, None)], None))
    assert rollup_of(store.rollup(["2023-01"])) == [(None, 2.0, 1, 3)]


def test_what_is_not_kept_is_refused(frame, store):
    keep(store, days_of(frame, [(1, 10.0)]))
    with pytest.raises(DataCheckError, match="not kept: 2021-01, 2022-01"):
        store.rollup(["2021-01", "2022-01", "2023-01"])
    with pytest.raises(DataCheckError, match="other parameters: 2023-01"):
        store.rollup(["2023-01"], Params(naaqs_limit=1))
    with pytest.raises(DataCheckError, match="not kept in 2023-01: first 1 of 1: x"):
        store.tracked_days(["2023-01"], ["c", "x"])
    assert earlier_periods(period_bounds("2024-H1"), 2) == ["2022-H1", "2023-H1"]


def test_united_rollups_equal_the_rollup_of_all(frame):
    a, b = days_of(frame, [(1, 10.0), (2, 70.0)]), days_of(frame, [(3, 130.0), (4, None)])
    whole = monthly_rollup(a.union(b))
    assert united_rollup(monthly_rollup(a), monthly_rollup(b)).select(*whole.columns).collect() == whole.collect()
    assert days_in_both(monthly_rollup(a), monthly_rollup(b)).collect() == []


def test_a_version_that_dies_halfway_is_not_seen(spark, frame, tmp_path):
    folder = str(tmp_path / "p")
    good = frame([(1,)], "a int")
    manifests.publish_tables(spark, folder, {"x": good, "y": good})
    broken = good.select(F.raise_error(F.lit("dies")).cast("int").alias("a"))
    with pytest.raises(Exception, match="dies"):
        manifests.publish_tables(spark, folder, {"x": frame([(2,)], "a int"), "y": broken})
    assert [v["number"] for v in manifests.versions(spark, folder)] == [1]
    assert manifests.published(spark, folder, "x").collect() == [(1,)]
    manifests.publish_tables(spark, folder, {"x": frame([(3,)], "a int")})
    assert manifests.published(spark, folder, "x").collect() == [(3,)] and manifests.published(spark, folder, "y").collect() == [(1,)]
    with pytest.raises(FileNotFoundError):
        manifests.published(spark, folder, "z")


FILES = "period string, file string, a int, b string"


def landed(spark, folder):
    rows = landing.landed_rows(spark, folder).select("period", "file", "a", "b").collect()
    return sorted(map(tuple, rows), key=str)


def test_landing_twice_equals_landing_once(spark, frame, tmp_path):
    folder = str(tmp_path / "l")
    rows = [("2024-01", "f1", 1, "x"), ("2024-01", "f1", 1, "x"), ("2024-01", "f2", None, None), ("2024-02", "f1", 3, "z")]
    assert landing.land(frame(rows, FILES), folder).count() == 3
    once = landed(spark, folder)
    assert once == sorted(rows, key=str)
    assert landing.land(frame(rows[::-1], FILES).repartition(3), folder).count() == 0
    assert landed(spark, folder) == once
    changed = [("2024-01", "f1", 7, "new")]
    assert landing.land(frame(changed, FILES), folder).count() == 1
    assert landed(spark, folder) == sorted(changed + rows[2:], key=str)
    numbers = {(r["period"], r["file"]): (r["rows"], r["number"]) for r in landing.landed_files(spark, folder).collect()}
    assert numbers == {("2024-01", "f1"): (1, 2), ("2024-01", "f2"): (1, 1), ("2024-02", "f1"): (1, 1)}


def test_a_landing_without_rows(spark, frame, tmp_path):
    folder = str(tmp_path / "l")
    assert landing.land(frame([], FILES), folder).count() == 0 and landing.landed_files(spark, folder) is None


def test_a_landing_that_died_before_its_list_is_made_good(spark, frame, tmp_path):
    folder = str(tmp_path / "l")
    rows = frame([("2024-01", "f1", 1, "x")], FILES)
    rows.write.partitionBy("period", "file").parquet(f"{folder}/rows")
    assert landing.land(rows, folder).count() == 1 and landed(spark, folder) == [("2024-01", "f1", 1, "x")]
