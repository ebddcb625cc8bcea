"""Rollup results against plain loops over the same rows."""

import datetime as dt
import random
from collections import defaultdict
from dataclasses import replace

import pytest

from conftest import rows
from hazeline.functions.periods import period_bounds
from hazeline.operators import prepare, rankings, summaries
from hazeline.operators.rollup import complete_rollup, monthly_rollup
from hazeline.params import DEFAULTS, FREQUENCY_LABELS

SCHEMA = (
    "location_id string, city_id string, city_name string, gadm1_id string, gadm1_name string, "
    "pollutant string, pollutant_name string, date date, value double"
)
PERIOD = period_bounds("2024-H1")
GROUPS = [("ncap_cities", "l1"), ("ncap_cities", "l3"), ("igp_cities", "l2")]


def series(id, first, days, values, region="R"):
    return [
        (id, id, f"City {id}", region, f"Region {region}", "pm25", "PM2.5",
         first + dt.timedelta(days=i), values(i))
        for i in days
    ]


@pytest.fixture(scope="module")
def data():
    draw = random.Random(5)
    out = []
    for year in (2022, 2023, 2024):
        start = dt.date(year, 1, 1)
        for i in range(6):
            # l0 holds most rows of the current year; l5 is there on few days.
            days = [d for d in range(181) if draw.random() < (0.3 if i == 5 else 0.9)]
            if year == 2022 and i == 4:
                continue
            out += series(f"l{i}", start, days, lambda _: round(draw.expovariate(1 / 70), 1), i % 2)
    out += series("l0", dt.date(2024, 1, 1), [0, 0, 0], lambda _: 0.0, 0)
    out += series("l1", dt.date(2024, 1, 1), [5], lambda _: 2000.0, 1)
    return out


@pytest.fixture(scope="module")
def rollup(frame, data):
    r = monthly_rollup(frame(data, SCHEMA))
    return complete_rollup(r, PERIOD.day_threshold(0.8)).persist()


def kept(data):
    days = defaultdict(set)
    for row in data:
        days[row[1], row[7].year].add(row[7])
    return [r for r in data if len(days[r[1], r[7].year]) >= 0.8 * PERIOD.days]


def by(data, *at):
    out = defaultdict(list)
    for row in data:
        out[tuple(a(row) for a in at)].append(row[8])
    return out


def year(r):
    return r[7].year


def loc(r):
    return r[0]


def test_incomplete_years_are_dropped(rollup, data):
    found = {tuple(r) for r in rollup.select("location_id", "year").distinct().collect()}
    wanted = {(r[0], r[7].year) for r in kept(data)}
    assert found == wanted and not any(id == "l5" for id, _ in found)


def test_means_and_flags(frame, rollup, data):
    groups = frame(GROUPS, "name string, location_id string")
    found = summaries.entity_year_summary(rollup, groups).collect()
    values = by(kept(data), loc, year)
    assert len(found) == len(values)
    for r in found:
        v = values[r["location_id"], r["year"]]
        mean = sum(v) / len(v)
        assert r["mean"] == pytest.approx(mean, abs=1e-8)
        assert (r["pass_who"], r["pass_naaqs"], r["pass_naaqs2"]) == (
            mean <= 15, mean <= 60, mean <= 120,
        )
        assert r["name"] == ("ncap_cities" if r["location_id"] in ("l1", "l3") else "non_ncap_cities")


def test_band_days(rollup, data):
    found = {(r["location_id"], r["year"]): r for r in summaries.band_days_by_year(rollup).collect()}
    for key, v in by(kept(data), loc, year).items():
        r = found[key]
        assert r["good"] == sum(0 < x <= 30 for x in v)
        assert r["very_poor"] == sum(120 < x <= 250 for x in v)
        assert r["severe"] == sum(250 < x <= 1500 for x in v)
        assert r["unbanded"] == sum(x == 0 or x > 1500 for x in v)
        assert r["monitored_days"] == sum(0 < x <= 250 for x in v)
    severe = summaries.band_days_by_year(rollup, replace(DEFAULTS, include_severe=True)).collect()
    for r in severe:
        assert r["monitored_days"] == sum(r[c] for c in (
            "good", "satisfactory", "moderate", "poor", "very_poor", "severe"))


def test_every_year_for_every_entity(rollup, data):
    previous = rollup.where("year < 2024")
    found = rows(summaries.exceedance_pct_by_year(previous), "location_id", "year", "not_pass_naaqs", "exceedance_pct")
    values = by([r for r in kept(data) if year(r) < 2024], loc, year)
    ids, years = {k[0] for k in values}, {k[1] for k in values}
    assert len(found) == len(ids) * len(years)
    for id, y, over, pct in found:
        v = values.get((id, y), [])
        assert over == sum(x > 60 for x in v)
        assert pct == (round(over / len(v) * 100) if v else None)
    assert ("l4", 2022, 0, None) in found


def test_histogram_has_every_bin(frame, rollup):
    groups = frame(GROUPS, "name string, location_id string")
    current = rollup.where("year = 2024")
    compliance = summaries.entity_compliance(current, groups)
    frequency = summaries.exceedance_frequency(compliance, PERIOD.days)
    found = rows(summaries.frequency_histogram(frequency, "naaqs_bin"), "name", "naaqs_bin", "value")
    assert len(found) == 2 * len(FREQUENCY_LABELS)
    assert sum(v for _, _, v in found) == compliance.count()


def test_previous_periods_keep_the_focus_threshold(frame):
    february = period_bounds("2024-02")
    threshold = february.day_threshold(0.8)
    data = series("a", dt.date(2023, 2, 1), range(24), lambda _: 1.0) + series(
        "b", dt.date(2023, 2, 1), range(23), lambda _: 1.0
    ) + series("a", dt.date(2023, 3, 1), range(5), lambda _: 1.0) + series(
        "a", dt.date(2024, 2, 1), range(29), lambda _: 1.0)
    found = prepare.previous_periods(frame(data, SCHEMA), february, threshold)
    assert {tuple(r) for r in found.select("location_id", "year", "month").collect()} == {("a", 2023, 2)}
    assert found.count() == 24


def test_missing_values_count_as_days(frame):
    data = series("a", dt.date(2024, 2, 1), range(29), lambda _: None)
    m = frame(data, SCHEMA)
    assert prepare.complete_entities(m, 29).count() == 29
    r = monthly_rollup(m).collect()[0]
    assert (r["total"], r["value_n"], r["value_sum"], r["pass_who"]) == (29, 0, None, 0)


def test_repeated_days_count_once(frame):
    data = series("a", dt.date(2024, 2, 1), [0, 0, 1, 1, 1], lambda _: 1.0)
    assert rows(prepare.distinct_days(frame(data, SCHEMA), ["city_id"])) == [("a", 2)]


def test_missing_keys_match(frame):
    left = frame([(None, 1), ("a", 2), ("b", 3)], "location_id string, v int")
    keys = frame([(None,), ("a",)], "location_id string")
    assert sorted(r[0] for r in rows(prepare.keep_keys(left, keys, ["location_id"]), "v")) == [1, 2]


def test_tracked_entities(rollup):
    now, before = rollup.where("year = 2024"), rollup.where("year < 2024")
    found = rankings.tracked_entities_all_years(now, before, ["l4", "l1"]).collect()
    assert sorted((r["location_id"], r["year"]) for r in found if r["year"]) == [
        ("l1", 2022), ("l1", 2023), ("l4", 2023),
    ]
    assert sorted(r["location_id"] for r in found if r["year"] is None) == ["l1", "l4"]
    assert all((r["not_pass_naaqs"] is None) == (r["year"] is None) for r in found)


def test_hot_entity_does_not_change_results(frame):
    """One entity with most rows of the table, spread over many tasks."""
    hot = series("hot", dt.date(2024, 1, 1), [d % 29 for d in range(9000)], lambda i: float(i % 90))
    cold = series("cold", dt.date(2024, 1, 1), range(28), lambda i: float(i))
    r = monthly_rollup(frame(hot + cold, SCHEMA).repartition(16)).orderBy("location_id").collect()
    assert [x["total"] for x in r] == [28, 9000]
    assert [bin(x["days_mask"]).count("1") for x in r] == [28, 29]
    assert r[1]["value_sum"] == sum(float(d % 29 % 90) for d in range(9000))
