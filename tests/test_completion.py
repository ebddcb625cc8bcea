import datetime as dt

from conftest import rows
from hazeline.operators import completion

M = (
    "location_id string, city_name string, gadm1_name string, gadm1_id string, date date, "
    "file_name string"
)


def days(id, first, n, file, city=None):
    return [
        (id, city or id.upper(), "R", "r", first + dt.timedelta(days=i), file) for i in range(n)
    ]


JAN, FEB, APR = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 4, 1)


def data():
    return (
        days("a", JAN, 31, "jan") + days("a", FEB, 29, "feb")
        + days("b", JAN, 10, "jan") * 2 + days("b", APR, 30, "apr", "B2")
        + days("c", FEB, 29, "feb")
    )


def test_observed(frame):
    found = rows(
        completion.observed_completion(frame(data(), M)),
        "location_id", "snapshot_month", "days_with_data", "days_in_month",
    )
    assert sorted(found) == [
        ("a", "2024-01", 31, 31), ("a", "2024-02", 29, 29), ("b", "2024-01", 10, 31),
        ("b", "2024-04", 30, 30), ("c", "2024-02", 29, 29),
    ]


def test_long_files_count_against_their_first_month(frame):
    df = frame(days("a", JAN, 60, "half") + days("b", FEB, 29, "half"), M)
    found = {r["location_id"]: r for r in completion.observed_completion(df).collect()}
    assert found["a"]["percent_days"] == 60 / 31
    assert (found["b"]["month"], found["b"]["percent_days"]) == (JAN, 29 / 31)


HALF = "measurements_2024-01-01_2024-06-30.csv"


def test_files_named_for_several_months_count_by_month(frame):
    df = frame(days("a", JAN, 60, HALF) + days("b", FEB, 29, HALF) + days("a", JAN, 31, "measurements_2024-01-01_2024-01-31.csv"), M)
    found = sorted(rows(completion.observed_completion(df), "location_id", "snapshot_month", "days_with_data", "percent_days"))
    months = [f"2024-0{m}" for m in range(1, 7)]
    a = dict(zip(months, (31, 29, 0, 0, 0, 0)))
    b = dict(zip(months, (0, 29, 0, 0, 0, 0)))
    length = dict(zip(months, (31, 29, 31, 30, 31, 30)))
    expected = [("a", m, n, n / length[m]) for m, n in a.items()] + [("b", m, n, n / length[m]) for m, n in b.items()]
    assert found == sorted(expected + [("a", "2024-01", 31, 1.0)])


def test_days_outside_a_named_period_keep_their_own_month(frame):
    df = frame(days("a", dt.date(2024, 7, 1), 5, HALF), M)
    found = {r["snapshot_month"]: r["days_with_data"] for r in completion.observed_completion(df).collect()}
    assert found == {f"2024-0{m}": 0 for m in range(1, 7)} | {"2024-07": 5}


def test_no_files(frame):
    observed = completion.observed_completion(frame([], M))
    assert rows(completion.completion_grid(observed)) == []


def test_grid_is_full(frame):
    observed = completion.observed_completion(frame(data(), M))
    grid = completion.completion_grid(observed)
    found = {(r["location_id"], r["snapshot_month"]): r for r in grid.collect()}
    assert len(found) == 9
    assert found["a", "2024-04"]["days_with_data"] == 0
    assert found["a", "2024-04"]["days_in_month"] == 30
    # The oldest month names a place throughout.
    assert {found["b", m]["city_name"] for m in ("2024-01", "2024-02", "2024-04")} == {"B"}


def test_order_summary_and_threshold(frame):
    grid = completion.completion_grid(completion.observed_completion(frame(data(), M)))
    order = completion.completion_order(grid)
    assert [r["location_id"] for r in order.collect()] == ["c", "b", "a"]
    summary = {r["snapshot_month"]: r for r in completion.completion_summary(grid).collect()}
    january = summary["2024-01"]
    assert (january["total_locations"], january["locations_with_any_data"]) == (3, 2)
    assert (january["locations_with_80_percent_data"], january["median_percent_days"]) == (1, 10 / 31)
    under = completion.under_threshold_entities(order)
    assert rows(under, "location_label") == [("C, R",), ("B, R",), ("A, R",)]
    low = completion.under_threshold_grid(grid, under)
    assert low.count() == 9
    assert [r["location_id"] for r in completion.under_threshold_order(low).collect()] == ["c", "b", "a"]


def test_mean_exactly_at_the_threshold_is_under(frame):
    """Three months of 24 of 30 days: their plain mean would be just above 0.8."""
    data = [
        row for month, file in ((4, "apr"), (6, "jun"), (9, "sep"))
        for row in days("a", dt.date(2024, month, 1), 24, file)
    ]
    grid = completion.completion_grid(completion.observed_completion(frame(data, M)))
    under = completion.under_threshold_entities(completion.completion_order(grid))
    assert rows(under, "location_id", "mean_percent_days") == [("a", 0.8)]
