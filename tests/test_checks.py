import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hazeline.operators import checks
from hazeline.operators.prepare import month_counts
from hazeline.operators.rollup import monthly_rollup
from hazeline.params import DEFAULTS

M = (
    "location_id string, city_id string, city_name string, gadm1_id string, gadm1_name string, "
    "pollutant string, pollutant_name string, date date, value double"
)


def day(id, d, value, region="IND.1_1", month=1):
    return (id, id, id.title(), region, region, "pm25", "PM2.5", dt.date(2024, month, d), value)


def test_missing_columns_are_named(frame):
    df = frame([(1,)], "a int")
    assert checks.require_columns(df, ["a"]) is df
    with pytest.raises(checks.DataCheckError, match="Columns missing in data: b, c"):
        checks.require_columns(df, ["a", "b", "c"])


def test_failed_rules_are_reported(frame):
    df = frame([("observed", 1.0), ("other", 2.0), (None, 3.0)], "variable string, value double")
    report = checks.rule_report(df, {"observed": F.col("variable") == "observed"}, {"value": "double", "variable": "int"})
    assert {tuple(r) for r in rows(report)} == {
        ("value is double", 0, 0, 3, True), ("variable is int", 3, 0, 3, False), ("observed", 1, 1, 3, False),
    }


def test_limits(frame):
    r = monthly_rollup(frame([day("a", 1, 1.0), day("b", 1, 1.0), day("b", 2, 1.0)], M))
    groups = frame([("ncap_cities", "b"), ("ncap_cities", "z"), ("x", "a")], "name string, location_id string")
    params = replace(DEFAULTS, max_entities=1, max_group_entities=1)
    found = {x["check"]: (x["observed"], x["ok"]) for x in checks.limit_checks(r, groups, 3, params).collect()}
    assert found == {"entities": (2, False), "group_entities": (1, True), "days": (2, False)}


def test_high_season(frame):
    data = [day("a", 1, 250.0), day("b", 1, 150.0), day("c", 1, 100.0), day("a", 1, 900.0, month=6)]
    found = rows(checks.warn_high_season_mean(monthly_rollup(frame(data, M))))
    text = "City {} in 1 has an average PM2.5 concentration above {} µg/m³: {}"
    assert sorted(found) == [
        ("high_pm25_gt100", text.format("a", 100, 250)),
        ("high_pm25_gt100", text.format("b", 100, 150)),
        ("high_pm25_gt200", text.format("a", 200, 250)),
    ]


def test_unexpected_top_keeps_exactly_ten(frame):
    data = [day(f"c{i:02}", 1, 50.0, "IND.16_1" if i in (9, 10) else "IND.1_1") for i in range(12)]
    found = rows(checks.warn_unexpected_top(monthly_rollup(frame(data, M))))
    assert found == [("southern_city_in_top_10", "City C09 is in the top 10")]


def test_low_values(frame):
    data = [day("a", 1, 4.5), day("a", 2, 5.0), day("a", 3, 10.0), day("a", 4, None)]
    assert sorted(rows(checks.warn_low_values(frame(data, M)))) == [
        ("low_value_lt10", "City a on 2024-01-02 has a value between 5 and 10: 5"),
        ("low_value_lt5", "City a on 2024-01-01 has a value less than 5: 4.5"),
    ]


def test_duplicates_stop_and_are_all_written(spark, frame):
    data = [day(f"a{i:02}", 1, 1.0) for i in range(50) for _ in range(2)] + [day("b", 1, 1.0)]
    m = frame(data, M)
    found = checks.duplicate_entries(m, month_counts(m))
    with pytest.raises(checks.DataCheckError, match="Duplicate entries: first 20 of 50: a00, ") as error:
        checks.enforce(found, "Duplicate entries")
    assert error.value.findings.count() == 50
    folder = str(error.value).rsplit("all in ", 1)[1].rstrip(")")
    assert spark.read.parquet(folder).count() == 50
    checks.enforce(found.where("entries > 2"), "none")


def test_missing_columns_in_a_frame(frame):
    df = frame([(1, 2)], "a int, b int")
    assert rows(checks.missing_columns(df, ["b", "c", "d"])) == [("c",), ("d",)]
    assert rows(checks.missing_columns(df, ["a"])) == []


def test_log(spark, frame):
    empty = checks.empty_log(spark)
    assert empty.columns == ["type", "message"] and rows(empty) == []
    one = checks.warning(spark, "t1", "m1")
    extra = frame([("t2", "m2", "x"), ("t3", "m3", "y")], "type string, message string, extra string")
    log = checks.collect_warnings(empty, one, extra)
    assert log.columns == ["type", "message"]
    assert rows(log) == [("t1", "m1"), ("t2", "m2"), ("t3", "m3")]


def test_unknown_values_break_the_invariant(frame):
    df = frame([("a", True), ("a", None), ("b", False)], "k string, f boolean")
    flagged = df.select("k", *[F.col("f").alias(c) for c in ("pass_who", "pass_naaqs", "pass_naaqs2")])
    assert rows(checks.compliance_invariant(flagged, ["k"])) == [("a", 2, 1, 1, 1)]
    r = monthly_rollup(frame([day("a", 1, None), day("b", 1, 2.0)], M))
    assert [x[0] for x in rows(checks.broken_counts(r, ["location_id"]))] == ["a"]


def test_counts_are_reconciled(frame):
    stations, statuses = frame([("1",)], "id string"), frame([("1", "x"), ("2", "gone")], "id string, change string")
    assert rows(checks.reconcile_counts(stations, statuses)) == [(1, 2, False)]
    assert rows(checks.vanished_stations(stations, statuses)) == [("2", "gone")]


def test_region_coverage_and_many_to_one(frame):
    df = frame([("a", "R"), ("b", "R"), ("b", None)], "location_id string, gadm1_name string")
    assert rows(checks.warn_region_coverage(df, replace(DEFAULTS, expected_regions=3))) == [
        ("wrong_state_number", "Number of states in India in analysis was 2 less than 3")
    ]
    assert rows(checks.warn_region_coverage(df, replace(DEFAULTS, expected_regions=2))) == []
    assert rows(checks.many_to_one(df, "location_id")) == [("b", 2)]


def test_missing_dates_can_repeat(frame):
    rows_ = [("a", None), ("a", None), ("b", None), ("c", dt.date(2024, 1, 1))]
    m = frame(rows_, "location_id string, date date")
    assert rows(checks.duplicate_entries(m, month_counts(m))) == [("a", None, 2)]
