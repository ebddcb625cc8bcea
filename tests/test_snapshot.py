"""A whole report from landed files to written results."""

import datetime as dt
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hazeline import Inputs, Params, Snapshot, build_snapshot, period_bounds
from hazeline.operators.checks import DataCheckError
from hazeline.operators.rollup import monthly_rollup, rollup_to_keep
from hazeline.plans.kept import KeptStore
from hazeline.plans.snapshot import keep_period, published_output
from hazeline.plans.staging import staging_folder
from hazeline.sources import manifests, readers

PERIOD = period_bounds("2024-01")
CITIES = ["Delhi", "Mumbai", "Kolkata", "Bilaspur", "Bilaspur", "Agra"]
STATES = ["Delhi", "Maharashtra", "West Bengal", "Chhattisgarh", "Himachal Pradesh", "Uttar Pradesh"]
IDS = ["delhi", "mumbai", "kolkata", "bilaspur_7", "bilaspur_14", "agra"]
PARAMS = Params(expected_regions=7, top_n=3)


def measurement(level, id, city, state, date, value):
    return (
        date, f"{level}_day_mad", id, "observed", value, "µg/m3", "cpcb", "pm25", "PM2.5", "IN",
        level, id.removeprefix("st_"), city, state, f"g_{state}",
    )


def city_rows():
    out = []
    for year in (2022, 2023, 2024):
        for i, (id, city, state) in enumerate(zip(IDS, CITIES, STATES)):
            # Agra lacks days in 2023.
            days = 20 if (id, year) == ("agra", 2023) else 31
            for d in range(days):
                value = 20.0 * (i + 1) + d % 5 + (year - 2022)
                out.append(measurement("city", id, city, state, dt.date(year, 1, 1) + dt.timedelta(days=d), value))
    return out


def stations(month):
    out = []
    for i, (id, city) in enumerate(zip(IDS, CITIES)):
        if month == "2023-12" and id in ("agra", "kolkata"):
            continue
        state = "None" if id == "mumbai" else "'Live'"
        infos = f"{{'latest_data': '2024-01-31', 'status': {state}}}"
        out.append((f"st_{id}", f"Station {city} {i}", id, city, infos, "cpcb", "IN", "station"))
    return out


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landed"))

    def save(rows, schema, name, *by, **extra):
        df = spark.createDataFrame(rows, schema).withColumns({k: F.lit(v) for k, v in extra.items()})
        df.write.mode("append").partitionBy(*by).parquet(f"{folder}/{name}")

    save(city_rows(), readers.MEASUREMENTS, "measurements")
    station_rows = [
        measurement("station", f"st_{id}", city, state, dt.date(2024, 1, 1) + dt.timedelta(days=d), 50.0)
        for i, (id, city, state) in enumerate(zip(IDS, CITIES, STATES)) for d in range(31 - 3 * i)
    ]
    save(station_rows, readers.MEASUREMENTS, "station_measurements")
    for month in ("2023-12", "2024-01"):
        save(stations(month), readers.STATIONS, "stations", "snapshot_month", snapshot_month=month)
    save([("ncap_cities", "delhi"), ("ncap_cities", "agra"), ("igp_cities", "agra")], readers.GROUPS, "location_presets")
    save(
        [(id, c, "g", "IN", "city", None if id == "mumbai" else 77.0, 20.0) for id, c in zip(IDS, CITIES)],
        readers.CITIES, "cities",
    )
    for name, text in {
        "overshooting/overshooting-delhi.json": '{"data": [{"date": "2024-01-03", "location_id": "delhi",'
        ' "target_id": "ae5e689a-863c-11ef-b57b-e6cf434e9f43", "is_overshoot": true, "is_overshoot_estimated": false}]}',
        "period_files/2024-01/measurements_2024-01-01_2024-01-31.csv":
        ",".join(readers.MEASUREMENTS.fieldNames()) + "\n" + "\n".join(
            ",".join(str(v) for v in r) for r in city_rows() if r[0].year == 2024),
    }.items():
        path = Path(folder) / name
        path.parent.mkdir(parents=True)
        path.write_text(text)
    return folder


@pytest.fixture(scope="module")
def inputs(spark, landed):
    return Inputs.landed(spark, landed, PERIOD, PARAMS)


@pytest.fixture(scope="module")
def written(spark, inputs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("out"))
    missing = build_snapshot(inputs, PERIOD, folder, PARAMS, tracked=["delhi", "agra"])
    assert rows(missing, "location_id") == [("mumbai",)]
    return lambda name: spark.read.csv(f"{folder}/2024-01/{name}", header=True)


def test_top_and_bottom(written):
    top = written("top10_polluted_cities")
    assert top.columns == [
        "location_id", "city_name", "State/UT", "monitored_days", "mean", "% days > NAAQS",
        "Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe",
    ]
    assert {r[0] for r in rows(top, "location_id")} == {"agra", "bilaspur_14", "bilaspur_7"}
    assert {r[0] for r in rows(written("top10_cleanest_cities"), "location_id")} == {"delhi", "mumbai", "kolkata"}
    # Agra had too few days the year before.
    assert {r[0] for r in rows(written("top10_polluted_cities_prev"), "location_id")} == {"bilaspur_14", "bilaspur_7"}


def test_ranking_is_numbered(written):
    found = sorted((int(n), c) for n, c in rows(written("all_cities_ordered"), "row_number", "city_name"))
    assert found == list(enumerate(["Agra", "Bilaspur", "Bilaspur", "Kolkata", "Mumbai", "Delhi"], start=1))


def test_compliance_and_bands(written):
    found = {r["name"]: r for r in written("monthly_compliance").collect()}
    assert (found["ncap_cities"]["total"], found["non_ncap_cities"]["total"]) == ("2", "4")
    bands = {r["State/UT"]: r for r in written("cities_grap_distribution").collect()}
    assert len(bands) == 6 and bands["Delhi"]["Good"] == "1" and bands["Uttar Pradesh"]["Very Poor"] == "1"


def test_tracked_years(written):
    found = {(r["location_id"], r["year"]) for r in written("top5_populous_cities").collect()}
    assert found == {
        ("delhi", "NA"), ("delhi", "2022"), ("delhi", "2023"), ("agra", "NA"), ("agra", "2022"),
    }


def test_statuses_and_report(spark, written, inputs):
    found = dict(rows(written("statuses"), "id", "change"))
    assert found == {
        "st_delhi": "No change", "st_mumbai": "Removed in a previous month", "st_kolkata": "New",
        "st_bilaspur_7": "No change", "st_bilaspur_14": "No change", "st_agra": "New",
    }
    text = "\n".join(r["line"] for r in Snapshot(inputs, PERIOD, PARAMS).report_text().collect())
    assert "- New stations: Station Agra 5\n- New stations: Station Kolkata 2\n" in text
    assert "- Cities with new stations: Agra\n" in text and "- Cities with new stations: Kolkata\n*Please inform" in text


def test_log_and_overshoots(written):
    kinds = {r[0] for r in rows(written("warnings"), "type")}
    assert kinds == {"high_pm25_gt100", "new_cities", "wrong_state_number"}
    assert rows(written("overshooting"), "target_id") == [("India PM2.5 (yearly)",)]


def test_diagnostics(written):
    assert written("measurement_completion_monthly").count() == 6
    assert rows(written("measurement_completion_monthly_summary"), "locations_with_80_percent_data") == [("6",)]
    assert written("measurement_completion_period_under_80").count() == 0


def test_chart_tables(inputs):
    tables = Snapshot(inputs, PERIOD, PARAMS, tracked=["delhi", "agra"]).chart_tables()
    labels = rows(tables["top10_frequency"], "city_label", "count")
    assert labels[0] == ("Agra", 31) and ("Bilaspur, CG", 31) in labels
    assert {r[0] for r in rows(tables["state_capitals"], "city_name")} == {"Delhi", "Mumbai", "Kolkata"}
    assert rows(tables["plain_cities"], "label") == [("Agra,\nUttar Pradesh*",)]
    assert tables["map_points"].count() == 5 and tables["plain_map_points"].count() == 1
    years = {(r["location_id"], r["year"]) for r in tables["calendar"].select("location_id", "year").distinct().collect()}
    assert years == {(city, y) for city in ("delhi", "agra") for y in (2022, 2023, 2024)}
    # Agra's incomplete year is shown empty.
    gap = tables["calendar"].where("location_id = 'agra' AND year = 2023")
    assert gap.count() == 31 and gap.where("value IS NOT NULL").count() == 0
    assert tables["top10_year_on_year"].count() == 5
    assert {r["centre"] for r in tables["compliance_naaqs"].collect()} == {2, 4}
    assert tables["compliance_who"].count() == 12 and tables["top10_labels"].count() == 3
    assert tables["top_city_per_region"].count() == 6


def kept_inputs(inputs, params=PARAMS, **more):
    """The same with the earlier years in a kept rollup alone."""
    kept = rollup_to_keep(monthly_rollup(inputs.measurements.where("date < '2024-01-01'"), params), params)
    only_now = inputs.measurements.where("date >= '2024-01-01'")
    return replace(inputs, measurements=only_now, earlier_rollup=kept, **more)


def test_a_kept_rollup_stands_in_for_earlier_years(inputs):
    whole = Snapshot(inputs, PERIOD, PARAMS, tracked=["delhi", "agra"])
    earlier = inputs.measurements.where("date < '2024-01-01' AND location_id IN ('delhi', 'agra')")
    other = Snapshot(kept_inputs(inputs, earlier_tracked=earlier), PERIOD, PARAMS, tracked=["delhi", "agra"])
    assert sorted(map(tuple, other.rollup.collect())) == sorted(map(tuple, whole.rollup.collect()))
    assert sorted(map(tuple, other.tracked_series().collect())) == sorted(map(tuple, whole.tracked_series().collect()))


def test_a_calendar_without_its_earlier_days_is_refused(inputs):
    with pytest.raises(DataCheckError, match="earlier days"):
        Snapshot(kept_inputs(inputs), PERIOD, PARAMS).chart_tables()


def test_a_rollup_made_with_other_parameters_is_refused(inputs):
    other = kept_inputs(inputs, replace(PARAMS, naaqs_limit=1))
    with pytest.raises(DataCheckError, match="other parameters: first 1 of 1"):
        Snapshot(other, PERIOD, PARAMS).rollup
    unmarked = replace(other, earlier_rollup=other.earlier_rollup.drop("made_with"))
    with pytest.raises(DataCheckError, match="other parameters"):
        Snapshot(unmarked, PERIOD, PARAMS).rollup
    kept = kept_inputs(inputs)
    twice = replace(kept, earlier_rollup=kept.earlier_rollup.unionByName(kept.earlier_rollup))
    with pytest.raises(DataCheckError, match="more than once in the kept rollup"):
        Snapshot(twice, PERIOD, PARAMS).rollup


def test_rules_see_the_landed_rows_before_any_filter(spark, inputs):
    report = {(r["table"], r["rule"]): r for r in Snapshot(inputs, PERIOD, PARAMS).rule_reports().collect()}
    assert {t for t, _ in report} == {
        "measurements", "station_measurements", "stations", "stations_previous", "location_presets", "cities",
    }
    assert all(r["ok"] for r in report.values())
    landed = dict(inputs.landed_rows)
    landed["measurements"] = landed["measurements"].withColumns(
        {
            "source": F.when(F.col("location_id") == "delhi", "other").otherwise(F.col("source")),
            "unit": F.when(F.col("location_id") != "agra", F.col("unit")),
        }
    )
    broken = replace(inputs, landed_rows=landed)
    found = {r["rule"]: r for r in Snapshot(broken, PERIOD, PARAMS).rule_reports().where("table = 'measurements'").collect()}
    assert found["source = cpcb"]["failed_rows"] == 93 and not found["source = cpcb"]["ok"]
    assert (found["unit = µg/m3"]["failed_rows"], found["unit = µg/m3"]["unknown_rows"]) == (0, 82)


def test_charts_rules_and_the_rollup_are_written(spark, written, landed, inputs, tmp_path):
    assert written("rule_reports").where("ok = 'false'").count() == 0
    assert written("charts/calendar").count() > 0 and written("charts/under_threshold_grid").count() == 0
    assert written("charts/under_threshold_order").count() == 0
    before = {p.name for p in Path(staging_folder(spark).removeprefix("file:")).iterdir()}
    build_snapshot(inputs, PERIOD, str(tmp_path / "o"), PARAMS, keep_rollup=str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept/2024-01"))
    assert kept.select("made_with").distinct().count() == 1 and kept.select("year").distinct().collect() == [(2024,)]
    assert {p.name for p in Path(staging_folder(spark).removeprefix("file:")).iterdir()} == before


def test_a_report_out_of_the_kept_store_equals_the_whole_one(spark, landed, tmp_path):
    params = replace(PARAMS, history_years=2)
    store, out = str(tmp_path / "store"), str(tmp_path / "reports")
    for text in ("2022-01", "2023-01"):
        period = period_bounds(text)
        # The registry is of 2024; only what the store keeps matters here.
        given = replace(Inputs.landed(spark, landed, PERIOD, params), landed_rows=None)
        keep_period(Snapshot(given, period, params, tracked=["delhi", "agra"]), KeptStore(spark, store))
    inputs = Inputs.landed(spark, landed, PERIOD, params, store=store)
    assert inputs.measurements.where("date < '2024-01-01'").isEmpty()
    lists = {"tracked": ["delhi", "agra"]}
    build_snapshot(inputs, PERIOD, out, params, publish=True, store=store, **lists)
    whole = Snapshot(Inputs.landed(spark, landed, PERIOD, params), PERIOD, params, **lists)
    expected, charts = whole.outputs(), whole.chart_tables()
    text = lambda df: sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())
    for name, df in {"top5_populous_cities": expected["top5_populous_cities"], "charts/calendar": charts["calendar"]}.items():
        found = published_output(spark, out, PERIOD, name)
        assert text(found.select(*found.columns)) == text(df) and found.count() > 0
    assert published_output(spark, out, PERIOD, "statuses_summary.md").count() >= expected["statuses_summary.md"].count()
    assert KeptStore(spark, store).periods() == ["2022-01", "2023-01", "2024-01"]


def test_a_report_that_dies_leaves_the_one_before(spark, inputs, tmp_path, monkeypatch):
    out = str(tmp_path / "reports")
    with pytest.raises(FileNotFoundError):
        published_output(spark, out, PERIOD, "statuses")
    build_snapshot(inputs, PERIOD, out, PARAMS, publish=True)
    before = published_output(spark, out, PERIOD, "statuses").collect()

    def dies(self):
        raise RuntimeError("lost")

    monkeypatch.setattr(Snapshot, "chart_tables", dies)
    with pytest.raises(RuntimeError, match="lost"):
        build_snapshot(replace(inputs, stations=inputs.stations.where("id <> 'st_agra'")), PERIOD, out, PARAMS, publish=True)
    assert published_output(spark, out, PERIOD, "statuses").collect() == before
    assert len(manifests.versions(spark, f"{out}/{PERIOD.text}")) == 1


def test_overshoots_start_with_the_year(spark, tmp_path):
    text = '{"data": [%s]}' % ", ".join(
        f'{{"date": "{d}", "location_id": "x", "is_overshoot": true, "is_overshoot_estimated": false}}'
        for d in ("2023-12-31", "2024-01-01", "2024-05-05")
    )
    (tmp_path / "a.json").write_text(text)
    found = readers.load_overshoots(spark, str(tmp_path), dt.date(2024, 1, 1))
    assert sorted(str(r["date"]) for r in found.collect()) == ["2024-01-01", "2024-05-05"]


def test_half_year_calendar_takes_the_top_entities(spark, inputs):
    snapshot = Snapshot(inputs, period_bounds("2024-H1"), replace(PARAMS, day_share=0.1))
    cells = snapshot.chart_tables()["calendar"]
    assert cells.count() == 3 * 182


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda i: {"station_measurements": i.station_measurements.unionByName(i.station_measurements)}, "Duplicate"),
        (lambda i: {"stations": i.stations.where("id <> 'st_delhi'")}, "missing from the new registry"),
        (lambda i: {"groups": i.groups.unionByName(i.groups)}, "more than once in ncap_cities"),
        (lambda i: {"measurements": i.measurements.withColumn("value", F.expr("nullif(value, 20.0)"))}, "neither passed"),
        (lambda i: {"measurements": i.measurements.where("day(date) < 5")}, "Limits not met: first 1 of 1: days"),
    ],
)
def test_hard_stops(inputs, change, message):
    broken = replace(inputs, **change(inputs))
    with pytest.raises(DataCheckError, match=message):
        Snapshot(broken, PERIOD, PARAMS).check()
