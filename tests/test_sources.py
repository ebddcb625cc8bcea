import datetime as dt
import json

import pytest

from conftest import rows
from hazeline.functions.periods import period_bounds
from hazeline.operators.checks import DataCheckError, rule_report
from hazeline.sources import readers
from hazeline.sources.writers import write_outputs

HEADER = (
    "date,process_id,location_id,variable,value,unit,source,pollutant,pollutant_name,country_id,"
    "level,city_id,city_name,gadm1_name,gadm1_id"
)


def line(date, value, id="a", level="city", source="cpcb", pollutant="pm25"):
    return (
        f"{date},{level}_day_mad,{id},observed,{value},µg/m3,{source},{pollutant},PM2.5,IN,"
        f"{level},{id},City {id},Region,r"
    )


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


JANUARY = period_bounds("2024-01")


def test_measurements_from_csv(spark, tmp_path):
    write(
        tmp_path / "m" / "a.csv", HEADER, line("2024-01-01", 5.5), line("2024-02-01", 6),
        line("2024-01-02", "NA"), line("2024-01-03", "NaN"), line("2024-01-04", ""),
        line("2024-01-05", 1, level="station"), line("2024-01-06", 1, source="x"),
        line("2024-01-07", 1, pollutant="no2"), line("2023-01-08", 7),
    )
    df = readers.load_measurements(
        spark, str(tmp_path / "m"), "city", [(JANUARY.start, JANUARY.end)], fmt="csv"
    )
    assert df.columns == HEADER.split(",")
    found = sorted(rows(df, "date", "value"))
    assert found == [(dt.date(2024, 1, 1), 5.5)] + [(dt.date(2024, 1, d), None) for d in (2, 3, 4)]
    both = readers.load_measurements(
        spark, str(tmp_path / "m"), "city", readers.history_periods(JANUARY, 8), fmt="csv"
    )
    assert both.count() == 5


def test_broken_rows_are_left_out_counted_and_listed(spark, tmp_path):
    bad = [line("2024-01-02", "high"), line("soon", 3), "2024-01-03,city_day_mad,a"]
    write(tmp_path / "m" / "a.csv", HEADER, line("2024-01-01", 5.5), *bad)
    write(tmp_path / "m" / "b.csv", HEADER, line("2024-01-04", 6))
    folder, range_ = str(tmp_path / "m"), [(JANUARY.start, JANUARY.end)]
    found = readers.load_measurements(spark, folder, "city", range_, fmt="csv")
    assert sorted(rows(found, "date")) == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 4),)]
    assert found.select("location_id").count() == 2
    listed = readers.broken_rows(spark, folder).collect()
    assert sorted(r["record"] for r in listed) == sorted(bad)
    assert {r["file_name"].rsplit("/", 1)[1] for r in listed} == {"a.csv"}
    raw = readers.landed_measurements(spark, folder, range_, "csv")
    report = {r["rule"]: r for r in rule_report(raw, readers.parse_rules(raw)).collect()}
    assert (report["row parses"]["failed_rows"], report["row parses"]["total_rows"]) == (3, 5)
    assert readers.parse_rules(found) == {}


def test_broken_rows_of_period_files(spark, tmp_path):
    name = "measurements_2024-01-01_2024-01-31.csv"
    write(tmp_path / "x" / name, HEADER, line("2024-01-01", 1), line("never", 1))
    write(tmp_path / "x" / "other.csv", HEADER, line("never", 1))
    assert readers.load_period_files(spark, str(tmp_path / "x")).count() == 1
    assert rows(readers.broken_period_rows(spark, str(tmp_path / "x")), "record") == [(line("never", 1),)]
    write(tmp_path / "y" / "other.csv", HEADER, line("never", 1))
    assert readers.broken_period_rows(spark, str(tmp_path / "y")).collect() == []


def test_broken_documents_are_left_out_and_listed(spark, tmp_path):
    good = '{"data": [{"date": "2024-01-02", "location_id": "a", "is_overshoot": true, "is_overshoot_estimated": false}]}'
    write(tmp_path / "o" / "good.json", good)
    write(tmp_path / "o" / "cut.json", good[:-20])
    write(tmp_path / "o" / "wrong.json", good.replace("true", '"often"'))
    assert readers.load_overshoots(spark, str(tmp_path / "o")).count() == 1
    found = {r["file_name"].rsplit("/", 1)[1]: r for r in readers.broken_documents(spark, str(tmp_path / "o"), 9).collect()}
    assert set(found) == {"cut.json", "wrong.json"} and found["cut.json"]["start"] == good[:9]
    assert found["cut.json"]["n_chars"] == len(good) - 20 + 1


def test_documents_as_lines_of_few_files(spark, tmp_path):
    from verification.queries import land_documents

    record = '{"date":"2024-01-02","location_id":"a%d","is_overshoot":true,"is_overshoot_estimated":false}'
    good = ['{"data":[%s]}' % ",".join([record % i] * (i % 3)) for i in range(60)]
    texts = [text[:-9] if i % 9 == 0 else text for i, text in enumerate(good) if i]
    folder = tmp_path / "o"
    land_documents(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1), str(folder), most=20)
    assert len(list(folder.rglob("*.gz"))) == 3 and not [p for p in folder.iterdir() if p.is_dir()]
    read = rows(readers.load_overshoots(spark, str(folder), lines=True), "location_id")
    assert sorted(read) == sorted((f"a{i}",) for i in range(60) for _ in range(i % 3) if i % 9)
    found = readers.broken_documents(spark, str(folder), 12, lines=True)
    cut = [good[i][:-9] for i in range(9, 60, 9)]
    assert sorted(rows(found, "n_chars", "start")) == sorted((len(t), t[:12]) for t in cut)
    assert {r[0].rsplit("/", 1)[0].removeprefix("file:").lstrip("/") for r in rows(found, "file_name")} == {str(folder).lstrip("/")}


def test_broken_groups_and_stations_are_left_out(spark, tmp_path):
    write(tmp_path / "c" / "a.csv", "id,name,gadm1_id,country_id,level,longitude,latitude", "a,A,r,IN,city,77.5,12.9", "b,B,r,IN,city,east,1")
    assert rows(readers.load_cities(spark, str(tmp_path / "c"), "csv")) == [("a", 77.5, 12.9)]
    raw = readers.landed_cities(spark, str(tmp_path / "c"), "csv")
    assert rule_report(raw, readers.parse_rules(raw)).collect()[0]["failed_rows"] == 1


def test_column_order_in_csv_is_free_and_extra_columns_go(spark, tmp_path):
    write(tmp_path / "g" / "a.csv", "extra,location_id,name", "1,loc,group")
    assert rows(readers.load_groups(spark, str(tmp_path / "g"), "csv")) == [("group", "loc")]
    write(tmp_path / "h" / "a.csv", "name", "x")
    with pytest.raises(DataCheckError, match="location_id"):
        readers.load_groups(spark, str(tmp_path / "h"), "csv")


def test_measurements_are_pruned_and_pushed_down(spark, tmp_path, capsys):
    write(tmp_path / "m" / "a.csv", HEADER, line("2024-01-01", 5.5), line("2020-01-01", 6))
    df = spark.read.csv(str(tmp_path / "m"), header=True, schema=readers.MEASUREMENTS)
    landed = str(tmp_path / "p")
    df.selectExpr("*", "year(date) AS year").write.partitionBy("year").parquet(landed)
    found = readers.load_measurements(spark, landed, "city", [(JANUARY.start, JANUARY.end)])
    assert rows(found, "value") == [(5.5,)]
    found.select("value").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThanOrEqual(date,2024-01-01)" in plan and "city_name" not in plan.split("ReadSchema")[1]


def test_files_of_another_column_order_are_an_error(spark, tmp_path):
    write(tmp_path / "g" / "a.csv", "name,location_id", "g,a")
    write(tmp_path / "g" / "b.csv", "location_id,name", "b,g")
    with pytest.raises(Exception, match="(?i)header"):
        readers.load_groups(spark, str(tmp_path / "g"), "csv").collect()


def test_stations_of_one_month(spark, tmp_path):
    head = "id,name,city_id,city_name,infos,source,country_id,level"
    for month in ("2023-12", "2024-01"):
        write(
            tmp_path / "s" / f"snapshot_month={month}" / "a.csv", head,
            f"1,S {month},c,C,\"{{'status': 'Live'}}\",cpcb,IN,station",
        )
    df = readers.load_stations(spark, str(tmp_path / "s"), JANUARY.previous_month, "csv")
    assert rows(df, "name", "infos") == [("S 2023-12", "{'status': 'Live'}")]


def test_cities(spark, tmp_path):
    write(
        tmp_path / "c" / "a.csv", "id,name,gadm1_id,country_id,level,longitude,latitude",
        "a,A,r,IN,city,77.5,12.9", "b,B,r,IN,city,,",
    )
    found = readers.load_cities(spark, str(tmp_path / "c"), "csv")
    assert rows(found) == [("a", 77.5, 12.9), ("b", None, None)]


def test_overshoots(spark, tmp_path):
    def record(target, over, estimated):
        return {
            "date": "2024-01-02", "location_id": "a", "target_id": target, "target_value": 15,
            "is_overshoot": over, "is_overshoot_estimated": estimated, "other": [1],
        }

    known = "ae5e689a-863c-11ef-b57b-e6cf434e9f43"
    first = [record(known, True, False), record(known, True, True), record(known, False, False)]
    for name, data in {"a": first, "b": [record("unknown", True, False)], "c": []}.items():
        write(tmp_path / "o" / f"overshooting-{name}.json", json.dumps({"data": data}, indent=1))
    df = readers.load_overshoots(spark, str(tmp_path / "o"))
    assert len(df.columns) == 13
    assert sorted(rows(df, "target_id", "date"), key=str) == [
        ("India PM2.5 (yearly)", dt.date(2024, 1, 2)), (None, dt.date(2024, 1, 2)),
    ]


def test_period_files(spark, tmp_path):
    name = "measurements_2024-{0:02}-01_2024-{0:02}-28.csv"
    write(tmp_path / "x" / "2024-01" / name.format(1), HEADER, line("2024-01-01", 1))
    write(tmp_path / "x" / "2024-02" / "deep" / name.format(2), HEADER, line("2024-02-01", 1))
    write(tmp_path / "x" / "measurements_2024-ab-01_2024-02-01.csv", HEADER, line("2024-03-01", 1))
    write(tmp_path / "x" / "measurements_stations.csv", HEADER, line("2024-04-01", 1))
    df = readers.load_period_files(spark, str(tmp_path / "x"))
    found = sorted((d, f.rsplit("/", 1)[1]) for d, f in rows(df, "date", "file_name"))
    assert found == [(dt.date(2024, m, 1), name.format(m)) for m in (1, 2)]


def test_no_period_files(spark, tmp_path):
    write(tmp_path / "y" / "other.csv", HEADER, line("2024-01-01", 1))
    assert readers.load_period_files(spark, str(tmp_path / "y")).count() == 0


def test_rules_of_landed_columns():
    assert len(readers.measurement_rules("city")) == 8
    assert readers.type_rules(readers.CITIES)["latitude"] == "double"


def test_outputs_are_written_with_their_titles(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.0, None)], "x string, very_poor int, exceedance_pct double, name string")
    text = spark.createDataFrame([("## Head\n\n- a: 1",), ("- b: 2",)], "line string")
    paths = write_outputs({"t": df, "r.md": text}, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["t", "r.md"]
    written = spark.read.csv(paths[0], header=True)
    assert rows(written) == [("a", "1", "2.0", "NA")]
    assert written.columns == ["x", "Very Poor", "% days > NAAQS", "name"]
    assert [r[0] for r in rows(spark.read.text(paths[1]))] == ["## Head", "", "- a: 1", "- b: 2"]


def test_landed_documents_and_files_stay_small(spark, tmp_path):
    from pyspark.sql import functions as F

    from verification import fixtures as fx
    from verification.queries import land_overshoots, land_period_files

    folder = "/root/testdata/sf0.001"
    records = fx.overshoot_records(spark, folder)
    land_overshoots(records, str(tmp_path / "documents"), most=40)
    sizes = spark.read.schema("data array<struct<date: date>>").json(str(tmp_path / "documents"), multiLine=True)
    total, most = sizes.agg(F.sum(F.size("data")), F.max(F.size("data"))).first()
    assert total == records.count() and most < 80
    rows = fx.period_file_rows(spark, folder)
    land_period_files(rows, str(tmp_path / "files"), most=3000)
    names = [p.name for p in (tmp_path / "files").rglob("measurements_*.csv")]
    assert len(names) > len(set(names)) == rows.select("file").distinct().count()
    landed = spark.read.option("header", True).option("recursiveFileLookup", True).csv(str(tmp_path / "files"))
    assert landed.count() == rows.count()


def test_landed_documents_are_compressed(spark, tmp_path):
    from pyspark.sql import functions as F

    from verification.queries import land_overshoots

    record = F.struct(
        F.lit("2024-01-02").cast("date").alias("date"), F.concat(F.lit("loc_"), F.col("id") % 7).alias("location_id"),
        F.lit("µg/m3").alias("unit"), F.col("id").cast("double").alias("target_value"),
        F.lit(True).alias("is_overshoot"), (F.col("id") % 3 == 0).alias("is_overshoot_estimated"),
    )
    records = spark.range(3000).select((F.col("id") % 7).alias("l_suppkey"), record.alias("record"))
    text = records.agg(F.sum(F.length(F.to_json("record")))).first()[0]
    land_overshoots(records, str(tmp_path / "o"), most=500)
    files = [p for p in (tmp_path / "o").rglob("part-*")]
    assert len(files) == 6 and sum(p.stat().st_size for p in files) < text / 5
    found = readers.load_overshoots(spark, str(tmp_path / "o"))
    wanted = sorted((f"loc_{i % 7}", float(i)) for i in range(3000) if i % 3)
    assert sorted(rows(found, "location_id", "target_value")) == wanted
    land_overshoots(records.limit(0), str(tmp_path / "none"))
    assert rows(readers.load_overshoots(spark, str(tmp_path / "none"))) == []
