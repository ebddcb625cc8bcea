"""What the plans must look like for tables far larger than these."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazeline.functions.periods import period_bounds
from hazeline.operators import checks, completion, prepare, rankings, status
from hazeline.operators.rollup import complete_rollup, monthly_rollup
from hazeline.plans import staging
from hazeline.plans.staging import drop_staged, stage, staging_folder
from hazeline.sources import readers

M = (
    "location_id string, city_id string, city_name string, gadm1_id string, gadm1_name string, "
    "pollutant string, pollutant_name string, date date, value double"
)


@pytest.fixture(scope="module")
def m(spark, tmp_path_factory):
    rows = [
        (f"l{i % 7}", f"c{i % 7}", f"n{i % 7}", "g", "R", "pm25", "PM2.5",
         dt.date(2024, 1, 1 + i % 31), float(i))
        for i in range(500)
    ]
    path = str(tmp_path_factory.mktemp("plans") / "m")
    spark.createDataFrame(rows, M).write.parquet(path)
    return spark.read.schema(M).parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_is_one_scan_and_one_shuffle(m):
    text = plan(monthly_rollup(prepare.filter_period(m, period_bounds("2024-01"))))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "partial_sum(value" in text and "partial_bit_or" in text
    assert "GreaterThanOrEqual(date,2024-01-01)" in text


def test_rollup_stays_in_generated_code(m):
    r = monthly_rollup(m)
    r.collect()
    text = plan(r).split("Initial Plan")[0]
    assert "*(1) HashAggregate" in text and "*(2) HashAggregate" in text


def test_no_query_over_a_rollup_reads_the_days(m):
    r = stage(monthly_rollup(m), "rollup")
    kept = stage(complete_rollup(r, 2), "complete")
    source = m.inputFiles()[0].rsplit("/", 1)[0]
    assert not any(f.startswith(source) for f in kept.inputFiles())


def test_daily_tops_are_cut_before_the_shuffle(m):
    """The cuts are found with a group limit on each side of the shuffle."""
    seen = []
    original = rankings.stage
    rankings.stage = lambda df, label: seen.append((label, plan(df))) or original(df, label)
    try:
        rankings.top_n_frequency(m)
    finally:
        rankings.stage = original
    cuts, counts = dict(seen)["cuts"], dict(seen)["frequency"]
    assert cuts.count("WindowGroupLimit") == 2
    assert "ReadSchema: struct<pollutant:string,pollutant_name:string,date:date,value:double>" in cuts
    assert set(dict(seen)) == {"cuts", "frequency"}
    assert "BroadcastHashJoin" in counts and "Window" not in counts


def test_large_sides_are_not_broadcast(spark, m):
    """Beyond the threshold the joins fall back to shuffles by themselves."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(prepare.complete_entities(m, 1))
        assert "SortMergeJoin" in text and "Broadcast" not in text
        found = rankings.top_with_ties(m, "value", 2, ["date"])
        assert "Broadcast" not in plan(found) and found.count() == 62
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_clean_days_are_not_shuffled_to_find_duplicates(m):
    clean = m.dropDuplicates(["location_id", "date"])
    found = checks.duplicate_entries(clean, prepare.month_counts(clean))
    assert found.count() == 0 and "Window" not in plan(found)
    doubtful = [f for f in found.inputFiles() if "doubtful" in f]
    assert found.sparkSession.read.parquet(*doubtful).count() == 0
    assert checks.duplicate_entries(m, prepare.month_counts(m)).count() == 217


def test_grid_needs_no_join(m):
    observed = m.select(
        "location_id", "city_name", "gadm1_name", "gadm1_id", "date", F.lit("f").alias("file_name")
    )
    grid = completion.completion_grid(stage(completion.observed_completion(observed), "o"))
    assert "Join" not in plan(grid)


def test_a_million_names_of_one_class_stay_in_many_tasks(spark):
    """No exchange by the list alone stands before rows of names."""
    names = spark.range(1_000_000).select(
        F.col("id").cast("string"), F.concat(F.lit("S"), F.col("id").cast("string")).alias("name"),
        F.lit("New").alias("change"),
    )
    found = status.change_lists(names)
    text = plan(found)
    assert "hashpartitioning(place" not in text and "collect_list" not in text
    assert "hashpartitioning(_part" in text
    per_task = found.where("value <> 'No value'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 1_000_000 and max(r["count"] for r in per_task) < 600_000


def test_months_are_pruned(spark, tmp_path, capsys):
    fixed = {c: F.lit("x") for c in readers.MEASUREMENTS.fieldNames()}
    days = spark.range(400).select(F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("date"))
    rows = days.withColumns({**fixed, "date": F.col("date"), "value": F.lit(1.0)})
    path = str(tmp_path / "m")
    rows.withColumns({"year": F.year("date"), "month": F.month("date")}).write.partitionBy("year", "month").parquet(path)
    found = readers.landed_measurements(spark, path, [(dt.date(2025, 1, 1), dt.date(2025, 1, 31))])
    assert found.count() == 31
    found.explain("formatted")
    text = capsys.readouterr().out
    assert "month" in text.split("PartitionFilters")[1].splitlines()[0]


def test_the_staging_folder(spark, monkeypatch):
    class Context:
        master, applicationId, folder = "spark://host:7077", "app", None

        def getCheckpointDir(self):
            return self.folder

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_root(Session)
    Session.conf = {"spark.checkpoint.dir": "file:/tmp/x"}
    with pytest.raises(RuntimeError, match="local disk"):
        staging.staging_root(Session)
    Session.conf = {}
    Context.folder = "hdfs://host/checkpoints"
    assert staging.staging_root(Session) == "hdfs://host/checkpoints"
    Context.folder, Context.master = None, "local[2]"
    first = staging.staging_root(Session)
    assert first == staging.staging_root(Session) and Context.folder is None


def test_staged_tables_can_be_dropped(spark):
    stage(spark.range(3), "three")
    folder = staging_folder(spark)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.exists(path)
    assert drop_staged(spark) and not files.exists(path)
