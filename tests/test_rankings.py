import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import rows
from hazeline.operators import rankings
from hazeline.params import DEFAULTS
from hazeline.plans.staging import global_row_number

DAILY = (
    "date date, pollutant string, pollutant_name string, value double, location_id string, "
    "city_name string, gadm1_name string"
)


def week(frame, places):
    """A value per place and day of a week: places are (id, city, region, value, daily step)."""
    start = dt.date(2019, 3, 4)
    data = [
        (start + dt.timedelta(days=d), "pm25", "PM2.5", value + step * d, id, city, region)
        for d in range(7) for id, city, region, value, step in places
    ]
    return frame(data, DAILY)


def test_same_names_show_the_region(frame):
    df = week(frame, [("u1", "Upton", "Goa", 5.0, 0.0), ("u2", "Upton", "Bihar", 4.0, 1.0), ("v", "Vale", "Goa", 1.0, 0.5)])
    assert rows(rankings.top_n_frequency(df)) == [("u2", "Upton, BR", 7), ("u1", "Upton, GA", 7), ("v", "Vale", 7)]


def test_names_that_are_single_among_the_listed_stay_short(frame):
    # u2 is never among the two highest, so nothing tells the name apart.
    df = week(frame, [("u1", "Upton", "Goa", 9.0, 0.0), ("v", "Vale", "Goa", 8.0, 0.0), ("u2", "Upton", "Bihar", 1.0, 0.0)])
    found = rankings.top_n_frequency(df, replace(DEFAULTS, top_n=2))
    assert rows(found) == [("u1", "Upton", 7), ("v", "Vale", 7)]


def test_counts_are_by_location_and_day(frame):
    # The second place overtakes the first on the fifth day.
    df = week(frame, [("p", "Port", "Delhi", 8.0, 0.0), ("q", "Port", "Delhi", 0.0, 2.0)])
    found = rankings.top_n_frequency(df, replace(DEFAULTS, top_n=1))
    assert rows(found) == [("p", "Port, DL", 5), ("q", "Port, DL", 3)]


def test_labels_star_members_and_keep_missing_names(frame):
    df = frame(
        [("1", "A", "Bihar", "ncap_cities"), ("2", "A", None, "x"), ("3", None, "Goa", "x")],
        "location_id string, city_name string, gadm1_name string, name string",
    )
    found = rankings.display_labels(df, group_col="name").orderBy("location_id")
    assert rows(found, "city_label") == [("A, BR*",), ("A, NA",), (None,)]


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("highest", [True, False])
@pytest.mark.parametrize("n", [1, 3, 10])
def test_top_with_ties_is_rank(frame, keys, highest, n):
    """Against rank() itself: heavy ties, missing values and keys, short groups."""
    draw = random.Random(n)
    data = [
        (draw.choice(["a", "a", "a", "b", None]), draw.choice([None, 1.0, 2.0, 2.0, 3.5, 7.0]), i)
        for i in range(200)
    ] + [("short", 1.0, 1000), ("short", None, 1001), ("empty", None, 1002)]
    df = frame(data, "k string, v double, id long")
    order = F.desc_nulls_last("v") if highest else F.asc_nulls_last("v")
    place = F.rank().over(Window.partitionBy(*keys).orderBy(order))
    wanted = {r["id"] for r in df.withColumn("r", place).where(F.col("r") <= n).collect()}
    found = rankings.top_with_ties(df, "v", n, keys, highest)
    assert sorted(r["id"] for r in found.collect()) == sorted(wanted)
    assert found.columns == df.columns


def test_row_numbers_cover_the_table_in_order(spark):
    df = spark.range(5000).select(F.hash("id").alias("h"), "id").repartition(7)
    numbered = global_row_number(df, [F.desc("h"), F.asc("id")], "n").collect()
    ordered = sorted(numbered, key=lambda r: (-r["h"], r["id"]))
    assert [r["n"] for r in ordered] == list(range(1, 5001))


def test_row_numbers_start_anew_for_each_value(spark):
    df = spark.range(3000).select((F.col("id") % 3 % 2).alias("k"), F.hash("id").alias("h"), "id").repartition(7)
    numbered = global_row_number(df, [F.asc("k"), F.desc("h"), F.asc("id")], "n", "k").collect()
    for k, size in ((0, 2000), (1, 1000)):
        ordered = sorted((r for r in numbered if r["k"] == k), key=lambda r: (-r["h"], r["id"]))
        assert [r["n"] for r in ordered] == list(range(1, size + 1))
