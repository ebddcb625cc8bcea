import datetime as dt

import pytest

from conftest import rows
from hazeline.operators import status as st
from hazeline.operators.prepare import month_counts
from hazeline.params import Params

DDL = "id string, name string, city_id string, city_name string, latest_data string, status string"


def station(id, state, city="c1", name=None):
    return (id, name or f"S{id}", city, f"City {city}", "2023-01-31", state)


ABSENT = object()
# old state, new state, class
CHANGES = [
    ("Live", "Live", "No change"),
    ("Live", "Delay", "No change"),
    ("Live", "Inactive", "Removed this month"),
    ("Live", None, "Removed this month"),
    ("Live", ABSENT, "Removed this month"),
    ("Delay", "Live", "No change"),
    ("delay", "DELAY", "No change"),
    ("Delay", "Inactive", "Removed this month"),
    ("Delay", None, "Removed this month"),
    ("Inactive", "Live", "Reactivated"),
    ("Inactive", "Delay", "Reactivated"),
    ("Inactive", "Inactive", "Removed in a previous month"),
    ("Inactive", None, "Removed in a previous month"),
    (None, "Live", "Reactivated"),
    (None, "Delay", "Reactivated"),
    (None, "Inactive", "Removed in a previous month"),
    (None, None, "Removed in a previous month"),
    (ABSENT, "Live", "New"),
    (ABSENT, "Delay", "New"),
    (ABSENT, "Inactive", "No change"),
    (ABSENT, None, "No change"),
    (ABSENT, "Broken", "Change undefined"),
    ("Live", "Broken", "Change undefined"),
    ("Broken", "Live", "Change undefined"),
    ("Broken", None, "Change undefined"),
    ("Inactive", ABSENT, "Removed in a previous month"),
]


def test_all_changes(frame):
    old = [station(str(i), o) for i, (o, _, _) in enumerate(CHANGES) if o is not ABSENT]
    new = [station(str(i), n) for i, (_, n, _) in enumerate(CHANGES) if n is not ABSENT]
    found = dict(rows(st.status_change(frame(old, DDL), frame(new, DDL)), "id", "change"))
    assert found == {str(i): c for i, (_, _, c) in enumerate(CHANGES)}


def test_empty_registries(frame):
    assert rows(st.status_change(frame([], DDL), frame([], DDL))) == []


def test_vanished_station_has_no_description(frame):
    found = rows(st.status_change(frame([station("1", "Live")], DDL), frame([], DDL)))
    assert found == [("1", None, None, None, None, None, "Removed this month")]


def history(frame, days):
    start = dt.date(2023, 1, 1)
    data = [
        (id, start + dt.timedelta(days=i), 100.0) for id, n in days.items() for i in range(n)
    ]
    return frame(data, "location_id string, date date, value double")


def test_completeness(frame):
    stations = frame([station(i, "Live") for i in "123"], DDL)
    table = st.status_table(stations, stations, month_counts(history(frame, {"2": 23, "3": 31})), 31)
    found = {r[0]: r[1:] for r in rows(table, "id", "percent_complete", "percent_category")}
    assert found["1"] == (0.0, "No data")
    assert found["2"] == (pytest.approx(0.7419, abs=0.001), "<80% data")
    assert found["3"] == (1.0, ">80% data")


def test_the_share_of_days_is_a_parameter(frame):
    df = frame([(0.5,), (0.7,)], "p double")
    found = [r[0] for r in rows(df.select(st.completeness_class(df["p"], Params(day_share=0.6))))]
    assert found == ["<80% data", ">80% data"]


def test_completeness_edges(frame):
    df = frame([(0.0,), (0.0099,), (0.01,), (0.7999,), (0.8,), (1.2,), (None,)], "p double")
    found = [r[0] for r in rows(df.select(st.completeness_class(df["p"])))]
    assert found == ["No data"] * 2 + ["<80% data"] * 2 + [">80% data"] * 3


STATUSES = (
    "id string, name string, city_id string, city_name string, change string, "
    "percent_complete double, percent_category string"
)


def statuses(frame):
    return frame(
        [
            ("1", "B", "c1", "One", "New", 1.0, ">80% data"),
            ("2", "A", "c1", "One", "New", 0.5, "<80% data"),
            ("3", "C", "c2", "Two", "New", 0.0, "No data"),
            ("4", "D", "c2", "Two", "No change", 0.0, "No data"),
            ("5", "E", "c3", "Three", "Reactivated", 0.01, "<80% data"),
            ("6", "F", None, None, "Removed this month", 0.3, "<80% data"),
        ],
        STATUSES,
    )


GROUPS = [("ncap_cities", "c1"), ("ncap_cities", "c9"), ("igp_cities", "c2")]


def values(df):
    return [r["value"] for r in df.orderBy("ord", "pos").collect()]


def test_counts(frame):
    df, groups = statuses(frame), frame(GROUPS, "name string, location_id string")
    assert values(st.status_counts(df)) == ["6", "1", "3", "2"]
    # c3 is in the middle class but not above one per cent.
    assert values(st.group_completeness(df)) == ["4", "1", "1", "1"]
    assert values(st.group_completeness_in(df, groups)) == ["1", "1", "0", "0"]
    # A station without a city belongs to no group.
    assert values(st.group_completeness_out(df, groups)) == ["3", "0", "1", "1"]


def test_change_lists_and_new_cities(frame):
    df = statuses(frame)
    assert values(st.change_lists(df)) == ["A", "B", "C", "E", "F"]
    assert rows(st.new_cities(df)) == [("c1", "One")]
    nothing = df.where("change = 'No change'")
    assert values(st.change_lists(nothing)) == ["No value"] * 3
    assert values(st.new_city_lists(nothing)) == ["No value"]
    assert rows(st.new_city_notice(nothing)) == []
    assert len(rows(st.new_city_notice(df))) == 1


@pytest.mark.parametrize("n", [1, 25, 3000])
def test_lists_of_any_size_have_a_row_per_name(frame, n):
    data = [(str(i), f"S{i % 1000:04}", "c", "C", "New", 1.0, ">80% data") for i in range(n)]
    data.append(("x", None, "c", "C", "New", 1.0, ">80% data"))
    found = rows(st.change_lists(frame(data, STATUSES).repartition(5)).where("ord = 1").orderBy("pos"), "pos", "value")
    assert [p for p, _ in found] == list(range(1, n + 2))
    assert [v for _, v in found] == sorted(f"S{i % 1000:04}" for i in range(n)) + ["NA"]


def test_report_text(frame):
    groups = frame(GROUPS, "name string, location_id string")
    lines = [r["line"] for r in st.report_lines(st.status_report(statuses(frame), groups)).collect()]
    text = "\n".join(lines)
    assert text.startswith("## Station Statuses\n\n- CAAQMS installed in India: 6\n")
    assert "\n\n## Changes in Stations\n\n- New stations: A\n- New stations: B\n- New stations: C\n" in text
    assert "- Cities with new stations: One\n*Please inform the Data team" in text
    assert text.endswith("- Non-NCAP cities with <1% data: 1")
