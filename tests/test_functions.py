import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from hazeline.functions.labels import abbreviate, footnote_label, in_list, in_list_ci
from hazeline.functions.numbers import band, clean_double, frequency_bin, number_text, rounded_percent
from hazeline.functions.periods import period_bounds, period_struct
from hazeline.operators.prepare import flatten_attributes
from hazeline.params import STATE_ABBREVIATIONS, column_name


@pytest.mark.parametrize(
    "text, start, end, mode, days, before",
    [
        ("2024-02", "2024-02-01", "2024-02-29", "month", 29, "2024-01-01"),
        ("2024-01", "2024-01-01", "2024-01-31", "month", 31, "2023-12-01"),
        ("2025-H1", "2025-01-01", "2025-06-30", "half_year", 181, "2024-12-01"),
        ("2025-H2", "2025-07-01", "2025-12-31", "half_year", 184, "2025-06-01"),
    ],
)
def test_period(text, start, end, mode, days, before):
    p = period_bounds(text)
    assert (str(p.start), str(p.end), p.mode, p.days) == (start, end, mode, days)
    assert str(p.previous_month) == before


def test_period_defaults_to_last_month():
    assert period_bounds(today=dt.date(2025, 3, 31)).text == "2025-02"
    assert period_bounds(today=dt.date(2025, 1, 1)).text == "2024-12"


@pytest.mark.parametrize("text", ["2024", "2024-1", "2024-H3", "24-01", "2024-01-01", "2024-13", ""])
def test_period_errors(text):
    with pytest.raises(ValueError):
        period_bounds(text)


def test_period_in_other_years_ends_with_the_month():
    february = period_bounds("2024-02")
    assert february.in_year(2023) == (dt.date(2023, 2, 1), dt.date(2023, 2, 28))
    assert period_bounds("2023-02").in_year(2020)[1] == dt.date(2020, 2, 29)


def test_period_titles():
    assert period_bounds("2024-02").title == "February 2024"
    assert period_bounds("2024-H1").title == "January to June 2024"


def test_period_column(frame):
    df = frame([("2024-02",), ("2024-H2",), ("2024-13",), ("x",), (None,)], "p string")
    found = rows(df.select(period_struct(F.col("p")).alias("s")).select("s.start", "s.end", "s.days"))
    assert found[0] == (dt.date(2024, 2, 1), dt.date(2024, 2, 29), 29)
    assert found[1] == (dt.date(2024, 7, 1), dt.date(2024, 12, 31), 184)
    assert found[2:] == [(None, None, None)] * 3


def test_band_edges(frame):
    values = [0.0, 0.1, 30.0, 30.1, 60.0, 90.0, 120.0, 250.0, 250.1, 1500.0, 1500.1, None]
    df = frame([(v,) for v in values], "v double")
    assert [r[0] for r in rows(df.select(band("v")))] == [
        None, "Good", "Good", "Satisfactory", "Satisfactory", "Moderate", "Poor", "Very Poor",
        "Severe", "Severe", None, None,
    ]


def test_frequency_bins(frame):
    df = frame([(v,) for v in [0, 1, 7, 8, 15, 16, 22, 23, 29, 30]], "v long")
    assert [r[0] for r in rows(df.select(frequency_bin("v", 30)))] == [
        "0%", "25%", "25%", "50%", "50%", "75%", "75%", "99%", "99%", "100%",
    ]


def test_half_even_percent_and_zero_total(frame):
    df = frame([(1, 8), (3, 8), (1, 3), (0, 0)], "a long, b long")
    assert [r[0] for r in rows(df.select(rounded_percent("a", "b")))] == [12.0, 38.0, 33.0, None]


def test_nan_is_missing(frame):
    df = frame([(float("nan"),), (1.0,), (None,)], "v double")
    assert [r[0] for r in rows(df.select(clean_double("v")))] == [None, 1.0, None]


def test_number_text(frame):
    df = frame([(4.0,), (4.25,), (1.0000004,)], "v double")
    assert [r[0] for r in rows(df.select(number_text("v")))] == ["4", "4.25", "1"]


def test_abbreviations(frame):
    df = frame([("West Bengal",), ("Elsewhere",), (None,)], "s string")
    assert [r[0] for r in rows(df.select(abbreviate(F.col("s"))))] == ["WB", "Elsewhere", None]
    assert len(STATE_ABBREVIATIONS) == 40


def test_footnote_label(frame):
    df = frame([("A", "S", "g"), ("A", "S", "h"), ("A", None, None)], "c string, s string, n string")
    label = footnote_label(F.col("c"), F.col("s"), F.col("n"), "g")
    assert [r[0] for r in rows(df.select(label))] == ["A,\nS*", "A,\nS", "A,\nNA"]


def test_lists_are_never_null(frame):
    df = frame([("Delhi",), ("DELHI",), (None,)], "c string")
    assert rows(df.select(in_list(F.col("c"), ["Delhi"]), in_list_ci(F.col("c"), ["delhi"]))) == [
        (True, True), (False, True), (False, False),
    ]


ATTRIBUTES = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("address", "latest_data", "status")]
)


def flat(frame, texts):
    df = frame([(t,) for t in texts], "infos string")
    return rows(flatten_attributes(df, "infos", ATTRIBUTES))


def test_dict_text(frame):
    text = "{'status': 'Delay', 'latest_data': '2031-11-05'}"
    assert flat(frame, [text]) == [(None, "2031-11-05", "Delay")]


def test_apostrophes_inside_strings(frame):
    text = "{'status': 'Live', 'address': \"Miller's Row 5,\\nflat 'B'\"}"
    assert flat(frame, [text])[0][0] == "Miller's Row 5,\nflat 'B'"


def test_json_none_and_missing_text(frame):
    texts = [
        "{'status': 'Closed', 'latest_data': None}",
        None,
        '{"status": null, "latest_data": "yesterday"}',
        "\t",
    ]
    assert [r[1:] for r in flat(frame, texts)] == [
        (None, "Closed"), (None, None), ("yesterday", None), (None, None),
    ]


def test_words_inside_strings_stay(frame):
    texts = ["{'address': 'None of True', 'status': 'it\\'s False'}", '{"status": "a \\"None\\""}']
    assert flat(frame, texts) == [("None of True", None, "it's False"), (None, None, 'a "None"')]


def test_long_text_and_broken_text(frame):
    long = "x" * 200_000
    found = flat(frame, [f"{{'address': '{long}', 'status': 'Live'}}", "{'status': 'Live"])
    assert found == [(long, None, "Live"), (None, None, None)]


def test_strict_parsing_fails(frame):
    df = frame([("{'status': 'Live",)], "infos string")
    with pytest.raises(Exception, match="(?i)malformed"):
        flatten_attributes(df, "infos", ATTRIBUTES, strict=True).collect()


def test_any_dict_of_strings_comes_back(frame):
    """What Python and JSON write of random strings is read back as it was."""
    draw = random.Random(11)
    letters = "ab '\"\\\n\t{}[]:,éNoneTrue_0"
    words = ["None", "True", "it's None", 'say "False"', "", "\\", "{'a': 1}"]
    words += ["".join(draw.choice(letters) for _ in range(draw.randrange(30))) for _ in range(300)]
    dicts = [{"address": w, "latest_data": None, "status": draw.choice(words)} for w in words]
    found = flat(frame, [repr(d) for d in dicts] + [json.dumps(d) for d in dicts])
    assert found == [tuple(d.values()) for d in dicts] * 2


def test_labels_may_hold_quotes(frame):
    bands = {"It's low": 1, "back\\slash": 2}
    df = frame([(0.5,), (1.5,)], "v double")
    assert [r[0] for r in rows(df.select(band("v", bands)))] == list(bands)
    assert column_name("It's low") == "it_s_low"
