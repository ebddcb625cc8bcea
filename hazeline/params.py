"""Report parameters and the fixed values they default to."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# --- Fixed values: they must equal the published standards and report conventions. ---

BANDS = {
    "Good": 30,
    "Satisfactory": 60,
    "Moderate": 90,
    "Poor": 120,
    "Very Poor": 250,
    "Severe": 1500,
}

BAND_COLOURS = {
    "Good": "#5A8E42",
    "Satisfactory": "#00FF40",
    "Moderate": "#FF8000",
    "Poor": "#FF0000",
    "Very Poor": "#800000",
    "Severe": "#000000",
}

CALENDAR_BINS = {
    "0-30": 30,
    "31-60": 60,
    "61-90": 90,
    "91-120": 120,
    "121-250": 250,
    ">250": float("inf"),
}

FREQUENCY_SHARES = [-0.01, 0.01, 0.25, 0.5, 0.75, 0.99, 1]
FREQUENCY_LABELS = ["0%", "25%", "50%", "75%", "99%", "100%"]

HIGH_SEASON_MONTHS = [10, 11, 12, 1, 2]
HIGH_SEASON_CUTS = [100, 200]

WATCHED_REGIONS = {
    "IND.16_1": "Karnataka",
    "IND.17_1": "Kerala",
    "IND.31_1": "Tamil Nadu",
    "IND.2_1": "Andhra Pradesh",
}

OVERSHOOT_STANDARDS = {
    "ae5dc5c0-863c-11ef-b57b-e6cf434e9f43": "WHO PM2.5 (2021, yearly)",
    "ae5dcdfe-863c-11ef-b57b-e6cf434e9f43": "WHO PM2.5 (2005, yearly)",
    "ae5e689a-863c-11ef-b57b-e6cf434e9f43": "India PM2.5 (yearly)",
}

STATE_CAPITALS = [
    "Amaravati", "Itanagar", "Dispur", "Patna", "Raipur", "Panaji", "Gandhinagar",
    "Chandigarh", "Shimla", "Ranchi", "Bangalore", "Thiruvananthapuram", "Bhopal",
    "Mumbai", "Imphal", "Shillong", "Aizawl", "Kohima", "Bhubaneswar", "Jaipur",
    "Gangtok", "Chennai", "Hyderabad", "Agartala", "Lucknow", "Dehradun", "Kolkata",
    "Port Blair", "Daman", "Delhi", "Srinagar", "Jammu", "Leh", "Kargil", "Kavaratti",
    "Puducherry",
]

PLAIN_CITIES_MILLION = [
    "Agra", "Amritsar", "Asanol", "Bareilly", "Chandigarh", "Dehradun", "Delhi",
    "Faridabad", "Ghaziabad", "Gorakhpur", "Jalandhar", "Kanpur", "Kolkata", "Lucknow",
    "Ludhiana", "Meerut", "Muradabad", "Patna", "Prayagraj", "Siliguri", "Varanasi",
]

TRACKED_CITIES = {
    "delhi_ind.25_1_in": "Delhi",
    "mumbai_ind.20_1_in": "Mumbai",
    "kolkata_ind.36_1_in": "Kolkata",
    "bangalore_ind.16_1_in": "Bangalore",
    "chennai_ind.31_1_in": "Chennai",
}

STATE_ABBREVIATIONS = {
    "Andaman and Nicobar": "AN",
    "Andaman and Nicobar Islands": "AN",
    "Andhra Pradesh": "AP",
    "Arunachal Pradesh": "AR",
    "Assam": "AS",
    "Bihar": "BR",
    "Chandigarh": "CH",
    "Chhattisgarh": "CG",
    "Dadra and Nagar Haveli": "DN",
    "Dadra and Nagar Haveli and Daman and Diu": "DNHDD",
    "Daman and Diu": "DD",
    "Delhi": "DL",
    "Goa": "GA",
    "Gujarat": "GJ",
    "Haryana": "HR",
    "Himachal Pradesh": "HP",
    "Jammu and Kashmir": "JK",
    "Jharkhand": "JH",
    "Karnataka": "KA",
    "Kerala": "KL",
    "Ladakh": "LA",
    "Lakshadweep": "LD",
    "Madhya Pradesh": "MP",
    "Maharashtra": "MH",
    "Manipur": "MN",
    "Meghalaya": "ML",
    "Mizoram": "MZ",
    "Nagaland": "NL",
    "Odisha": "OD",
    "Orissa": "OD",
    "Puducherry": "PY",
    "Punjab": "PB",
    "Rajasthan": "RJ",
    "Sikkim": "SK",
    "Tamil Nadu": "TN",
    "Telangana": "TG",
    "Tripura": "TR",
    "Uttar Pradesh": "UP",
    "Uttarakhand": "UK",
    "West Bengal": "WB",
}

NEW_CITY_NOTICE = (
    "Please inform the Data team if any of the new cities needs to be added to NCAP cities or "
    "other groups. This analysis will need to be rerun if that is the case."
)

# --- End of the fixed values. ---


@dataclass(frozen=True)
class Params:
    """What one report run may vary. Every default is the published convention."""

    max_entities: int = 289
    max_group_entities: int = 131
    day_share: float = 0.8
    low_value: float = 5
    moderate_value: float = 10
    who_limit: float = 15
    naaqs_limit: float = 60
    bands: dict[str, float] = field(default_factory=lambda: dict(BANDS))
    high_season_months: list[int] = field(default_factory=lambda: list(HIGH_SEASON_MONTHS))
    high_season_cuts: list[int] = field(default_factory=lambda: list(HIGH_SEASON_CUTS))
    watched_regions: dict[str, str] = field(default_factory=lambda: dict(WATCHED_REGIONS))
    expected_regions: int = 26
    history_years: int = 8
    top_n: int = 10
    group: str = "ncap_cities"
    other_group: str = "non_ncap_cities"
    subset_group: str = "igp_cities"
    include_severe: bool = False
    # Sums of doubles depend on the order tasks finish in. Rounding every mean keeps
    # ties, limits and band edges the same from run to run.
    mean_decimals: int = 9


DEFAULTS = Params()


def column_name(label: str) -> str:
    """Column spelling of a band label: 'Very Poor' is very_poor."""
    return re.sub(r"\W+", "_", label.lower())


def sql_text(text: str) -> str:
    """A text as a SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
