"""The same results in plain SQL over the given tables. Nothing here comes from the library."""

from __future__ import annotations

import re

# --- Fixed values: published standards and report texts, written out once more. ---

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
YEARLY_WHO, YEARLY_INDIA = "WHO PM2.5 (2021, yearly)", "India PM2.5 (yearly)"
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
SECTIONS = [
    "Station Statuses", "City Statuses", "Changes in Stations", "Changes in Cities",
    "NCAP cities", "Non-NCAP cities",
]
STATION_STATS = ["CAAQMS installed in India", "CAAQMS with"]
CITY_STATS = ["Cities covered by CAAQMS", "Cities with"]
IN_GROUP_STATS = ["NCAP cities covered by CAAQMS", "NCAP cities with"]
OUT_GROUP_STATS = ["Non-NCAP cities covered by CAAQMS", "Non-NCAP cities with"]
SHARE_STATS = [">80% data", "<80% data but >1% data", "<1% data"]

# --- End of the fixed values. ---


def column_name(label: str) -> str:
    return re.sub(r"\W+", "_", label.lower())


BAND_COLUMNS = [*map(column_name, BANDS), "unbanded"]
GOOD_TO_WORST = ", ".join(map(column_name, BANDS))
WORST_TO_GOOD = ", ".join(reversed([column_name(b) for b in BANDS]))


def case_bin(col: str, breaks: list, labels: list) -> str:
    """CASE over intervals closed on the right."""
    parts = []
    for lower, upper, label in zip(breaks, breaks[1:], labels):
        top = "" if upper == float("inf") else f" AND {col} <= {upper}"
        parts.append(f"WHEN {col} > {lower}{top} THEN '{label}'")
    return f"CASE {' '.join(parts)} END"


def case_map(col: str, mapping: dict, other: str = "NULL") -> str:
    parts = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {parts} ELSE {other} END"


def band_of(col: str) -> str:
    return case_bin(col, [0, *BANDS.values()], list(BANDS))


def flags(col: str) -> str:
    return f"{col} <= 15 AS pass_who, {col} <= 60 AS pass_naaqs, {col} <= 120 AS pass_naaqs2"


def band_sums(col: str) -> str:
    known = [f"count(*) FILTER ({col} = '{b}') AS {column_name(b)}" for b in BANDS]
    return ", ".join([*known, f"count(*) FILTER ({col} IS NULL) AS unbanded"])


MONITORED = f"count(*) FILTER (band IN ('Good', 'Satisfactory', 'Moderate', 'Poor', 'Very Poor')) AS monitored_days"
PASSES = """count(*) AS total,
    count(*) FILTER (pass_who) AS pass_who, count(*) FILTER (NOT pass_who) AS not_pass_who,
    count(*) FILTER (pass_naaqs) AS pass_naaqs, count(*) FILTER (NOT pass_naaqs) AS not_pass_naaqs,
    count(*) FILTER (NOT pass_naaqs2) AS not_pass_naaqs2"""
PERCENT = "round_even(count(*) FILTER (NOT pass_naaqs) / count(*) * 100, 0) AS exceedance_pct"
MEAN = "round(avg(value), 9)"
OUT = "round(mean, 6) AS mean"


def text(col: str) -> str:
    return f"regexp_replace(CAST(round({col}, 6) AS VARCHAR), '\\.0$', '')"


REGISTRY = """
    SELECT concat('loc_', user_id) AS id, concat('Station ', user_id) AS name,
           concat('loc_', user_id - user_id % 2) AS city_id,
           concat('City ', user_id - user_id % 2) AS city_name,
           CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS latest_data,
           {status} AS status
    FROM events GROUP BY user_id HAVING {seen}"""
LAST = "max_by(event_type, event_id) FILTER ({half})"


def station_status(half: str, error: str) -> str:
    return f"""CASE {LAST.format(half=half)} WHEN 'view' THEN 'Live' WHEN 'click' THEN 'live'
           WHEN 'purchase' THEN 'Delay' WHEN 'signup' THEN 'Inactive' WHEN 'error' THEN {error} END"""


CTES: dict[str, tuple[list[str], str]] = {
    "daily": ([], """
    SELECT concat('loc_', user_id) AS location_id, concat('loc_', user_id) AS city_id,
           concat('City ', CASE WHEN user_id % 10 = 1 THEN user_id - 1 ELSE user_id END) AS city_name,
           concat('IND.', n_nationkey, '_1') AS gadm1_id,
           CASE n_name WHEN 'NATION_0' THEN 'Andhra Pradesh' WHEN 'NATION_1' THEN 'West Bengal'
                ELSE n_name END AS gadm1_name,
           'pm25' AS pollutant, 'PM2.5' AS pollutant_name, CAST(ts AS DATE) AS date,
           max(value) AS value
    FROM events JOIN nation ON n_nationkey = user_id % 25
    GROUP BY user_id, n_nationkey, n_name, CAST(ts AS DATE)"""),
    "member": ([], """
    SELECT DISTINCT CASE user_id % 3 WHEN 0 THEN 'ncap_cities' WHEN 1 THEN 'igp_cities'
           ELSE 'other_cities' END AS name, concat('loc_', user_id) AS location_id
    FROM events"""),
    "city": ([], """
    SELECT DISTINCT concat('loc_', user_id) AS id,
           CASE WHEN user_id % 17 <> 0 THEN CAST(68 + user_id % 29 AS DOUBLE) END AS longitude,
           CASE WHEN user_id % 17 <> 0 THEN CAST(8 + user_id % 28 AS DOUBLE) END AS latitude
    FROM events"""),
    "complete": (["daily"], """
    SELECT * FROM daily WHERE city_id IN (
        SELECT city_id FROM daily GROUP BY city_id HAVING count(DISTINCT date) >= 0.8 * 31)"""),
    "tagged": (["complete", "member"], f"""
    SELECT c.*, coalesce(m.name, 'non_ncap_cities') AS name, {flags('value')}, {band_of('value')} AS band
    FROM complete c LEFT JOIN member m ON m.location_id = c.location_id AND m.name = 'ncap_cities'"""),
    "means": (["tagged"], f"""
    SELECT location_id, city_name, CAST(year(date) AS INTEGER) AS year, pollutant, pollutant_name,
           name, gadm1_name, {MEAN} AS mean
    FROM tagged GROUP BY ALL"""),
    "summary": (["means", "city"], f"""
    SELECT s.*, {flags('mean')}, {band_of('mean')} AS band, latitude, longitude
    FROM means s LEFT JOIN city ON id = location_id"""),
    "band_day": (["tagged"], f"""
    SELECT location_id, {band_sums('band')}, {MONITORED}, {PERCENT} FROM tagged GROUP BY location_id"""),
    "entity_pass": (["tagged"], f"""
    SELECT name, location_id, {PASSES} FROM tagged GROUP BY name, location_id"""),
    "frequency": (["entity_pass"], f"""
    SELECT name, location_id, not_pass_who, not_pass_naaqs,
           {case_bin('not_pass_who', [31 * s for s in FREQUENCY_SHARES], FREQUENCY_LABELS)} AS who_bin,
           {case_bin('not_pass_naaqs', [31 * s for s in FREQUENCY_SHARES], FREQUENCY_LABELS)} AS naaqs_bin
    FROM entity_pass"""),
    "bins": ([], "SELECT * FROM (VALUES " + ", ".join(
        f"({i + 1}, '{b}')" for i, b in enumerate(FREQUENCY_LABELS)) + ") AS b(bin_ord, bin)"),
    "mixed": ([], """
    SELECT CAST(CAST(ts AS DATE) - INTERVAL 1 YEAR * CASE event_id % 3 WHEN 1 THEN 1 WHEN 2 THEN 9 ELSE 0 END AS DATE) AS date,
           CASE event_type WHEN 'click' THEN 'station_day_mad' ELSE 'city_day_mad' END AS process_id,
           concat('loc_', user_id) AS location_id, 'observed' AS variable, value,
           CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN 'ppm' ELSE 'µg/m3' END AS unit,
           CASE event_type WHEN 'purchase' THEN 'other' ELSE 'cpcb' END AS source,
           CASE event_type WHEN 'error' THEN 'no2' ELSE 'pm25' END AS pollutant,
           'PM2.5' AS pollutant_name, CASE WHEN user_id % 50 = 0 THEN NULL ELSE 'IN' END AS country_id,
           CASE event_type WHEN 'click' THEN 'station' ELSE 'city' END AS level,
           concat('loc_', user_id) AS city_id, concat('City ', user_id) AS city_name,
           'Region' AS gadm1_name, 'r' AS gadm1_id
    FROM events"""),
    # --- years ---
    "history": ([], """
    SELECT n_name AS location_id, n_name AS city_id, n_name AS city_name, r_name AS gadm1_id,
           r_name AS gadm1_name, 'pm25' AS pollutant, 'PM2.5' AS pollutant_name,
           CAST(l_shipdate AS DATE) AS date, CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(month(l_shipdate) AS INTEGER) AS month, sum(l_quantity) AS value
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL"""),
    "now": (["history"], "SELECT * FROM history WHERE year = 2001 AND month <= 6"),
    "halves": (["history"], """
    SELECT * FROM history h WHERE month <= 6 AND year BETWEEN 1993 AND 2001
      AND (SELECT count(DISTINCT date) FROM history i
           WHERE i.city_id = h.city_id AND i.year = h.year AND i.month <= 6) >= 0.6 * 181"""),
    "halves_tagged": (["halves"], f"""
    SELECT h.*, CASE WHEN n_regionkey % 2 = 0 THEN 'ncap_cities' ELSE 'non_ncap_cities' END AS name,
           {flags('value')}, {band_of('value')} AS band
    FROM halves h JOIN nation ON n_name = location_id"""),
    "year_means": (["halves_tagged"], f"""
    SELECT location_id, city_name, pollutant, pollutant_name, gadm1_name, name, year, {MEAN} AS mean
    FROM halves_tagged GROUP BY ALL"""),
    "year_days": (["halves_tagged"], f"""
    SELECT location_id, year, {band_sums('band')}, {MONITORED}, {PERCENT},
           count(*) FILTER (NOT pass_naaqs) AS not_pass_naaqs
    FROM halves_tagged GROUP BY location_id, year"""),
    "year_table": (["year_means", "year_days"], f"""
    SELECT location_id, city_name, gadm1_name, name, year, monitored_days, mean, exceedance_pct,
           {GOOD_TO_WORST}
    FROM year_means JOIN year_days USING (location_id, year)"""),
    "top_now": (["year_table"], """
    SELECT * FROM (SELECT *, rank() OVER (ORDER BY mean DESC NULLS LAST) AS place
                   FROM year_table WHERE year = 2001) WHERE place <= 10"""),
    "tracked": ([], """
    SELECT n_name AS location_id FROM (
        SELECT n_name, row_number() OVER (PARTITION BY n_regionkey
                                          ORDER BY count(*) DESC, n_nationkey) AS place
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        GROUP BY n_name, n_nationkey, n_regionkey) WHERE place = 1"""),
    # --- stations ---
    "registry_old": ([], REGISTRY.format(
        status=station_status("day(ts) <= 15", "NULL"),
        seen="count(*) FILTER (CAST(ts AS DATE) = DATE '2024-01-01' AND event_type IN ('view', 'click')) > 0")),
    "registry_new": ([], REGISTRY.format(
        status=station_status("day(ts) > 15", "CASE WHEN user_id % 2 = 0 THEN 'Under repair' END"),
        seen="max(CAST(ts AS DATE)) >= DATE '2024-01-30'")),
    "state_pair": (["registry_old", "registry_new"], """
    SELECT coalesce(n.id, o.id) AS id, n.name, n.city_id, n.city_name, n.latest_data,
           lower(n.status) AS status, lower(o.status) AS was, o.id IS NOT NULL AS in_old
    FROM registry_old o FULL JOIN registry_new n ON o.id = n.id"""),
    "changed": (["state_pair"], """
    SELECT id, name, city_id, city_name, latest_data, status,
      CASE
        WHEN NOT in_old AND status IN ('live', 'delay') THEN 'New'
        WHEN NOT in_old AND (status IS NULL OR status = 'inactive') THEN 'No change'
        WHEN status IN ('live', 'delay') AND was IN ('live', 'delay') THEN 'No change'
        WHEN status IN ('live', 'delay') AND (was IS NULL OR was = 'inactive') THEN 'Reactivated'
        WHEN (status IS NULL OR status = 'inactive') AND was IN ('live', 'delay') THEN 'Removed this month'
        WHEN (status IS NULL OR status = 'inactive') AND (was IS NULL OR was = 'inactive')
          THEN 'Removed in a previous month'
        ELSE 'Change undefined' END AS change
    FROM state_pair"""),
    "share": (["daily"], """
    SELECT location_id AS id, count(*) / 31 AS percent_complete,
           CASE WHEN count(*) / 31 < 0.01 THEN 'No data' WHEN count(*) / 31 < 0.8 THEN '<80% data'
                ELSE '>80% data' END AS percent_category
    FROM daily GROUP BY location_id"""),
    "statuses": (["changed", "share"], """
    SELECT c.*, coalesce(percent_complete, 0.0) AS percent_complete,
           coalesce(percent_category, 'No data') AS percent_category
    FROM changed c LEFT JOIN share s ON s.id = c.id"""),
    "city_share": (["statuses"], """
    SELECT city_id, max(percent_complete) AS percent_complete,
           CASE WHEN max(percent_complete) < 0.01 THEN 'No data'
                WHEN max(percent_complete) < 0.8 THEN '<80% data' ELSE '>80% data' END AS percent_category
    FROM statuses GROUP BY city_id"""),
    "fresh_city": (["statuses"], """
    SELECT DISTINCT city_id, city_name FROM statuses s
    WHERE EXISTS (SELECT 1 FROM statuses t WHERE t.city_id IS NOT DISTINCT FROM s.city_id AND change = 'New')
      AND NOT EXISTS (SELECT 1 FROM statuses t
                      WHERE t.city_id IS NOT DISTINCT FROM s.city_id AND change <> 'New')"""),
    # --- completion ---
    "observed": ([], """
    SELECT *, strftime(month, '%Y-%m') AS snapshot_month,
           CAST(day(last_day(month)) AS INTEGER) AS days_in_month,
           days_with_data / day(last_day(month)) AS percent_days
    FROM (SELECT n_nationkey AS location_id, n_name AS city_name, r_name AS gadm1_name,
                 n_regionkey AS gadm1_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
                 count(DISTINCT CAST(l_shipdate AS DATE)) AS days_with_data
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
               JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          GROUP BY ALL)"""),
    "months": (["observed"], "SELECT DISTINCT month, snapshot_month, days_in_month FROM observed"),
    "places": (["observed"], "SELECT DISTINCT location_id, city_name, gadm1_name, gadm1_id FROM observed"),
    "grid": (["months", "places"], """
    SELECT m.month, m.snapshot_month, p.location_id, p.city_name, p.gadm1_name, p.gadm1_id,
           coalesce(o.days_with_data, 0) AS days_with_data, m.days_in_month,
           coalesce(o.days_with_data, 0) / m.days_in_month AS percent_days
    FROM months m CROSS JOIN places p
    LEFT JOIN observed o ON o.month = m.month AND o.location_id = p.location_id"""),
    "month_means": (["grid"], """
    SELECT location_id, round(avg(percent_days), 9) AS mean_percent_days, city_name, gadm1_name
    FROM grid GROUP BY ALL"""),
    "under": (["month_means"], """
    SELECT *, concat(city_name, ', ', gadm1_name) AS location_label
    FROM month_means WHERE mean_percent_days <= 0.8"""),
}


def sql(body: str, *needs: str) -> str:
    """A query with the common tables it needs, each after those it is built from."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in CTES[name][0]:
            add(other)
        if name not in order:
            order.append(name)

    for need in needs:
        add(need)
    tables = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {tables}\n{body}" if order else body


def four_counts(section: str, stats: list[str], source: str, counted: str, below: str = "") -> str:
    shares = [*zip(SHARE_STATS, ["'>80% data'", "'<80% data'" + below, "'No data'"])]
    rows = [f"SELECT 1 AS ord, '{stats[0]}' AS stat, count(*) AS n FROM {source}"]
    rows += [
        f"SELECT {i + 2}, '{stats[1]} {label}', count(*) FILTER (percent_category = {test}) FROM {source}"
        for i, (label, test) in enumerate(shares)
    ]
    return (
        f"SELECT '{section}' AS section, CAST(ord AS INTEGER) AS ord, CAST(1 AS BIGINT) AS pos, stat, "
        f"CAST(n AS VARCHAR) AS value FROM ({' UNION ALL '.join(rows)})"
    )


NOT_TINY = " AND percent_complete > 0.01"
STATION_COUNTS = four_counts(SECTIONS[0], STATION_STATS, "statuses", "")
CITY_COUNTS = four_counts(SECTIONS[1], CITY_STATS, "city_share", "", NOT_TINY)
IN_COUNTS = four_counts(
    SECTIONS[4], IN_GROUP_STATS,
    "(SELECT * FROM city_share WHERE city_id IN (SELECT location_id FROM member WHERE name = 'ncap_cities'))",
    "", NOT_TINY,
)
OUT_COUNTS = four_counts(
    SECTIONS[5], OUT_GROUP_STATS,
    """(SELECT * FROM city_share c WHERE NOT EXISTS (
        SELECT 1 FROM member WHERE name = 'ncap_cities' AND location_id = c.city_id))""",
    "", NOT_TINY,
)


NAME_LISTS = """
    SELECT 'Changes in Stations' AS section, CAST(ord AS INTEGER) AS ord, coalesce(pos, 1) AS pos, stat,
           CASE WHEN pos IS NULL THEN 'No value' ELSE coalesce(name, 'NA') END AS value
    FROM (VALUES (1, 'New stations', 'New'), (2, 'Reactivated stations', 'Reactivated'),
                 (3, 'Removed stations', 'Removed this month')) AS s(ord, stat, class)
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY change ORDER BY name NULLS LAST, id) AS pos
               FROM statuses) l ON l.change = s.class"""


NEW_CITY_LIST = """
    SELECT 'Changes in Cities' AS section, 1 AS ord,
           row_number() OVER (ORDER BY city_name NULLS LAST, city_id) AS pos,
           'Cities with new stations' AS stat, coalesce(city_name, 'NA') AS value
    FROM fresh_city
    UNION ALL
    SELECT 'Changes in Cities', 1, 1, 'Cities with new stations', 'No value'
    WHERE NOT EXISTS (SELECT 1 FROM fresh_city)"""
NOTICE = f"""
    SELECT 'Changes in Cities' AS section, 2 AS ord, CAST(1 AS BIGINT) AS pos,
           CAST(NULL AS VARCHAR) AS stat, '{NEW_CITY_NOTICE}' AS value
    WHERE EXISTS (SELECT 1 FROM fresh_city)"""
PLACE = case_map("section", {s: i + 1 for i, s in enumerate(SECTIONS)})
REPORT = f"""
    SELECT CAST({PLACE} AS INTEGER) AS section_ord, * FROM (
      {' UNION ALL '.join(f'({p})' for p in (
          STATION_COUNTS, CITY_COUNTS, NAME_LISTS, NEW_CITY_LIST, NOTICE,
          IN_COUNTS, OUT_COUNTS))})"""

def high(source: str) -> str:
    return f"""
    SELECT concat('high_pm25_gt', cut) AS type,
           concat('City ', city_id, ' in ', month, ' has an average PM2.5 concentration above ',
                  cut, ' µg/m³: ', {text('mean')}) AS message
    FROM (SELECT city_id, month(date) AS month, {MEAN} AS mean FROM {source} GROUP BY ALL)
         JOIN (VALUES (50), (60)) AS c(cut) ON mean > cut
    WHERE month IN (10, 11, 12, 1, 2)"""


HIGH = high("daily")
UNEXPECTED = f"""
    SELECT 'southern_city_in_top_10' AS type, concat('City ', city_name, ' is in the top 10') AS message
    FROM (SELECT city_id, city_name, gadm1_id, {MEAN} AS mean FROM daily GROUP BY ALL
          ORDER BY mean DESC, city_id LIMIT 10)
    WHERE gadm1_id IN ('IND.16_1', 'IND.17_1', 'IND.31_1', 'IND.2_1')"""
def low(source: str) -> str:
    return f"""
    SELECT CASE WHEN value < 5 THEN 'low_value_lt5' ELSE 'low_value_lt10' END AS type,
           concat('City ', city_id, ' on ', date,
                  CASE WHEN value < 5 THEN ' has a value less than 5: '
                       ELSE ' has a value between 5 and 10: ' END, {text('value')}) AS message
    FROM {source} WHERE value < 10"""


LOW = low("daily")
COVERAGE = """
    SELECT 'wrong_state_number' AS type,
           concat('Number of states in India in analysis was ', count(DISTINCT gadm1_name),
                  ' less than 26') AS message
    FROM summary HAVING count(DISTINCT gadm1_name) < 26"""
NEW_CITY_WARNING = f"""
    SELECT 'new_cities' AS type, '{NEW_CITY_NOTICE}' AS message WHERE EXISTS (SELECT 1 FROM fresh_city)"""

TOP_COLUMNS = f"""location_id, city_name, gadm1_name, name, monitored_days, {OUT}, exceedance_pct,
    {GOOD_TO_WORST}"""


def extreme(direction: str) -> str:
    return sql(f"""
    SELECT {TOP_COLUMNS} FROM (SELECT *, rank() OVER (ORDER BY mean {direction} NULLS LAST) AS place
                               FROM means) JOIN band_day USING (location_id) WHERE place <= 10""",
               "means", "band_day")


def histogram(which: str) -> str:
    return f"""
    SELECT g.name, CAST(bin_ord AS INTEGER) AS bin_ord, bin AS {which},
           count(f.location_id) AS value
    FROM (SELECT DISTINCT name FROM frequency) g CROSS JOIN bins
    LEFT JOIN frequency f ON f.name = g.name AND f.{which} = bin GROUP BY ALL"""


def labels(source: str, star: bool) -> str:
    """Display labels of a table with location_id, city_name and gadm1_name."""
    short = case_map("gadm1_name", STATE_ABBREVIATIONS, "gadm1_name")
    mark = " || CASE WHEN name = 'ncap_cities' THEN '*' ELSE '' END" if star else ""
    return f"""
    SELECT s.*, {short} AS state_abbreviation,
           CASE WHEN show_state THEN concat(city_name, ', ', {short}) ELSE city_name END{mark} AS city_label
    FROM (SELECT t.*, (SELECT count(DISTINCT location_id) > 1 FROM {source} u
                       WHERE u.city_name = t.city_name) AS show_state FROM {source} t) s"""


def calendar(source: str, first: str, months: str) -> str:
    bins = case_bin("value", [0, *CALENDAR_BINS.values()], list(CALENDAR_BINS))
    years = f"""(SELECT location_id, city_name, unnest(generate_series(min(year(date)), max(year(date)))) AS year
           FROM {source} WHERE month(date) <= {months} GROUP BY location_id, city_name)"""
    return f"""
    SELECT location_id, city_name, CAST(y.year AS INTEGER) AS year, day AS date, round(value, 6) AS value,
           CAST(month(day) AS INTEGER) AS month,
           CAST((day(day) - 1 + isodow(date_trunc('month', day)) - 1) // 7 + 1 AS BIGINT) AS week_row,
           CAST(isodow(day) - 1 AS INTEGER) AS weekday, {bins} AS bin
    FROM {years} y
    JOIN (SELECT CAST(unnest(generate_series(DATE '{first}', DATE '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS day) d
      ON year(day) = y.year AND month(day) <= {months}
    LEFT JOIN {source} m USING (location_id, city_name)
    WHERE m.date = day
    UNION ALL
    SELECT location_id, city_name, CAST(y.year AS INTEGER), day, NULL, CAST(month(day) AS INTEGER),
           CAST((day(day) - 1 + isodow(date_trunc('month', day)) - 1) // 7 + 1 AS BIGINT),
           CAST(isodow(day) - 1 AS INTEGER), NULL
    FROM {years} y
    JOIN (SELECT CAST(unnest(generate_series(DATE '{first}', DATE '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS day) d
      ON year(day) = y.year AND month(day) <= {months}
    WHERE NOT EXISTS (SELECT 1 FROM {source} m WHERE m.location_id = y.location_id AND m.date = day)"""


JUNE_MEANS = """
    SELECT location_id, year, round(round(avg(value), 9), 6) AS mean, count(DISTINCT date) AS days
    FROM history WHERE month = 6 AND year BETWEEN 1999 AND 2001
    GROUP BY location_id, year HAVING count(DISTINCT date) >= 15"""


REPORT_TOP_PREV = sql(f"""
    SELECT location_id, city_name, gadm1_name AS "State/UT", monitored_days, {OUT}, exceedance_pct,
           {GOOD_TO_WORST}, year
    FROM year_table WHERE year = 2000 AND location_id IN (SELECT location_id FROM top_now)""",
    "year_table", "top_now")

ORACLES: dict[str, str] = {
    "load_measurements": sql("""
    SELECT * FROM mixed
    WHERE level = 'city' AND process_id = 'city_day_mad' AND source = 'cpcb' AND pollutant = 'pm25'
      AND year(date) BETWEEN 2016 AND 2024 AND month(date) = 1""", "mixed"),
    "landed_rules": sql("""
    , n AS (SELECT count(*) AS total_rows,
                   count(*) FILTER (unit <> 'µg/m3') AS unit, count(*) FILTER (unit IS NULL) AS no_unit,
                   count(*) FILTER (source <> 'cpcb') AS source, count(*) FILTER (pollutant <> 'pm25') AS pollutant,
                   count(*) FILTER (level <> 'city') AS station, count(*) FILTER (country_id IS NULL) AS no_country
            FROM mixed),
    r AS (SELECT unnest(['variable = observed', 'source = cpcb', 'unit = µg/m3', 'pollutant = pm25',
                         'pollutant_name = PM2.5', 'country_id = IN', 'level = city', 'process_id = city_day_mad',
                         'date is date', 'process_id is string', 'location_id is string', 'variable is string',
                         'value is double', 'unit is string', 'source is string', 'pollutant is string',
                         'pollutant_name is string', 'country_id is string', 'level is string', 'city_id is string',
                         'city_name is string', 'gadm1_name is string', 'gadm1_id is string']) AS rule),
    g AS (SELECT unnest(['name is string', 'location_id is string']) AS rule)
    SELECT 'measurements' AS "table", rule,
           CASE rule WHEN 'source = cpcb' THEN source WHEN 'unit = µg/m3' THEN unit
                     WHEN 'pollutant = pm25' THEN pollutant WHEN 'level = city' THEN station
                     WHEN 'process_id = city_day_mad' THEN station ELSE 0 END AS failed_rows,
           CASE rule WHEN 'unit = µg/m3' THEN no_unit WHEN 'country_id = IN' THEN no_country ELSE 0 END AS unknown_rows,
           total_rows, failed_rows + unknown_rows = 0 AS ok
    FROM r CROSS JOIN n
    UNION ALL
    SELECT 'location_presets', rule, 0, 0, (SELECT count(*) FROM member), TRUE FROM g""",
        "mixed", "member").replace("\n\n    , n AS", ", n AS"),
    "missing_columns": """
    SELECT w.t AS "table", w.c AS "column", n.n AS rows
    FROM (VALUES ('events', 'ts'), ('events', 'unit'), ('events', 'value'), ('nation', 'n_name'), ('nation', 'n_code'),
                 ('orders', 'o_orderdate'), ('lineitem', 'l_shipdate'), ('lineitem', 'l_country'), ('lineitem', 'l_level')) w(t, c)
    JOIN (SELECT 'events' AS t, count(*) AS n FROM events UNION ALL SELECT 'nation', count(*) FROM nation
          UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem) n USING (t)
    WHERE NOT EXISTS (SELECT 1 FROM information_schema.columns i WHERE i.table_name = w.t AND i.column_name = w.c)""",
    "load_period_files": """
    SELECT CAST(l_shipdate AS DATE) AS date, n_name AS location_id, l_quantity AS value, n_name AS city_name,
           r_name AS gadm1_name,
           concat('measurements_', strftime(date_trunc('month', l_shipdate), '%Y-%m-%d'), '_',
                  strftime(last_day(l_shipdate), '%Y-%m-%d'), '.csv') AS file
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE l_shipdate >= DATE '2000-01-01'""",
    "load_stations": sql("""
    SELECT id, name, city_id, city_name, 'cpcb' AS source, 'IN' AS country_id, 'station' AS level,
           latest_data, status FROM registry_old""", "registry_old"),
    "load_groups": sql("SELECT name, location_id FROM member", "member"),
    "load_cities": sql("SELECT id, longitude, latitude FROM city", "city"),
    "overshoot_rows": f"""
    SELECT CAST(l_shipdate AS DATE) AS date, concat('loc_', l_suppkey) AS location_id, 'µg/m3' AS unit,
           'cpcb' AS source, 'pm25' AS pollutant, 'IN' AS country_id,
           CASE l_returnflag WHEN 'A' THEN '{YEARLY_WHO}'
                WHEN 'N' THEN '{YEARLY_INDIA}' END AS target_id,
           l_quantity AS target_value, l_extendedprice AS value_overshoot, '1y' AS averaging_period,
           l_discount AS value_avg_so_far, TRUE AS is_overshoot, FALSE AS is_overshoot_estimated
    FROM lineitem WHERE l_discount > 0.05 AND l_linestatus <> 'O'""",
    "load_overshoots": f"""
    SELECT CAST(l_shipdate AS DATE) AS date, concat('loc_', l_suppkey) AS location_id, 'µg/m3' AS unit,
           'cpcb' AS source, 'pm25' AS pollutant, 'IN' AS country_id,
           CASE l_returnflag WHEN 'A' THEN '{YEARLY_WHO}' WHEN 'N' THEN '{YEARLY_INDIA}' END AS target_id,
           l_quantity AS target_value, l_extendedprice AS value_overshoot, '1y' AS averaging_period,
           l_discount AS value_avg_so_far, TRUE AS is_overshoot, FALSE AS is_overshoot_estimated
    FROM lineitem WHERE l_discount > 0.05 AND l_linestatus <> 'O' AND l_shipdate >= DATE '1994-01-01'""",
    "filter_period": sql("""
    SELECT location_id, date, value, year, month FROM history
    WHERE date BETWEEN DATE '2001-01-01' AND DATE '2001-06-30'""", "history"),
    "period_columns": """
    WITH texts AS (
      SELECT unnest([strftime(o_orderdate, '%Y-%m'),
                     concat(year(o_orderdate), CASE WHEN month(o_orderdate) < 7 THEN '-H1' ELSE '-H2' END),
                     strftime(o_orderdate, '%Y-%m-%d')]) AS period FROM orders),
    counts AS (SELECT period, count(*) AS orders FROM texts GROUP BY period),
    starts AS (
      SELECT *, CASE WHEN period LIKE '____-H1' THEN make_date(CAST(left(period, 4) AS BIGINT), 1, 1)
                     WHEN period LIKE '____-H2' THEN make_date(CAST(left(period, 4) AS BIGINT), 7, 1)
                     WHEN length(period) = 7 THEN CAST(concat(period, '-01') AS DATE) END AS start
      FROM counts),
    ends AS (
      SELECT *, CAST(start + CASE WHEN period LIKE '%H%' THEN INTERVAL 6 MONTH ELSE INTERVAL 1 MONTH END
                     - INTERVAL 1 DAY AS DATE) AS "end" FROM starts)
    SELECT period, orders, start, "end",
           CASE WHEN start IS NULL THEN NULL WHEN period LIKE '%H%' THEN 'half_year' ELSE 'month' END AS mode,
           CAST(year(start) AS INTEGER) AS year, CAST("end" - start + 1 AS INTEGER) AS days,
           CAST(start - INTERVAL 1 MONTH AS DATE) AS previous_month
    FROM ends""",
    "flatten_attributes": sql("""
    SELECT id, name, city_id, city_name, concat(name, '''s Road') AS address, latest_data, status,
           CAST(right(id, 1) AS INTEGER) % 2 = 0 AS open FROM registry_new""", "registry_new"),
    "complete_entities": sql("SELECT location_id, city_id, date, value FROM complete", "complete"),
    "previous_periods": sql("""
    SELECT location_id, date, year, month, value FROM halves WHERE year < 2001""", "halves"),
    "tag_flags_bands": sql(f"""
    SELECT d.location_id, date, value, coalesce(m.name, 'non_ncap_cities') AS name,
           {flags('value')}, {band_of('value')} AS band
    FROM daily d LEFT JOIN member m ON m.location_id = d.location_id AND m.name = 'ncap_cities'""",
        "daily", "member"),
    "entity_summary": sql(f"SELECT * REPLACE ({OUT}) FROM summary", "summary"),
    "entity_year_summary": sql(f"""
    SELECT * REPLACE ({OUT}), {flags('mean')}, {band_of('mean')} AS band FROM year_means
    WHERE year < 2001""", "year_means"),
    "group_compliance": sql(f"SELECT name, {PASSES} FROM summary GROUP BY name", "summary"),
    "pass_count": sql(f"""
    SELECT name, {PASSES} FROM (
      SELECT coalesce(m.name, 'non_ncap_cities') AS name, {flags('value')}
      FROM daily d LEFT JOIN member m ON m.location_id = d.location_id AND m.name = 'ncap_cities')
    GROUP BY name""", "daily", "member"),
    "entity_compliance": sql("SELECT * FROM entity_pass", "entity_pass"),
    "exceedance_pct": sql("SELECT location_id, exceedance_pct FROM band_day", "band_day"),
    "exceedance_pct_by_year": sql("""
    SELECT l.location_id, y.year, coalesce(d.not_pass_naaqs, 0) AS not_pass_naaqs, d.exceedance_pct
    FROM (SELECT DISTINCT location_id FROM halves WHERE year < 2001) l
    CROSS JOIN (SELECT DISTINCT year FROM halves WHERE year < 2001) y
    LEFT JOIN year_days d ON d.location_id = l.location_id AND d.year = y.year""", "year_days"),
    "exceedance_frequency": sql("SELECT * FROM frequency", "frequency"),
    "hist_naaqs": sql(histogram("naaqs_bin"), "frequency", "bins"),
    "hist_who": sql(histogram("who_bin"), "frequency", "bins"),
    "band_pivot_by_region": sql(
        f"SELECT gadm1_name, {band_sums('band')} FROM summary GROUP BY gadm1_name", "summary"),
    "band_days": sql("SELECT * EXCLUDE (exceedance_pct) FROM band_day", "band_day"),
    "band_days_by_year": sql("""
    SELECT * EXCLUDE (exceedance_pct, not_pass_naaqs) FROM year_days WHERE year < 2001""", "year_days"),
    "ranked_entities": sql(f"""
    SELECT row_number() OVER (ORDER BY mean DESC NULLS LAST, location_id) AS row_number, city_name,
           gadm1_name AS state_name, m.name AS is_ncap, {OUT}, {WORST_TO_GOOD}, monitored_days,
           pass_who, pass_naaqs
    FROM means m JOIN band_day USING (location_id) JOIN entity_pass USING (location_id)""",
        "means", "band_day", "entity_pass"),
    "top_entities": extreme("DESC"),
    "bottom_entities": extreme("ASC"),
    "same_entities_previous_year": sql(f"""
    SELECT * REPLACE ({OUT}) FROM year_table
    WHERE year = 2000 AND location_id IN (SELECT location_id FROM top_now)""", "year_table", "top_now"),
    "year_on_year": sql(f"""
    SELECT y.* REPLACE ({OUT}), concat(city_name, CASE WHEN name = 'ncap_cities' THEN '*' ELSE '' END)
           AS city_label
    FROM year_table y
    WHERE year IN (2000, 2001) AND location_id IN (SELECT location_id FROM top_now)""",
        "year_table", "top_now"),
    "top_n_frequency": sql(f"""
    , ranked AS (SELECT *, rank() OVER (PARTITION BY date, pollutant, pollutant_name
                                        ORDER BY value DESC NULLS LAST) AS place FROM complete),
    counted AS (SELECT location_id, city_name, gadm1_name, count(*) AS count FROM ranked
                WHERE place <= 10 GROUP BY ALL)
    SELECT location_id, city_label, count FROM ({labels('counted', False)})""", "complete").replace(
        "\n\n    , ranked", ", ranked"),
    "top_per_region": sql(f"""
    SELECT * EXCLUDE (place) REPLACE ({OUT}) FROM (
      SELECT *, rank() OVER (PARTITION BY gadm1_name ORDER BY mean DESC NULLS LAST) AS place
      FROM summary) WHERE place <= 1""", "summary"),
    "named_subset_means": sql(f"""
    SELECT c.location_id, city_name, pollutant, pollutant_name, gadm1_name, m.name,
           round({MEAN}, 6) AS mean
    FROM complete c LEFT JOIN member m ON m.location_id = c.location_id AND m.name = 'ncap_cities'
    WHERE city_name IN (SELECT min(city_name) FROM daily GROUP BY gadm1_name)
    GROUP BY ALL""", "complete", "member"),
    "group_subset_means": sql(f"""
    SELECT g.* REPLACE ({OUT}), latitude, longitude, {band_of('mean')} AS band FROM (
      SELECT c.location_id, city_name, pollutant, pollutant_name, gadm1_name, m.name, {MEAN} AS mean
      FROM complete c JOIN member m ON m.location_id = c.location_id AND m.name = 'igp_cities'
      WHERE city_name IN (
        SELECT concat('City ', user_id) FROM events GROUP BY user_id
        HAVING count(*) > (SELECT avg(n) FROM (SELECT count(*) AS n FROM events GROUP BY user_id)))
      GROUP BY ALL) g LEFT JOIN city ON id = location_id""", "complete", "member", "city"),
    "tracked_all_years": sql(f"""
    SELECT location_id, city_name, round(mean, 6) AS mean, {GOOD_TO_WORST}, unbanded, monitored_days,
           exceedance_pct, CASE WHEN year < 2001 THEN year END AS year,
           CASE WHEN year < 2001 THEN not_pass_naaqs END AS not_pass_naaqs
    FROM year_means JOIN year_days USING (location_id, year)
    WHERE location_id IN (SELECT location_id FROM tracked)""", "year_means", "year_days", "tracked"),
    "tracked_daily": sql("""
    SELECT location_id, date, value, year, month FROM history
    WHERE location_id IN (SELECT location_id FROM tracked) AND year = 2001 AND month <= 6
    UNION ALL
    SELECT location_id, date, value, year, month FROM halves
    WHERE location_id IN (SELECT location_id FROM tracked) AND year < 2001""",
        "history", "halves", "tracked"),
    "display_labels": sql(f"""
    SELECT location_id, city_name, show_state, state_abbreviation, city_label
    FROM ({labels('summary', True)})""", "summary"),
    "footnote_labels": sql("""
    SELECT location_id, concat(city_name, ',', chr(10), gadm1_name,
                               CASE WHEN name = 'ncap_cities' THEN '*' ELSE '' END) AS label
    FROM summary""", "summary"),
    "rule_report": sql("""
    , n AS (SELECT count(*) AS total_rows, count(*) FILTER (NOT value > 5) AS low,
                   count(*) FILTER (gadm1_name = 'West Bengal') AS west FROM daily),
    r AS (SELECT unnest(['variable = observed', 'source = cpcb', 'unit = µg/m3', 'pollutant = pm25',
                         'pollutant_name = PM2.5', 'country_id = IN', 'level = city',
                         'process_id = city_day_mad', 'value is double', 'date is string',
                         'value over 5', 'known region']) AS rule)
    SELECT rule, total_rows,
           CASE rule WHEN 'date is string' THEN total_rows WHEN 'value over 5' THEN low
                     WHEN 'known region' THEN west ELSE 0 END AS failed_rows,
           CAST(0 AS BIGINT) AS unknown_rows, failed_rows = 0 AS ok
    FROM r CROSS JOIN n""", "daily").replace("\n\n    , n AS", ", n AS"),
    "limit_checks": sql("""
    SELECT 'entities' AS check, count(DISTINCT city_id) AS observed, CAST(289 AS DOUBLE) AS "limit",
           'at most' AS relation, count(DISTINCT city_id) <= 289 AS ok FROM daily
    UNION ALL
    SELECT 'group_entities', count(DISTINCT location_id), 131, 'at most', count(DISTINCT location_id) <= 131
    FROM daily JOIN member USING (location_id) WHERE name = 'ncap_cities'
    UNION ALL
    SELECT 'days', count(DISTINCT date), 0.8 * 31, 'at least', count(DISTINCT date) >= 0.8 * 31 FROM daily""",
        "daily", "member"),
    "warn_high_season": sql(HIGH, "daily"),
    "warn_unexpected_top": sql(UNEXPECTED, "daily"),
    "warn_low_values": sql(LOW, "daily"),
    "duplicate_entries": """
    SELECT concat('loc_', user_id) AS location_id, CAST(ts AS DATE) AS date, count(*) AS entries
    FROM events GROUP BY user_id, CAST(ts AS DATE) HAVING count(*) > 1""",
    "warnings_log": sql(f"""
    SELECT type, count(*) AS warnings, min(message) AS first_message, max(message) AS last_message
    FROM (({HIGH}) UNION ALL ({UNEXPECTED}) UNION ALL ({LOW}) UNION ALL ({NEW_CITY_WARNING})
          UNION ALL ({COVERAGE})) GROUP BY type""", "daily", "summary", "fresh_city"),
    "region_coverage": sql(COVERAGE, "summary"),
    "missing_coordinates": sql(f"""
    SELECT * REPLACE ({OUT}) FROM summary WHERE latitude IS NULL OR longitude IS NULL""", "summary"),
    "reconcile_counts": sql("""
    SELECT *, stations = statuses AS ok FROM (
      SELECT (SELECT count(*) FROM registry_new) AS stations, (SELECT count(*) FROM changed) AS statuses)""",
        "registry_new", "changed"),
    "vanished_stations": sql("""
    SELECT id, change FROM changed WHERE id NOT IN (SELECT id FROM registry_new)""",
        "registry_new", "changed"),
    "many_to_one": sql("""
    SELECT city_name, count(*) AS entries FROM daily GROUP BY city_name HAVING count(*) > 1""", "daily"),
    "compliance_invariant": sql("""
    SELECT coalesce(m.name, 'non_ncap_cities') AS name, d.location_id, count(*) AS total,
           count(*) FILTER (value < 1) AS pass_who_unknown,
           count(*) FILTER (value < 1) AS pass_naaqs_unknown,
           count(*) FILTER (value < 1) AS pass_naaqs2_unknown
    FROM daily d LEFT JOIN member m ON m.location_id = d.location_id AND m.name = 'ncap_cities'
    GROUP BY ALL HAVING count(*) FILTER (value < 1) > 0""", "daily", "member"),
    "report_sizes": sql(f"""
    SELECT 'statuses' AS output, count(*) AS rows FROM statuses
    UNION ALL SELECT 'statuses_summary.md', count(*) FROM ({REPORT})
    UNION ALL SELECT 'monthly_compliance', count(DISTINCT name) FROM summary
    UNION ALL SELECT 'cities_grap_distribution', count(DISTINCT gadm1_name) FROM summary
    UNION ALL SELECT 'all_cities_ordered', count(*) FROM summary
    UNION ALL SELECT 'top10_polluted_cities', count(*) FROM (
      SELECT rank() OVER (ORDER BY mean DESC NULLS LAST) AS place FROM means) WHERE place <= 10
    UNION ALL SELECT 'top10_cleanest_cities', count(*) FROM (
      SELECT rank() OVER (ORDER BY mean NULLS LAST) AS place FROM means) WHERE place <= 10
    UNION ALL SELECT 'top10_polluted_cities_prev', count(*) FROM means WHERE year < 2024
    UNION ALL SELECT 'top5_populous_cities', count(*) FROM means
    UNION ALL SELECT 'warnings', count(*) FROM (
      ({HIGH}) UNION ALL ({UNEXPECTED}) UNION ALL ({LOW}) UNION ALL ({NEW_CITY_WARNING})
      UNION ALL ({COVERAGE}))
    UNION ALL SELECT 'overshooting', count(*) FROM lineitem WHERE l_discount > 0.05 AND l_linestatus <> 'O'
    UNION ALL SELECT 'measurement_completion_monthly', count(DISTINCT location_id) FROM daily
    UNION ALL SELECT 'measurement_completion_monthly_summary', count(DISTINCT month(date)) FROM daily
    UNION ALL SELECT 'measurement_completion_period_under_80', count(*) FROM (
      SELECT location_id FROM daily GROUP BY location_id HAVING round(count(DISTINCT date) / 31, 9) <= 0.8)""",
        "statuses", "city_share", "fresh_city", "member", "summary"),
    "report_top_prev": REPORT_TOP_PREV,
    "report_kept_rollup": REPORT_TOP_PREV,
    "report_tracked": sql(f"""
    SELECT location_id, city_name, round(mean, 6) AS mean, {GOOD_TO_WORST}, unbanded, monitored_days,
           exceedance_pct, CASE WHEN year < 2001 THEN year END AS year,
           CASE WHEN year < 2001 THEN not_pass_naaqs END AS not_pass_naaqs
    FROM year_means JOIN year_days USING (location_id, year)
    WHERE location_id IN (SELECT location_id FROM tracked)""", "year_means", "year_days", "tracked"),
    "report_warnings": sql(f"""
    SELECT type, message FROM (({high('now')}) UNION ALL ({low('now')}) UNION ALL ({NEW_CITY_WARNING})
      UNION ALL SELECT 'wrong_state_number', concat('Number of states in India in analysis was ',
                       count(DISTINCT gadm1_name), ' less than 26')
                FROM halves WHERE year = 2001 HAVING count(DISTINCT gadm1_name) < 26)""",
        "now", "halves", "fresh_city"),
    "report_completion": sql("""
    SELECT month, snapshot_month, count(DISTINCT location_id) AS total_locations,
           count(*) FILTER (days_with_data > 0) AS locations_with_any_data,
           count(*) FILTER (percent_days >= 0.6) AS locations_with_80_percent_data,
           round(round(avg(percent_days), 9), 6) AS mean_percent_days,
           round(median(percent_days), 6) AS median_percent_days
    FROM grid GROUP BY month, snapshot_month""", "grid"),
    "top_n_frequency_ties": sql(f"""
    , ranked AS (SELECT *, rank() OVER (PARTITION BY date, pollutant, pollutant_name
                                        ORDER BY floor(value / 20) DESC NULLS LAST) AS place FROM daily),
    counted AS (SELECT location_id, city_name, gadm1_name, count(*) AS count FROM ranked
                WHERE place <= 10 GROUP BY ALL)
    SELECT location_id, city_label, count FROM ({labels('counted', False)})""", "daily").replace(
        "\n\n    , ranked", ", ranked"),
    "status_change": sql("SELECT * FROM changed", "changed"),
    "completeness": sql("SELECT * REPLACE (round(percent_complete, 6) AS percent_complete) FROM share", "share"),
    "status_table": sql("""
    SELECT * REPLACE (round(percent_complete, 6) AS percent_complete) FROM statuses""", "statuses"),
    "status_counts": sql(STATION_COUNTS, "statuses"),
    "group_completeness": sql(CITY_COUNTS, "city_share"),
    "change_lists": sql(NAME_LISTS, "statuses"),
    "new_cities": sql("SELECT * FROM fresh_city", "fresh_city"),
    "group_in": sql(IN_COUNTS, "city_share", "member"),
    "group_out": sql(OUT_COUNTS, "city_share", "member"),
    "status_report": sql(REPORT, "statuses", "city_share", "fresh_city", "member"),
    "status_report_lines": sql(f"""
    SELECT section_ord, ord, pos,
           concat(CASE WHEN ord = 1 AND pos = 1 THEN
                    concat(CASE WHEN section_ord > 1 THEN chr(10) ELSE '' END, '## ', section, chr(10), chr(10))
                  ELSE '' END,
                  CASE WHEN stat IS NULL THEN concat('*', value, '*')
                       ELSE concat('- ', stat, ': ', value) END) AS line
    FROM ({REPORT})""", "statuses", "city_share", "fresh_city", "member"),
    "observed_completion": sql("""
    SELECT * REPLACE (round(percent_days, 6) AS percent_days) FROM observed""", "observed"),
    "entity_metadata": sql("SELECT * FROM places", "places"),
    "month_dimension": sql("SELECT * FROM months", "months"),
    "completion_grid": sql("SELECT * REPLACE (round(percent_days, 6) AS percent_days) FROM grid", "grid"),
    "completion_order": sql("""
    SELECT * REPLACE (round(mean_percent_days, 6) AS mean_percent_days) FROM month_means""", "month_means"),
    "completion_summary": sql("""
    SELECT month, snapshot_month, count(DISTINCT location_id) AS total_locations,
           count(*) FILTER (days_with_data > 0) AS locations_with_any_data,
           count(*) FILTER (percent_days >= 0.8) AS locations_with_80_percent_data,
           round(round(avg(percent_days), 9), 6) AS mean_percent_days,
           round(median(percent_days), 6) AS median_percent_days
    FROM grid GROUP BY month, snapshot_month""", "grid"),
    "under_threshold": sql("""
    SELECT * REPLACE (round(mean_percent_days, 6) AS mean_percent_days) FROM under""", "under"),
    "under_threshold_grid": sql("""
    SELECT g.* REPLACE (round(percent_days, 6) AS percent_days), location_label
    FROM grid g JOIN under USING (location_id)""", "grid", "under"),
    "under_threshold_order": sql("""
    SELECT * REPLACE (round(mean_percent_days, 6) AS mean_percent_days) FROM under""", "under"),
    "calendar_gap_years": sql(
        ", gaps AS (SELECT * FROM history WHERE year NOT IN (1994, 1996, 1997))" + calendar("gaps", "1990-01-01", "6"),
        "history"),
    "kept_store_days": sql("""
    SELECT location_id, date, value, year, month FROM history
    WHERE month = 6 AND year BETWEEN 1999 AND 2001 AND location_id IN (SELECT location_id FROM tracked)
      AND (city_id, year) IN (SELECT (city_id, year) FROM history WHERE month = 6
                              GROUP BY city_id, year HAVING count(DISTINCT date) >= 15)""", "history", "tracked"),
    "kept_store_corrected": sql(JUNE_MEANS, "history"),
    "kept_store_added": sql(JUNE_MEANS, "history"),
    "quarantined_rows": sql("""
    SELECT location_id, CASE WHEN CAST(location_id[5:] AS BIGINT) % 7 = 0 OR CAST(location_id[5:] AS BIGINT) % 11 = 0
                             THEN 'broken' ELSE 'read' END AS kind, count(*) AS rows
    FROM daily GROUP BY ALL""", "daily"),
    "broken_row_rule": sql("""
    SELECT 'measurements' AS "table", unnest(['row parses', 'level = city']) AS rule,
           unnest([count(*) FILTER (CAST(location_id[5:] AS BIGINT) % 7 = 0), 0]) AS failed_rows,
           CAST(0 AS BIGINT) AS unknown_rows, count(*) AS total_rows,
           unnest([count(*) FILTER (CAST(location_id[5:] AS BIGINT) % 7 = 0) = 0, true]) AS ok
    FROM daily WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
       OR CAST(location_id[5:] AS BIGINT) % 7 = 0""", "daily"),
    "broken_documents": """
    SELECT concat('loc_', l_suppkey) AS location_id,
           CASE WHEN l_suppkey % 9 <> 0
                THEN count(*) FILTER (l_discount > 0.05 AND l_linestatus <> 'O') END AS records,
           CASE WHEN l_suppkey % 9 = 0 THEN '{"data":[' END AS start
    FROM lineitem GROUP BY l_suppkey
    HAVING l_suppkey % 9 = 0 OR count(*) FILTER (l_discount > 0.05 AND l_linestatus <> 'O') > 0""",
    "landed_twice": """
    SELECT strftime(l_shipdate, '%Y-%m') AS period,
           concat('measurements_', strftime(date_trunc('month', l_shipdate), '%Y-%m-%d'), '_',
                  strftime(last_day(l_shipdate), '%Y-%m-%d')) AS file,
           count(*) AS rows, round(sum(l_quantity), 6) AS quantity,
           CAST(CASE WHEN any_value(month(l_shipdate)) % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS number,
           CAST(0 AS BIGINT) AS landed_again
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY ALL""",
    "published_report": sql("""
    SELECT s.location_id, round(s.mean, 6) AS mean, e.exceedance_pct FROM summary s
    JOIN band_day e USING (location_id)""", "summary", "band_day"),
    "observed_completion_half_year": """
    WITH rows AS (
      SELECT n_nationkey AS location_id, n_name AS city_name, r_name AS gadm1_name, n_regionkey AS gadm1_id,
             CAST(l_shipdate AS DATE) AS date,
             make_date(year(l_shipdate), CASE WHEN month(l_shipdate) < 7 THEN 1 ELSE 7 END, 1) AS half
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
           JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    asked AS (SELECT DISTINCT location_id, city_name, gadm1_name, gadm1_id, half, CAST(half + to_months(CAST(k AS INTEGER)) AS DATE) AS month
              FROM rows, range(6) t(k))
    SELECT a.location_id, a.city_name, a.gadm1_name, a.gadm1_id, count(DISTINCT r.date) AS days_with_data, a.month,
           strftime(a.month, '%Y-%m') AS snapshot_month, CAST(day(last_day(a.month)) AS INTEGER) AS days_in_month,
           round(count(DISTINCT r.date) / day(last_day(a.month)), 6) AS percent_days
    FROM asked a LEFT JOIN rows r ON r.location_id = a.location_id AND date_trunc('month', r.date) = a.month
    GROUP BY a.location_id, a.city_name, a.gadm1_name, a.gadm1_id, a.month""",
    "calendar_cells": sql(calendar("daily", "2024-01-01", "1"), "daily"),
    "calendar_cells_half_year": sql(calendar("history", "1990-01-01", "6"), "history"),
    "map_points": sql(f"""
    SELECT location_id, city_name, longitude, latitude, {OUT}, band,
           {case_map('band', BAND_COLOURS)} AS colour
    FROM summary WHERE latitude IS NOT NULL AND longitude IS NOT NULL""", "summary"),
    "donut_slices": sql(f"""
    SELECT *, CAST(sum(value) OVER (PARTITION BY name) AS BIGINT) AS centre
    FROM ({histogram('naaqs_bin')})""", "frequency", "bins"),
}
