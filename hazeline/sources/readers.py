"""Readers of landed tables: declared schemas, filters that reach the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.labels import lookup
from hazeline.functions.numbers import clean_double
from hazeline.functions.periods import Period
from hazeline.operators.checks import require_columns
from hazeline.params import OVERSHOOT_STANDARDS

TEXT, DOUBLE, DATE, FLAG = T.StringType(), T.DoubleType(), T.DateType(), T.BooleanType()


def _schema(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The columns of the landed tables, in order.
MEASUREMENTS = _schema(
    {
        "date": DATE, "process_id": TEXT, "location_id": TEXT, "variable": TEXT,
        "value": DOUBLE, "unit": TEXT, "source": TEXT, "pollutant": TEXT,
        "pollutant_name": TEXT, "country_id": TEXT, "level": TEXT, "city_id": TEXT,
        "city_name": TEXT, "gadm1_name": TEXT, "gadm1_id": TEXT,
    }
)
STATIONS = _schema(
    {
        "id": TEXT, "name": TEXT, "city_id": TEXT, "city_name": TEXT, "infos": TEXT,
        "source": TEXT, "country_id": TEXT, "level": TEXT,
    }
)
GROUPS = _schema({"name": TEXT, "location_id": TEXT})
CITIES = _schema(
    {
        "id": TEXT, "name": TEXT, "gadm1_id": TEXT, "country_id": TEXT, "level": TEXT,
        "longitude": DOUBLE, "latitude": DOUBLE,
    }
)
OVERSHOOTS = _schema(
    {
        "date": DATE, "location_id": TEXT, "unit": TEXT, "source": TEXT, "pollutant": TEXT,
        "country_id": TEXT, "target_id": TEXT, "target_value": DOUBLE,
        "value_overshoot": DOUBLE, "averaging_period": TEXT, "value_avg_so_far": DOUBLE,
        "is_overshoot": FLAG, "is_overshoot_estimated": FLAG,
    }
)
STATION_INFOS = _schema({"latest_data": TEXT, "status": TEXT})
#: The column that holds what doesn't parse.
BROKEN = "_broken"
PERIOD_FILE = r"^measurements_20\d{2}-\d{2}-\d{2}_20\d{2}-\d{2}-\d{2}[.]csv$"
PERIOD_GLOB = "measurements_20??-??-??_20??-??-??.csv"


def measurement_rules(level: str) -> dict[str, Column]:
    """Rules of the landed measurements of one level."""
    wanted = {
        "variable": "observed", "source": "cpcb", "unit": "µg/m3", "pollutant": "pm25",
        "pollutant_name": "PM2.5", "country_id": "IN", "level": level,
        "process_id": f"{level}_day_mad",
    }
    return {f"{c} = {v}": F.col(c) == v for c, v in wanted.items()}


def station_rules() -> dict[str, Column]:
    wanted = {"source": "cpcb", "country_id": "IN", "level": "station"}
    return {f"{c} = {v}": F.col(c) == v for c, v in wanted.items()}


def city_rules() -> dict[str, Column]:
    return {f"{c} = {v}": F.col(c) == v for c, v in {"country_id": "IN", "level": "city"}.items()}


def table_rules() -> dict[str, tuple[T.StructType, dict[str, Column]]]:
    """Columns and rules of every landed table, by its name."""
    return {
        "measurements": (MEASUREMENTS, measurement_rules("city")),
        "station_measurements": (MEASUREMENTS, measurement_rules("station")),
        "stations": (STATIONS, station_rules()),
        "stations_previous": (STATIONS, station_rules()),
        "location_presets": (GROUPS, {}),
        "cities": (CITIES, city_rules()),
    }


def parse_rules(df: DataFrame) -> dict[str, Column]:
    """The rule that a row parses, where the table tells; types of others are checked on the schema."""
    return {"row parses": F.col(BROKEN).isNull()} if BROKEN in df.columns else {}


def type_rules(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


def _csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """CSV files with the declared types, columns in the order of their header.

    A file whose header has another order is an error, not a mix-up. ``BROKEN`` holds the line
    of a row that doesn't parse, and is NULL for others.
    """
    options = {
        "header": True, "enforceSchema": False, "nullValue": "NA",
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, **options,
    }
    # Names only, from a header line; types are never inferred.
    found = require_columns(spark.read.options(**options).csv(path), schema.fieldNames())
    types = {f.name: f.dataType for f in schema}
    as_landed = T.StructType([T.StructField(c, types.get(c, TEXT)) for c in found.columns])
    rows = spark.read.options(**options).schema(as_landed.add(BROKEN, TEXT)).csv(path)
    return _whole_rows(rows)


def _whole_rows(df: DataFrame) -> DataFrame:
    """``BROKEN`` of whole rows: the reader only parses columns that a query needs, so telling
    which rows are broken has to need them all."""
    needed = F.xxhash64(*[c for c in df.columns if c != BROKEN]) >= F.lit(-(1 << 63))
    return df.withColumn(BROKEN, F.when(needed, F.col(BROKEN)))


def parsed(df: DataFrame) -> DataFrame:
    """Rows that parsed, without the column that tells."""
    return df.where(F.col(BROKEN).isNull()).drop(BROKEN) if BROKEN in df.columns else df


def _broken(df: DataFrame) -> DataFrame:
    """(file_name, record) of what didn't parse, as it stands in its file."""
    where = F.col("_metadata.file_path").alias("file_name")
    return df.where(F.col(BROKEN).isNotNull()).select(where, F.col(BROKEN).alias("record"))


def broken_rows(spark: SparkSession, path: str, schema: T.StructType = MEASUREMENTS) -> DataFrame:
    """(file_name, record): the lines of CSV files that don't parse, for a quarantine table.

    A line is broken if it has a value of another type or fewer columns than the header.
    """
    return _broken(_csv(spark, path, schema))


def broken_period_rows(spark: SparkSession, root: str) -> DataFrame:
    """The same of the period files below a folder."""
    df = _period_files(spark, root)
    if df is None:
        return spark.range(0).select(*[F.lit(None).cast(TEXT).alias(c) for c in ("file_name", "record")])
    return _broken(df)


def _landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """A landed table with at least the declared columns; broken CSV rows are left in."""
    if fmt == "csv":
        return _csv(spark, path, schema)
    return require_columns(spark.read.format(fmt).load(path), schema.fieldNames())


def _as_landed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns, and the one that tells broken rows if there is one."""
    return df.select(*schema.fieldNames(), *([BROKEN] if BROKEN in df.columns else []))


def _months(periods: list[tuple[dt.date, dt.date]]) -> list[tuple[int, int]]:
    """(year, month) of every month that a period touches."""
    found = set()
    for start, end in periods:
        first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
        found |= {(m // 12, m % 12 + 1) for m in range(first, last + 1)}
    return sorted(found)


def landed_measurements(
    spark: SparkSession, path: str, periods: list[tuple[dt.date, dt.date]], fmt: str = "parquet"
) -> DataFrame:
    """All landed rows of one or more date ranges, whatever their level or source.

    On files partitioned by year, or by year and month, these are pruned as well as filtered.
    Rows of CSV files that don't parse are among them, whatever their date, with their line in
    ``BROKEN``, so that rule reports count them; ``chosen_measurements`` leaves them out.
    """
    df = _landed(spark, path, MEASUREMENTS, fmt)
    date = F.col("date")
    wanted = F.lit(False)
    for start, end in periods:
        wanted = wanted | date.between(F.lit(start), F.lit(end))
    months = _months(periods)
    if "year" in df.columns:
        df = df.where(F.col("year").isin(sorted({year for year, _ in months})))
    if "month" in df.columns:
        # The months of the ranges, so a month's report lists one folder a year.
        df = df.where(F.col("month").cast("int").isin(sorted({month for _, month in months})))
    if BROKEN in df.columns:
        wanted = wanted | F.col(BROKEN).isNotNull()
    return _as_landed(df.where(wanted), MEASUREMENTS)


def chosen_measurements(
    landed: DataFrame, level: str, source: str = "cpcb", pollutant: str = "pm25"
) -> DataFrame:
    """Rows that parsed, of one level, source and pollutant, with values that are no numbers NULL."""
    df = parsed(landed).where(
        (F.col("level") == level) & (F.col("process_id") == f"{level}_day_mad")
        & (F.col("source") == source) & (F.col("pollutant") == pollutant)
    )
    return df.withColumn("value", clean_double("value"))


def load_measurements(
    spark: SparkSession, path: str, level: str, periods: list[tuple[dt.date, dt.date]],
    source: str = "cpcb", pollutant: str = "pm25", fmt: str = "parquet",
) -> DataFrame:
    """Daily values of one level, source and pollutant for one or more date ranges."""
    return chosen_measurements(landed_measurements(spark, path, periods, fmt), level, source, pollutant)


def history_periods(period: Period, years: int) -> list[tuple[dt.date, dt.date]]:
    """The period itself and the same window of the years before."""
    earlier = [period.in_year(y) for y in range(period.year - years, period.year)]
    return [*earlier, (period.start, period.end)]


def landed_cities(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _as_landed(_landed(spark, path, CITIES, fmt), CITIES)


def landed_stations(
    spark: SparkSession, path: str, snapshot_month: dt.date, fmt: str = "parquet"
) -> DataFrame:
    """The registry as it was in a month; ``path`` is partitioned by snapshot_month=YYYY-MM."""
    df = _landed(spark, path, STATIONS, fmt)
    # Partition values may be read as dates or as text.
    month = F.substring(F.col("snapshot_month").cast("string"), 1, 7)
    return _as_landed(df.where(month == f"{snapshot_month:%Y-%m}"), STATIONS)


def landed_groups(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _as_landed(_landed(spark, path, GROUPS, fmt), GROUPS)


def load_stations(
    spark: SparkSession, path: str, snapshot_month: dt.date, fmt: str = "parquet"
) -> DataFrame:
    return parsed(landed_stations(spark, path, snapshot_month, fmt))


def load_groups(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return parsed(landed_groups(spark, path, fmt))


def load_cities(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return parsed(landed_cities(spark, path, fmt)).select("id", "longitude", "latitude")


def overshoot_rows(documents: DataFrame) -> DataFrame:
    """Confirmed overshoots out of documents with an array ``data``; unknown standards are NULL."""
    rows = parsed(documents).select(F.inline("data"))
    confirmed = rows.where(F.col("is_overshoot") & ~F.col("is_overshoot_estimated"))
    return confirmed.select(*OVERSHOOTS.fieldNames()).withColumn(
        "target_id", lookup(F.col("target_id"), OVERSHOOT_STANDARDS)
    )


def overshoot_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """JSON documents with an array ``data``; one that doesn't parse has its text in ``BROKEN``.

    A document is a file, or with ``lines`` a line of a file that holds many: of very many
    documents, opening a file for each takes longer than reading it.
    """
    schema = T.StructType([T.StructField("data", T.ArrayType(OVERSHOOTS)), T.StructField(BROKEN, TEXT)])
    return _whole_rows(spark.read.schema(schema).json(path, multiLine=not lines, columnNameOfCorruptRecord=BROKEN))


def load_overshoots(
    spark: SparkSession, path: str, since: dt.date | None = None, lines: bool = False
) -> DataFrame:
    """One JSON document per city, many cities in parallel; records from a start date on.

    Documents that don't parse are left out; ``broken_documents`` has them.
    """
    rows = overshoot_rows(overshoot_documents(spark, path, lines))
    return rows if since is None else rows.where(F.col("date") >= F.lit(since))


def broken_documents(
    spark: SparkSession, path: str, shown: int = 200, lines: bool = False
) -> DataFrame:
    """(file_name, n_chars, start) of documents that don't parse: where, how long, how they begin."""
    text = F.col("record")
    return _broken(overshoot_documents(spark, path, lines)).select(
        "file_name", F.length(text).cast("bigint").alias("n_chars"), F.substring(text, 1, shown).alias("start")
    )


def _period_files(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows of the period files below a folder, broken ones included; None without files."""
    options = {"recursiveFileLookup": True, "pathGlobFilter": PERIOD_GLOB}
    try:
        df = _csv(spark, root, MEASUREMENTS, **options)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    return df.where(F.col("_metadata.file_name").rlike(PERIOD_FILE))


def load_period_files(spark: SparkSession, root: str) -> DataFrame:
    """All period files below a folder, with the name each row came from.

    Files of other names are left out; with none left the frame is empty. Rows that don't parse
    are left out too; ``broken_period_rows`` has them.
    """
    df = _period_files(spark, root)
    if df is None:
        columns = {f.name: f.dataType for f in MEASUREMENTS} | {"file_name": TEXT}
        return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in columns.items()])
    rows = df.where(F.col(BROKEN).isNull())
    return rows.select(*MEASUREMENTS.fieldNames(), F.col("_metadata.file_path").alias("file_name"))
