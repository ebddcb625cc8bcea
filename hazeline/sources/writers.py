"""Writers of result tables and report text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Column titles of the written files where they differ from ours.
TITLES = {
    "good": "Good",
    "satisfactory": "Satisfactory",
    "moderate": "Moderate",
    "poor": "Poor",
    "very_poor": "Very Poor",
    "severe": "Severe",
    "unbanded": "NA",
    "exceedance_pct": "% days > NAAQS",
}


def write_outputs(outputs: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> list[str]:
    """Each result to a folder of its own, written in parallel and in the result's order."""
    paths = []
    for name, df in outputs.items():
        path = f"{folder}/{name}"
        if df.columns == ["line"]:
            df.write.mode("overwrite").text(path)
        else:
            titled = df.withColumnsRenamed({c: t for c, t in TITLES.items() if c in df.columns})
            titled.write.mode("overwrite").format(fmt).options(header=True, nullValue="NA").save(path)
        paths.append(path)
    return paths
