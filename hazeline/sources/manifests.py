"""Versions of a set of tables that readers see whole or not at all.

Tables are written below a fresh folder. Once all are complete, one small manifest file names
that folder; it gets its own name by a rename. A run that dies leaves a folder that no manifest
names, and readers go on with the version before. The driver lists a manifest per version, not
the tables' files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def _write_small(spark: SparkSession, folder: str, name: str, text: str) -> None:
    path, files, jvm = _files(spark, folder)
    Path = jvm.org.apache.hadoop.fs.Path
    files.mkdirs(path)
    draft = Path(path, f"_{name}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(draft, Path(path, name)):
        raise OSError(f"{folder}/{name} could not be published")


def versions(spark: SparkSession, folder: str) -> list[dict]:
    """The manifests of a folder, oldest first; each has ``number``, ``path``, ``tables`` and
    what else was said of the version."""
    path, files, jvm = _files(spark, f"{folder}/manifests")
    if not files.exists(path):
        return []
    names = sorted(s.getPath().getName() for s in files.listStatus(path))
    found = []
    for name in (n for n in names if n.endswith(".json") and not n.startswith(("_", "."))):
        stream = files.open(jvm.org.apache.hadoop.fs.Path(path, name))
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        entry = json.loads(text)
        found.append(entry | {"path": f"{folder}/versions/{entry['version']}"})
    return found


def publish(
    spark: SparkSession, folder: str, write: Callable[[str], Iterable[str]],
    about: Mapping | None = None,
) -> dict:
    """Let ``write`` fill a fresh folder, then publish it under the names ``write`` gives back."""
    version = uuid.uuid4().hex
    path = f"{folder}/versions/{version}"
    tables = list(write(path))
    number = max((v["number"] for v in versions(spark, folder)), default=0) + 1
    entry = {**(about or {}), "number": number, "version": version, "tables": tables}
    _write_small(spark, f"{folder}/manifests", f"{number:09}-{version}.json", json.dumps(entry))
    return entry | {"path": path}


def publish_tables(
    spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], about: Mapping | None = None
) -> dict:
    """Publish frames as Parquet tables."""

    def write(path: str) -> list[str]:
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}")
        return list(tables)

    return publish(spark, folder, write, about)


def published(spark: SparkSession, folder: str, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table of the newest version that has it."""
    for entry in reversed(versions(spark, folder)):
        if name in entry["tables"]:
            return spark.read.options(**options).format(fmt).load(f"{entry['path']}/{name}")
    raise FileNotFoundError(f"{folder} has no published {name}")
