"""Near-duplicate embeddings by collision counting on one-dimensional projections.

Vectors of one label are projected on ``PROJECTIONS`` random directions. Sorted by a projection,
only its upper end is looked at: a vector is listed there if its value is at least ``TAIL``. A
window around each listed vector, ``WINDOW`` wide to both sides, gives its collisions. A pair
that collides on at least ``COLLISIONS`` directions is verified by its cosine.

Calibration: for unit vectors a projection is nearly normal, and that of the difference of two
vectors at cosine c has deviation sqrt(2 - 2c). At c = 0.93 a listed vector's partner is listed
too, within the window, about three times in five, so with about eight listings a pair collides
on five directions on average, and on none in less than one pair of a hundred; ``recall_at``
computes it. Unrelated vectors share 0.07 directions on average.

Equal vectors are one row with a count from the start, so copies cost nothing. A list of more
than ``BLOCK`` vectors is split into blocks, and each pair of blocks is a group of its own. A
group returns counts and links to the smallest of each local component, never its pairs.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.components import connected_components
from hazeline.plans.staging import stage

COSINE, PROJECTIONS, TAIL, WINDOW, COLLISIONS, BLOCK, SEED = 0.93, 1024, 2.4, 3.0, 1, 512, 20240501


@cache
def directions(dimension: int, projections: int = PROJECTIONS) -> np.ndarray:
    """Random unit directions times the root of the dimension, so that values are nearly normal."""
    found = np.random.default_rng([SEED, dimension]).standard_normal((dimension, projections))
    return found / np.linalg.norm(found, axis=0) * math.sqrt(dimension)


def recall_at(cosine: float, projections: int = PROJECTIONS, collisions: int = COLLISIONS) -> float:
    """Share of pairs at a cosine that reach the collision count, for normal projections."""
    width = WINDOW * math.sqrt(2 - 2 * COSINE)
    spread = math.sqrt(1 - cosine**2)
    phi = lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2)))
    grid = np.linspace(TAIL, TAIL + 6, 4001)
    density = np.exp(-(grid**2) / 2) / math.sqrt(2 * math.pi)
    both = [phi((x + width - cosine * x) / spread) - phi((max(TAIL, x - width) - cosine * x) / spread) for x in grid]
    values = density * np.array(both)
    mean = projections * float(((values[1:] + values[:-1]) / 2 * np.diff(grid)).sum())
    return 1 - sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(collisions))


def valid(vector: str) -> Column:
    """Whether a vector is neither null nor empty, has only finite components and is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def listed(classes: DataFrame) -> DataFrame:
    """Classes with the directions on whose lists they are; vectors are divided by their length."""

    def per_batch(frames):
        for frame in frames:
            lists = []
            for vector in frame["vector"]:
                unit = np.asarray(vector, np.float64)
                unit = unit / np.abs(unit).max()
                unit /= np.linalg.norm(unit)
                lists.append(np.flatnonzero(unit @ directions(len(unit)) >= TAIL).astype(np.int32))
            yield frame.assign(lists=lists)

    return classes.mapInPandas(per_batch, classes.schema.simpleString()[7:-1] + ",lists:array<int>")


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component, for nodes in ascending order."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for end in (root[a], root[b], a, b):
            np.minimum.at(root, end, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def group_links(frame: pd.DataFrame, at: int, first: int, second: int, cosine: float, collisions: int) -> pd.DataFrame:
    """Links of a group whose first common direction is ``at``: counts and local components."""
    frame = frame.sort_values("first_id", ignore_index=True)
    vectors = np.array(frame["vector"].tolist(), np.float64)
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    values = unit @ directions(vectors.shape[1])
    high = values >= TAIL
    block = frame["block"].to_numpy()
    width = WINDOW * math.sqrt(2 - 2 * cosine)
    n = len(frame)
    ends: list[np.ndarray] = []
    others: list[np.ndarray] = []
    order = np.argsort(values[:, at], kind="stable")
    line = values[order, at]
    stops = np.searchsorted(line, line + width, side="right")
    for rank in range(n):
        i, near = order[rank], order[rank + 1 : stops[rank]]
        if first != second:
            near = near[block[near] != block[i]]
        if not len(near):
            continue
        hits = high[near] & high[i] & (np.abs(values[near] - values[i]) <= width)
        passed = (hits.sum(axis=1) >= collisions) & (hits.argmax(axis=1) == at)
        near = near[passed]
        near = near[(unit[near] * unit[i]).sum(axis=1) >= cosine]
        ends.append(np.full(len(near), i))
        others.append(near)
    a, b = (np.concatenate(x) if x else np.zeros(0, int) for x in (ends, others))
    weight = frame["copies"].to_numpy()
    links = np.bincount(a, weights=weight[b], minlength=n) + np.bincount(b, weights=weight[a], minlength=n)
    ids = frame["first_id"].to_numpy()
    found = pd.DataFrame({"first_id": ids, "links": links.astype(np.int64), "near": ids[_components(n, a, b)]})
    return found[found["links"] > 0]


def partial_links(classes: DataFrame, cosine: float = COSINE, collisions: int = COLLISIONS) -> DataFrame:
    """(first_id, links, near) per group: counts to be added up, and edges that keep components."""
    rows = classes.select("*", F.explode("lists").alias("list")).drop("lists")
    where = ["label", "size", "list"]
    sizes = rows.groupBy(*where).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n"))
    sizes = stage(sizes.where("n > 1").drop("n"), "lists")
    placed = rows.join(sizes, where).withColumn("block", F.pmod(F.xxhash64("first_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = placed.withColumn("other", other).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    )

    def per_group(key, frame):
        return group_links(frame, int(key[2]), int(key[3]), int(key[4]), cosine, collisions)

    return spread.select(*where, "low", "high", "block", "first_id", "copies", "vector").groupBy(
        *where, "low", "high"
    ).applyInPandas(per_group, "first_id bigint, links bigint, near bigint")


def linked_vectors(
    embeddings: DataFrame, cosine: float = COSINE, collisions: int = COLLISIONS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors link if their labels are equal and not null, their sizes are equal and their cosine,
    in double precision, is at least ``cosine``. Vectors that are null, empty, zero or hold a
    null or non-finite component link with nothing, as do rows with a null label. A row with a
    null vec_id gets the smallest vec_id of its component, if any, and is not kept. Rows that
    repeat are vectors of their own and link with each other.
    """
    source = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector")
    )
    marked = source.withColumn("ok", valid("vector") & F.col("label").isNotNull())
    held = stage(marked.withColumn("key", F.when(F.col("ok"), F.xxhash64("label", "vector"))), "vectors")
    copies = held.where("ok").groupBy("label", "key").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")
    )
    classes = stage(
        listed(
            copies.select(
                F.xxhash64("label", "key").alias("first_id"), "least", "label", "key", "copies",
                F.size("vector").alias("size"), "vector",
            )
        ),
        "classes",
    )
    parts = stage(partial_links(classes.drop("least", "key"), cosine, collisions), "links")
    roots = connected_components(parts.select("first_id", "near"))
    counts = parts.groupBy("first_id").agg(F.sum("links").alias("links"))
    slim = classes.select("first_id", "least", F.col("label").alias("_label"), F.col("key").alias("_key"), "copies")
    rooted = slim.join(counts, "first_id", "left").join(roots, F.col("first_id") == F.col("node"), "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "first_id")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    found = stage(rooted.join(least, "root").withColumn("_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1), "found")
    joined = held.join(found, (F.col("label") == F.col("_label")) & (F.col("key") == F.col("_key")), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    return linked_vectors(table(spark, folder, "embeddings"))
