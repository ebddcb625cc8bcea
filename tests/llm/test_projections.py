import math

import numpy as np

from hazeline.llm import projections

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, lists int, copies int"


def near_pairs(n=240, dimension=64, seed=4):
    """Clusters with cosines around the limit, in three labels."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, dimension))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    found = []
    for i in range(n):
        noise = rng.standard_normal(dimension)
        found.append((i, (centres[i // 6] + noise / np.linalg.norm(noise) * (0.05 + 0.1 * (i % 6))).astype(np.float32), i // 6 % 3))
    return found


def brute(rows, cosine=projections.COSINE):
    links = {i: set() for i, _, _ in rows}
    for i, a, la in rows:
        for j, b, lb in rows:
            if i < j and la == lb:
                x, y = np.asarray(a, float), np.asarray(b, float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    root = {}
    for i in sorted(links):
        if i not in root:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in root:
                    root[k] = i
                    todo += links[k]
    return links, root


def frame(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], l, None, None, None) for i, e, l in rows], SCHEMA)


def test_recall_and_no_link_below_the_limit(spark):
    rows = near_pairs()
    links, _ = brute(rows)
    found = projections.linked_vectors(frame(spark, rows)).collect()
    assert all(r.n_links <= len(links[r.vec_id]) for r in found)
    total, got = sum(map(len, links.values())), sum(r.n_links for r in found)
    assert total > 300 and got >= 0.95 * total
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_calibration():
    assert projections.recall_at(0.93) > 0.99 > projections.recall_at(0.8)
    assert projections.recall_at(0.0) < 0.1


def test_blocks_give_the_same(spark, monkeypatch):
    rows = near_pairs(120)
    whole = projections.linked_vectors(frame(spark, rows)).collect()
    monkeypatch.setattr(projections, "BLOCK", 2)
    assert sorted(projections.linked_vectors(frame(spark, rows)).collect()) == sorted(whole)


def test_awkward_rows(spark):
    one, nan = [1.0] + [0.0] * 7, float("nan")
    rows = [
        (1, one, 0), (2, one, 0), (2, one, 0), (3, [2.0] + [0.0] * 7, 0), (4, one, 1), (5, one, None), (6, None, 0), (7, [0.0] * 8, 0),
        (8, [nan] + [0.0] * 7, 0), (9, [float("inf")] + [0.0] * 7, 0), (10, [None] + [1.0] * 7, 0), (11, [], 0), (12, [1.0], 0), (13, [-1.0] + [0.0] * 7, 0),
        (None, [0.0, 1.0] + [0.0] * 6, 7), (14, [1e-30] + [0.0] * 7, 3), (15, [3e38] + [0.0] * 7, 3),
    ]
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in projections.linked_vectors(frame(spark, rows)).collect()}
    alone = {(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13)}
    many = {(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (14, 1, 14, True), (15, 1, 14, False)}
    assert found >= alone | {(None, 0, None, False)}
    # Vectors of few dimensions may share no listed direction; equal ones always link.
    exact = {x for x in found if x[0] in (1, 2)}
    assert all(x[1] >= 2 and x[2] == 1 for x in exact) and {x[0] for x in found} == {x[0] for x in alone | many} | {None}


def test_empty_table(spark):
    assert projections.linked_vectors(frame(spark, [])).collect() == []
