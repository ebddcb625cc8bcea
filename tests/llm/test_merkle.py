import hashlib
import random

import pytest
from pyspark.sql import functions as F

from hazeline.llm import merkle, oracles

FOLDER = "/root/testdata/sf0.001"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    values = (row.doc_id, row.source, row.lang, row.n_chars, row.text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(hashes):
    found = [hashes]
    while len(found[-1]) > 1:
        now = found[-1]
        found.append([H("".join(now[i : i + 8])) for i in range(0, len(now), 8)])
    return found


def brute(rows):
    """(doc_id, leaf, subroot, root, proof) of each row, as a sorted list."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = [levels([h for *_, h in sorted(by_lang[x])]) for x in langs]
    top = levels([t[-1][0] for t in trees])

    def proof(tree, place):
        return [(tuple(t[place // 8**k // 8 * 8 :][: place // 8**k % 8]), tuple(t[place // 8**k + 1 : (place // 8**k // 8 + 1) * 8])) for k, t in enumerate(tree[:-1])]

    found = []
    for number, (lang, tree) in enumerate(zip(langs, trees)):
        for place, (known, key, own) in enumerate(sorted(by_lang[lang])):
            steps = [("".join(a), "".join(b)) for a, b in proof(tree, place) + proof(top, number)]
            found.append((key if known else None, own, tree[-1][0], top[-1][0], steps))
    return sorted(found, key=str)


def rows_of(found):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in found.collect()), key=str)


def with_leaves(docs):
    return docs.select("doc_id", "lang", merkle.document_leaf().alias("leaf"), F.lit(True).alias("wanted"))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8, "b": 9, None: 1}, {"a": 513, "b": 64, "c": 65, "é": 7}, {f"l{i:02}": 2 for i in range(70)}])
def test_proofs_equal_brute_force(spark, sizes):
    rows = [(k, f"t{k}", lang, "s", k) for k, lang in enumerate(x for lang, n in sizes.items() for x in [lang] * n)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert rows_of(merkle.Manifest(with_leaves(docs)).proofs()) == brute(docs.collect())


def test_multiproof_of_some_leaves(spark):
    rows = [(k, f"t{k}", "ab"[k % 2], "s", k) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    some = with_leaves(docs).withColumn("wanted", F.col("doc_id").isin(3, 4, 5, 1041, 1499))
    found = rows_of(merkle.Manifest(some, "wanted").proofs("wanted"))
    assert found == [r for r in brute(docs.collect()) if r[0] in (3, 4, 5, 1041, 1499)]


def test_octopus_asks_for_the_fewest_nodes():
    rng = random.Random(2)
    for n in (1, 2, 8, 9, 64, 65, 500, 513):
        for size in (1, 3, n):
            places = rng.sample(range(n), min(size, n))
            own, derived, width, needed, level = set(places), set(), n, set(), 0
            while width > 1:
                parents = {p // 8 for p in own}
                needed |= {(level, p) for q in parents for p in range(8 * q, min(8 * q + 8, width))} - {(level, p) for p in own}
                derived |= {(level, p) for p in own}
                own, width, level = parents, -(-width // 8), level + 1
            asked = list(merkle.missing(places, n))
            assert set(asked) == needed and len(asked) == len(needed) and not derived & needed
    assert list(merkle.missing(range(500), 500)) == []


def test_changed_rows_do_not_verify(spark, documents):
    given = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    found = merkle.audited(documents, given).collect()
    assert len(found) == documents.count()
    assert all(r.verified == (r.doc_id % 2 == 1) and (r.folded_root == r.root) == r.verified for r in found)


def test_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{FOLDER}/documents.parquet'")
    cursor = con.execute(oracles.merkle())
    names = [c[0] for c in cursor.description]
    found = merkle.query(spark, FOLDER)
    assert found.columns == names and sorted(tuple(r) for r in found.collect()) == sorted(cursor.fetchall())


def test_awkward_rows(awkward):
    found = merkle.audited(awkward, F.col("text"))
    rows = found.collect()
    assert len(rows) == 11 and all(r.verified for r in rows)
    assert rows_of(found) == brute(awkward.collect())
    manifest = merkle.Manifest(with_leaves(awkward)).rows().collect()
    assert sum(r.n_leaves for r in manifest) == 11 and len({r.root for r in manifest}) == 1


def test_empty_table(no_documents):
    assert merkle.audited(no_documents, F.col("text")).collect() == []
    assert merkle.Manifest(with_leaves(no_documents)).root is None
