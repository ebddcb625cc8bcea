"""Merkle manifest of a table of documents, with inclusion proofs by octopus multiproofs.

A document's leaf is the SHA-256 of its columns. The leaves of a language, in order of doc_id,
are the bottom of a tree of eight children a node; the languages' subroots, in order of their
names, are the bottom of one more. A manifest is this root with the subroots; a proof holds a
leaf's siblings on its way up.

Leaves are numbered over range parts and gathered in blocks of ``BLOCK`` neighbours, each a
whole subtree, folded inside Spark by nested ``transform``. What the blocks fold to is the
bottom of the next round, so a tree of n leaves takes log(n) / log(``BLOCK``) rounds, and no
task holds more than a block, whatever the size of a language.

For proofs, each block finds the smallest set of coordinates that its wanted leaves need and
can't derive themselves (the octopus: level by level, siblings of known nodes that aren't known;
then their parents are). These coordinates meet the nodes in one join. With them, a block
derives each shared interior once and spells out the proof of each leaf.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.inputs import table
from hazeline.plans.staging import global_row_number, stage

ARITY, BLOCK_LEVELS = 8, 3
BLOCK = ARITY**BLOCK_LEVELS
#: The id of the tree over the subroots; languages have 0 and up.
TOP = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(*columns: Column) -> Column:
    """Digest of values: each ``-`` if null, else its bytes in UTF-8, a colon and the value."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(F.concat(*parts))


def document_leaf(text: Column | None = None) -> Column:
    """The leaf of a row of documents, with another text if one is given."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    return leaf_of(*columns, F.col("text") if text is None else text)


def levels_of(n: Column) -> Column:
    """How often n nodes are gathered by eights until one remains."""
    powers = F.array(*[F.lit(ARITY**k) for k in range(21)])
    return F.size(F.filter(powers, lambda p: p < n))


def _gathered(hashes: Column) -> Column:
    """The parents of a row of nodes that begins at a multiple of eight."""
    runs = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(hashes, i * ARITY + 1, ARITY), "")))


def blocks_of(leaves: DataFrame, *carried: str) -> DataFrame:
    """(tree, n, block, leaves): neighbours of one tree, a struct (place, hash, ...) each, in order."""
    block = F.floor(F.col("place") / BLOCK).cast("bigint").alias("block")
    each = F.collect_list(F.struct("place", "hash", *carried))
    return leaves.groupBy("tree", "n", block).agg(F.array_sort(each).alias("leaves"))


def _interior(blocks: DataFrame, base: int) -> DataFrame:
    """(tree, n, level, place, hash): what blocks of nodes of level ``base`` fold to."""
    now = blocks.select("tree", "n", "block", levels_of(F.col("n")).alias("levels"), F.col("leaves.hash").alias("h0"))
    for k in range(BLOCK_LEVELS):
        above = F.when(F.col("levels") > base + k, _gathered(F.col(f"h{k}")))
        now = now.withColumn(f"h{k + 1}", above)
    rows = F.array(*[F.struct(F.lit(base + k).alias("level"), F.lit(BLOCK // ARITY**k).cast("bigint").alias("width"), F.col(f"h{k}").alias("h")) for k in range(1, BLOCK_LEVELS + 1)])
    each = now.select("tree", "n", "block", F.inline(rows)).where(F.col("h").isNotNull())
    each = each.select("tree", "n", "level", (F.col("block") * F.col("width")).alias("first"), F.posexplode("h").alias("at", "hash"))
    return each.select("tree", "n", "level", (F.col("first") + F.col("at")).alias("place"), "hash")


def interior_nodes(blocks: DataFrame) -> DataFrame:
    """(tree, n, level, place, hash) of every node above the leaves of the blocks."""
    found, base = [], 0
    while True:
        found.append(stage(_interior(blocks, base), "nodes"))
        base += BLOCK_LEVELS
        tops = found[-1].where((F.col("level") == base) & (levels_of(F.col("n")) > base))
        if tops.isEmpty():
            break
        blocks = blocks_of(tops)
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


class Manifest:
    """The trees over a table of leaves (doc_id, lang, leaf and columns to carry along).

    Leaves of a language are ordered by doc_id, null first, then by their digest and the carried
    columns; a repeated row is a leaf of its own. A null language comes before all others. An
    empty table has no languages, no root and no proofs.
    """

    def __init__(self, leaves: DataFrame, *carried: str):
        self.carried = carried
        leaves = stage(leaves.select("doc_id", "lang", "leaf", *carried), "leaves")
        order = [F.asc_nulls_first(c) for c in ("lang", "doc_id", "leaf", *carried)]
        numbered = stage(global_row_number(leaves, order, "number", within="lang"), "numbered")
        sizes = stage(numbered.groupBy("lang").agg(F.count("*").alias("n")), "sizes")
        ranked = global_row_number(sizes, [F.asc_nulls_first("lang")], "rank")
        #: (lang, n, tree): a tree for each language.
        self.trees = stage(ranked.select("lang", "n", (F.col("rank") - 1).alias("tree")), "trees")
        trees = self.trees.withColumnRenamed("lang", "_lang")
        placed = numbered.join(trees, numbered["lang"].eqNullSafe(trees["_lang"])).select(
            "tree", "n", (F.col("number") - 1).alias("place"), F.col("leaf").alias("hash"), "doc_id", *carried
        )
        self.blocks = stage(blocks_of(placed, "doc_id", *carried), "blocks")
        interior = interior_nodes(self.blocks)
        lone = self.blocks.where(F.col("n") == 1).select("tree", F.col("leaves")[0]["hash"].alias("hash"))
        #: (tree, hash): the one node left of each language.
        self.subroots = stage(_last_nodes(interior).union(lone), "subroots")
        self.languages = self.subroots.count()
        top = self.subroots.select(
            F.lit(TOP).cast("bigint").alias("tree"), F.lit(self.languages).cast("bigint").alias("n"),
            F.col("tree").alias("place"), "hash",
        )
        self.top_blocks = stage(blocks_of(top), "top")
        above = interior_nodes(self.top_blocks)
        last = (self.subroots if self.languages == 1 else _last_nodes(above)).first()
        #: The digest over all languages; None if there are none.
        self.root = last["hash"] if last else None
        self.interior = interior.union(above).select("tree", "level", "place", "hash")

    def rows(self) -> DataFrame:
        """(lang, n_leaves, subroot, root): the manifest itself, a row per language."""
        root = F.lit(self.root).cast("string").alias("root")
        return self.trees.join(self.subroots, "tree").select("lang", F.col("n").alias("n_leaves"), F.col("hash").alias("subroot"), root)

    def nodes(self, lowest: int) -> DataFrame:
        """(tree, level, place, hash) of all trees, from a level on."""
        found = self.interior.where(F.col("level") >= lowest)
        if lowest == 0:
            for blocks in (self.blocks, self.top_blocks):
                bottom = blocks.select("tree", F.inline("leaves")).select("tree", F.lit(0).alias("level"), "place", "hash")
                found = found.union(bottom)
        return found

    def proofs(self, wanted: str | None = None) -> DataFrame:
        """(doc_id, leaf, carried columns, subroot, root, proof) of all leaves, or of those for
        which a carried boolean column is true.

        ``proof`` has a struct (before, after) per level: the joined digests of the siblings on
        either side. See ``folded`` and ``proof_digest``.
        """
        lists = ["place", "hash", "doc_id", *self.carried]
        blocks = self.blocks
        if wanted is not None:
            blocks = blocks.where(F.exists("leaves", lambda x: F.coalesce(x[wanted], F.lit(False))))
        blocks = blocks.select("tree", "n", "block", *[F.col(f"leaves.{c}").alias(f"_{c}") for c in lists])
        languages = self.languages

        def places(row: dict) -> list[int]:
            chosen = row[f"_{wanted}"] if wanted else [True] * len(row["_place"])
            return [p for p, yes in zip(row["_place"], chosen) if yes]

        def ask(batches):
            for batch in batches:
                for row in (r for at in range(batch.num_rows) for r in batch.slice(at, 1).to_pylist()):
                    asked = [(row["tree"], k, p) for k, p in missing(places(row), row["n"])]
                    asked += [(TOP, k, p) for k, p in missing([row["tree"]], languages)]
                    columns = [[row["tree"]] * len(asked), [row["block"]] * len(asked), *(list(c) for c in zip(*asked))]
                    if asked:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int32() if i == 3 else pa.int64()) for i, c in enumerate(columns)], ["tree", "block", "of", "level", "place"]
                        )

        asking = blocks.select("tree", "n", "block", "_place", *([f"_{wanted}"] if wanted else []))
        asked = stage(asking.mapInArrow(ask, "tree bigint, block bigint, of bigint, level int, place bigint"), "asked")
        lowest = asked.agg(F.min("level")).first()[0] or 0
        nodes = self.nodes(lowest).select(F.col("tree").alias("of"), "level", "place", "hash")
        got = asked.join(nodes, ["of", "level", "place"]).groupBy("tree", "block")
        got = got.agg(F.collect_list(F.struct("of", "level", "place", "hash")).alias("_got"))
        carried = self.carried
        kinds = {f.name: f.dataType for f in self.blocks.schema["leaves"].dataType.elementType}
        schema = ", ".join(f"`{c}` {kinds[c].simpleString()}" for c in ("doc_id", "hash", *carried))
        names = ["doc_id", "hash", *carried, "subroot", "proof"]

        def spell_out(batches):
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1)
                    (r,) = row.to_pylist()
                    known = {(x["of"], x["level"], x["place"]): x["hash"] for x in r["_got"] or []}
                    want = set(places(r))
                    leaves = {p: h for p, h in zip(r["_place"], r["_hash"]) if p in want}
                    subroot, own = paths(leaves, r["n"], r["tree"], known)
                    _, over = paths({r["tree"]: subroot}, languages, TOP, known)
                    chosen = pa.array([i for i, p in enumerate(r["_place"]) if p in want], pa.int64())
                    lists = [row[f"_{c}"].flatten().take(chosen) for c in ("doc_id", "hash", *carried)]
                    above = over[r["tree"]]
                    steps = [[{"before": a, "after": b} for a, b in own[r["_place"][i.as_py()]] + above] for i in chosen]
                    proof = pa.array(steps, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))
                    yield pa.RecordBatch.from_arrays([*lists, pa.array([subroot] * len(chosen), pa.string()), proof], names)

        spelt = blocks.join(got, ["tree", "block"], "left").mapInArrow(
            spell_out, f"{schema}, subroot string, proof array<struct<before: string, after: string>>"
        )
        root = F.lit(self.root).cast("string").alias("root")
        return spelt.select("doc_id", F.col("hash").alias("leaf"), *carried, "subroot", root, "proof")


def _last_nodes(interior: DataFrame) -> DataFrame:
    return interior.where(F.col("level") == levels_of(F.col("n"))).select("tree", "hash")


def missing(places: Iterable[int], n: int) -> Iterator[tuple[int, int]]:
    """The fewest (level, place) that lead from some leaves of a tree of n to its root.

    The octopus: on each level the siblings of known nodes that aren't known are missing; then
    the parents are known.
    """
    level, known = 0, set(places)
    while n > 1 and known:
        parents = {p // ARITY for p in known}
        for parent in sorted(parents):
            first = parent * ARITY
            yield from ((level, p) for p in range(first, min(first + ARITY, n)) if p not in known)
        level, known, n = level + 1, parents, -(-n // ARITY)


def paths(leaves: dict[int, str], n: int, tree: int, known: dict[tuple[int, int, int], str]) -> tuple[str, dict[int, list[tuple[str, str]]]]:
    """The root over some leaves, and for each the siblings before and after it, level by level.

    ``known`` has at least the ``missing`` nodes by (tree, level, place). Interiors are derived
    once, whatever the number of leaves below them.
    """
    now, sides, level, width = dict(leaves), [], 0, n
    while width > 1:
        runs = defaultdict(list)
        for parent in sorted({p // ARITY for p in now}):
            first = parent * ARITY
            runs[parent] = [now[p] if p in now else known[tree, level, p] for p in range(first, min(first + ARITY, width))]
        sides.append({p: ("".join(run[: p % ARITY]), "".join(run[p % ARITY + 1 :])) for p in now for run in [runs[p // ARITY]]})
        now = {parent: hashlib.sha256("".join(run).encode()).hexdigest() for parent, run in runs.items()}
        level, width = level + 1, -(-width // ARITY)
    found = {leaf: [side[leaf // ARITY**k] for k, side in enumerate(sides)] for leaf in leaves}
    return next(iter(now.values())), found


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda h, side: digest(F.concat(side["before"], h, side["after"])))


def proof_digest(proof: Column) -> Column:
    return digest(F.array_join(F.transform(proof, lambda side: F.concat(side["before"], side["after"])), ""))


def audited(docs: DataFrame, given: Column) -> DataFrame:
    """Every document's proof, and whether it holds for the text as it was given to an auditor.

    Returns (doc_id, leaf, subroot, root, proof, folded_root, verified); a row per row of docs.
    """
    leaves = docs.select("doc_id", "lang", document_leaf().alias("leaf"), document_leaf(given).alias("given"))
    found = Manifest(leaves, "given").proofs()
    found = found.withColumn("folded_root", folded(F.col("given"), F.col("proof"))).drop("given")
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark, folder: str) -> DataFrame:
    """A third of the documents, by a hash of their id, were lower-cased on the way to the auditor."""
    docs = table(spark, folder, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    given = F.when(changed, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    found = audited(docs, given)
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")
