"""SQL of the operators that it can express."""

from __future__ import annotations

#: Levels of eight that the SQL unrolls: over two million documents a language, 64 languages.
LEAF_LEVELS, TOP_LEVELS = 7, 2

#: CRC-32 of an integer's decimal digits, bit by bit.
CRC = """xor(list_reduce(
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda crc, byte: list_reduce(range(8), lambda x, bit:
            CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
        CAST(4294967295 AS BIGINT)), 4294967295)"""


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _levels(name: str, tree: str, levels: int) -> list[str]:
    """Tables name1, name2, ... above name0 (tree, place, h), and the sides of each node of a run."""
    found = []
    for k in range(levels):
        run = f"PARTITION BY {tree}, place // 8 ORDER BY place ROWS BETWEEN"
        found.append(f"""{name}{k}s AS (
    SELECT {tree}, place, h, count(*) OVER (PARTITION BY {tree}) AS n,
           coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {name}{k}),
{name}{k + 1} AS (
    SELECT {tree}, place // 8 AS place, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY place)) END AS h
    FROM {name}{k}s GROUP BY {tree}, place // 8)""")
    return found


def merkle() -> str:
    """Leaves, eight to a node, unrolled level by level; proofs folded the same way."""
    tables = [f"""docs AS (
    SELECT doc_id, lang, {_leaf('text')} AS leaf,
           CASE WHEN {CRC} % 3 = 0
                THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                ELSE {_leaf('text')} END AS given
    FROM documents)""", """numbered AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, given) - 1 AS place
    FROM docs)""", "a0 AS (SELECT tree, place, leaf AS h FROM numbered)"]
    tables += _levels("a", "tree", LEAF_LEVELS)
    tables.append(f"b0 AS (SELECT 0 AS top, tree AS place, h FROM a{LEAF_LEVELS})")
    tables += _levels("b", "top", TOP_LEVELS)
    tables.append("f0 AS (SELECT doc_id, leaf, tree, place, given AS h, '' AS proof FROM numbered)")
    steps = [("a", k, "s.tree = f.tree AND s.place = f.place", "f.place // 8") for k in range(LEAF_LEVELS)]
    steps += [("b", k, f"s.place = f.tree // {8**k}", "f.place") for k in range(TOP_LEVELS)]
    for i, (name, k, match, up) in enumerate(steps):
        tables.append(f"""f{i + 1} AS (
    SELECT f.doc_id, f.leaf, f.tree, {up} AS place,
           CASE WHEN s.n = 1 THEN f.h ELSE sha256(s.before || f.h || s.after) END AS h,
           f.proof || CASE WHEN s.n = 1 THEN '' ELSE s.before || s.after END AS proof
    FROM f{i} f JOIN {name}{k}s s ON {match})""")
    return "WITH " + ",\n".join(tables) + f"""
SELECT f.doc_id, f.leaf, a.h AS subroot, b.h AS root, sha256(f.proof) AS proof_sha256,
       f.h AS folded_root, f.h = b.h AS verified
FROM f{len(steps)} f JOIN a{LEAF_LEVELS} a ON a.tree = f.tree CROSS JOIN b{TOP_LEVELS} b"""
