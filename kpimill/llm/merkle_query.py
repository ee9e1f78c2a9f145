"""op13 over ``documents``."""

from pyspark.sql import functions as F

from kpimill.llm.merkle import folded, leaf_digest, manifest, siblings
from kpimill.llm.registry import query, table

LEVELS = 13  # of the SQL twin: up to 3**13 documents of one source, and as many sources


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR) || ':' || {name}::VARCHAR END"


def _tree(name: str, first: str) -> str:
    """CTEs of a tree per ``g`` over ``first`` (g, i, h): {name}0 and up with all nodes, and {name}s0 and up with the siblings of each."""
    out = [f"{name}0 AS MATERIALIZED (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n FROM {first})"]
    for k in range(LEVELS):
        out.append(
            f"{name}s{k} AS MATERIALIZED (SELECT g, i, n > 1 AS goes,"
            " coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
            f" coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
        )
        out.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM (SELECT g, i // 3 AS i,"
            f" CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h FROM {name}{k} GROUP BY g, i // 3))"
        )
    return ",\n".join(out)


def _walk(name: str, tree: str, first: str) -> str:
    """CTEs that take rows (g, i, proof, at) of ``first`` from the leaves to the top of a tree: {name}0 and up."""
    out = [f"{name}0 AS (SELECT * FROM {first})"]
    for k in range(LEVELS):
        out.append(
            f"{name}{k + 1} AS (SELECT w.* REPLACE (CASE WHEN goes THEN proof || l || r ELSE proof END AS proof, CASE WHEN goes THEN sha256(l || at || r) ELSE at END AS at)"
            f" FROM {name}{k} w JOIN {tree}s{k} s ON s.g IS NOT DISTINCT FROM w.g AND s.i = w.i // {3**k})"
        )
    return ",\n".join(out)


_LEAF = " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars"]))
SQL = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id AS d, CAST(doc_id AS VARCHAR) AS s, 0 AS t, 4294967295::BIGINT AS v FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT d, s, t + 1, xor(u >> 1, 3988292384 * (u & 1))
  FROM (SELECT d, s, t, CASE WHEN t % 8 = 0 THEN xor(v, ascii(s[t // 8 + 1])::BIGINT) ELSE v END AS u FROM crc WHERE t < 8 * length(s))
), leaves AS MATERIALIZED (
  SELECT doc_id, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i,
         sha256({_LEAF} || {_field("text")}) AS h,
         CASE WHEN xor(v, 4294967295) % 2 = 0 THEN sha256({_LEAF} || {_field("replace(text, chr(10), '')")}) END AS changed
  FROM documents LEFT JOIN crc ON crc.d = doc_id AND t = 8 * length(s)
),
{_tree("a", "leaves")},
tops AS MATERIALIZED (SELECT 0 AS g, g AS source, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h FROM a{LEVELS}),
{_tree("b", "tops")},
starts AS (SELECT *, '' AS proof, coalesce(changed, h) AS at FROM leaves),
{_walk("w", "a", "starts")},
crossing AS (SELECT 0 AS g, tops.i, w.doc_id, w.h AS leaf, tops.h AS subroot, w.proof, w.at FROM w{LEVELS} w JOIN tops ON tops.source IS NOT DISTINCT FROM w.g),
{_walk("x", "b", "crossing")}
SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, at AS folded_root, at = b.h AS verified FROM x{LEVELS} x JOIN b{LEVELS} b ON b.g = x.g
"""


@query("op13_merkle", SQL)
def op13_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    values = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False)) & F.contains("text", F.lit("\n"))
    tampered = F.when(changed, leaf_digest(*values, F.replace("text", F.lit("\n"), F.lit(""))))
    rows = manifest(docs, leaf_digest(*values, F.col("text")), F.col("source"), F.col("doc_id"), {"doc_id": F.col("doc_id"), "tampered": tampered})
    rows = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    proof = F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
