"""op12 over ``conversations``."""

from pyspark.sql import functions as F

from kpimill.llm.prefix_trie import list_digests, numbered, prefix_trie, with_heads
from kpimill.llm.registry import query, table
from kpimill.session import materialize

HEADS = 6  # heads have 0 to 5 turns
FAMILY = 100  # conversations of one hundred share the head of the first

SQL = f"""
WITH RECURSIVE ids AS (
  SELECT conv_id AS c, count(*) AS n FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
  SELECT c, CAST(c AS VARCHAR) AS s, 0 AS t, 4294967295::BIGINT AS v FROM ids
  UNION ALL
  SELECT c, s, t + 1, xor(u >> 1, 3988292384 * (u & 1))
  FROM (SELECT c, s, t, CASE WHEN t % 8 = 0 THEN xor(v, ascii(s[t // 8 + 1])::BIGINT) ELSE v END AS u FROM crc WHERE t < 8 * length(s))
), heads AS (
  SELECT ids.c, ids.n, ids.c - ids.c % {FAMILY} AS base, xor(v, 4294967295) % {HEADS} AS h FROM ids JOIN crc ON crc.c = ids.c AND t = 8 * length(s)
), known AS (
  SELECT heads.*, least(h, coalesce(b.n, 0)) AS n_head FROM heads LEFT JOIN ids b ON b.c = heads.base
), turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT known.c, i AS d, role, text FROM known JOIN turns ON turns.c = known.base AND i <= h
  UNION ALL
  SELECT known.c, i - h + n_head, role, text FROM known JOIN turns ON turns.c = known.c AND i > h
), chains AS (
  SELECT c, d, length(text) AS chars, string_agg(sha256(sha256(role) || text), '') OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
  UNION ALL
  SELECT c, 0, 0, '' FROM known
), lasts AS (
  SELECT c, max(d) AS last FROM chains GROUP BY c
), nodes AS (
  SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
         string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = last) AS ends, count(*) FILTER (WHERE d < last) = 0 AS childless
  FROM chains JOIN lasts USING (c) GROUP BY d, path
), above AS (
  SELECT a.d, a.path, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE n.childless) AS n_leaves, count(*) FILTER (WHERE n.d = a.d + 1) AS n_children
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM nodes) n JOIN nodes a ON a.d = n.up AND a.path = left(n.path, 64 * n.up)
  GROUP BY a.d, a.path
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, a.n_children, a.n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN above a ON a.d = n.d AND a.path = n.path LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = left(n.path, 64 * (n.d - 1))
"""


@query("op12_prefix_trie", SQL)
def op12_prefix_trie(spark, sf_dir):
    turns = materialize(numbered(table(spark, sf_dir, "conversations")), "numbered")
    head = F.crc32(F.col("conv_id").cast("string")) % HEADS
    rebuilt, conversations = with_heads(turns, head, F.col("conv_id") - F.col("conv_id") % FAMILY, HEADS - 1)
    trie = prefix_trie(rebuilt, conversations)
    digests = list_digests(trie.ends)
    return trie.nodes.drop("n_ends").join(digests, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
