"""op11 over ``documents``."""

from kpimill.llm.registry import query, table
from kpimill.llm.substring_dedup import WIDTH, remove_windows

SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), windows AS (
  SELECT r, doc_id, i, array_to_string(words[i : i + {WIDTH - 1}], ' ') AS run
  FROM (SELECT r, doc_id, words, unnest(range(1, greatest(len(words) - {WIDTH - 2}, 1))) AS i FROM texts)
), gone AS (
  SELECT DISTINCT r, i + k AS place
  FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY run) AS first_doc FROM windows), range({WIDTH}) AS t(k)
  WHERE first_doc < doc_id
), words AS (
  SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text FROM words ANTI JOIN gone USING (r, place) GROUP BY r
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""


@query("op11_substring_dedup", SQL)
def op11_substring_dedup(spark, sf_dir):
    return remove_windows(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
