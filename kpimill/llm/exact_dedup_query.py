"""op9 over ``documents``."""

from kpimill.llm.exact_dedup import LOWER, UPPER, exact_dedup
from kpimill.llm.registry import query, table

SQL = f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER.decode()}', '{LOWER.decode()}') AS t FROM documents)
"""


@query("op9_exact_dedup", SQL)
def op9_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
