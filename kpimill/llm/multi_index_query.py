"""op3 over ``embeddings``."""

from kpimill.llm.multi_index import near_vectors
from kpimill.llm.registry import query, table


@query("op3_multi_index")
def op3_multi_index(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))
