"""op7 over ``documents``."""

from kpimill.llm.minhash import near_duplicates
from kpimill.llm.registry import query, table


@query("op7_minhash")
def op7_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
