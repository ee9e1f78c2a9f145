"""op10 over ``documents``."""

from kpimill.llm.registry import query, table
from kpimill.llm.suffix_dedup import remove_repeats


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))
