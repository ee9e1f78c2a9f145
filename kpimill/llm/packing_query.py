"""op5 over ``documents``."""

import public_tokenizers

from kpimill.llm.packing import pack
from kpimill.llm.registry import query, table


@query("op5_packing")
def op5_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
