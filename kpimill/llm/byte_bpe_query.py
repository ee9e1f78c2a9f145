"""op2 over ``documents``."""

import public_tokenizers

from kpimill.llm.byte_bpe import encode_decode
from kpimill.llm.registry import query, table


@query("op2_byte_bpe")
def op2_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_decode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, content=False)
