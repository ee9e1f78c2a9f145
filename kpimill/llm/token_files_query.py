"""op4 over ``documents``."""

import public_tokenizers

from kpimill.llm.registry import query, table
from kpimill.llm.token_files import token_files


@query("op4_token_files")
def op4_token_files(spark, sf_dir):
    out = token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")
