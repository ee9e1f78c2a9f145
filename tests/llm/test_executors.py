"""Tasks run where the package can't be imported."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PROGRAM = f"""
import sys
sys.path.insert(0, {REPO!r})
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from kpimill.session import get_session
spark = get_session("alone", "local[2]", {{"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": sys.argv[1]}})


def importable(batches):
    import importlib.util

    import pyarrow as pa

    for _ in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("kpimill") is not None])], ["there"])


assert [r.there for r in spark.range(1).repartition(1).mapInArrow(importable, "there boolean").collect()] == [False]
from kpimill.llm import minhash, multi_index, packing, prefix_trie, substring_dedup, suffix_dedup
multi_index.PER_CELL = 4
rng = np.random.default_rng(0)
x = rng.standard_normal((200, 8))
vectors = spark.createDataFrame([(i, (x[i % 150] + 1e-3 * rng.standard_normal(8)).tolist()) for i in range(200)], "vec_id long, embedding array<double>")
assert multi_index.near_vectors(vectors).filter("n_links > 0").count() >= 100
words = ["w%d" % (i * i % 97) for i in range(3000)]
docs = spark.createDataFrame([(i, " ".join(words[7 * i : 7 * i + 200])) for i in range(60)], "doc_id long, text string")
assert packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).count() == 60
assert suffix_dedup.remove_repeats(docs).filter("n_removed > 0").count() > 0
assert substring_dedup.remove_windows(docs).filter("n_removed > 0").count() > 0
assert minhash.near_duplicates(docs).count() == 60
turns = spark.createDataFrame([(c, t, "u", str(t)) for c in range(20) for t in range(9)], "conv_id long, turn long, role string, text string")
trie = prefix_trie.prefix_trie(*prefix_trie.with_heads(prefix_trie.numbered(turns), F.lit(1), F.col("conv_id"), 1))
assert trie.nodes.count() == 10 and prefix_trie.list_digests(trie.ends).count() == 1
print("whole")
"""


def test_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.stdout.strip().endswith("whole"), done.stderr[-3000:]
