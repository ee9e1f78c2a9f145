"""Small tables and brute-force helpers for the tests of the training-data operators."""

import os
import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")

ODD_TEXTS = [
    None, "", " ", "a", "  a  b ", "x\ny\t z", "the cat's here", "Ünï cödé Σς İ", "１２ 3", "<|endoftext|> <s>", "a\x01b \x01 c", "\x1c a\x1c b", "a" * 5000,
    " " * 3000, "word " * 4000, "🙂🙂 中文字 é́", "\r\n\r\n x", "ABC abc Abc", "abc ABC aBC", "one two three four five six", "one two three four five six",
]


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeats, ids that repeat, and columns with clashing names."""
    rows = [(i, t, f"k{i}", i, i) for i, t in enumerate(ODD_TEXTS)] + [(None, "abc abc", None, None, None), (None, None, None, None, None), (5, "x\ny\t z", "d", 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, component_id long, digest long")
    clashing = ["row", "id", "k1", "k2", "t", "at", "kept_text", "score", "keep_id", "__gone", "__digest", "__text", "__toxicity", "packed", "a.b"]
    return df.withColumns({c: F.when(F.col("doc_id") > 3, F.lit(c)) for c in clashing})


def fuzz_texts(n, seed=1):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "\x1c", "a", "b'", "'s", "é", "ß", "1", "!", "\xa0", "　", "́", "Σ", "İ", "\x01", "<|endoftext|>", "中", "🙂", "the", "    "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
