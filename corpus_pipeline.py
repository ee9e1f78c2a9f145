"""The corpus pipeline over ``documents``: toxic texts out, exact copies out, near copies out, repeated passages cut, packed.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and is written before the next one
reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimill.llm.exact_dedup import without_copies
from kpimill.llm.labelled import fold
from kpimill.llm.minhash import without_near_copies
from kpimill.llm.packing import pack
from kpimill.llm.suffix_dedup import without_repeats
from kpimill.llm.toxicity import fit, without_toxic
from kpimill.session import discard, scratch_scope, staged


# a passage of 51 words is shorter than 400 bytes more often than not (median 328 in prose); nearly all are longer than this
PASSAGE_BYTES = 240


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5; learned from the labels outside the held-out fold.

    Null and empty texts are scored like any other; rows with equal or null ids are judged one by one; an empty table gives
    no rows, and without usable labels all rows stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, fit(docs, labels, "toxic", fold("doc_id", 5) != 0))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the one with the largest id.

    A null text is an empty one; a null id is the smallest; rows that share id and text stay together; an empty table gives
    no rows.
    """
    return without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of texts linked by a similarity of 0.75 of their five-word shingles, the one with the smallest id.

    Null and empty texts and null ids have no links and stay; rows that share an id stay or go together; an empty table
    gives no rows.
    """
    return without_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of ``PASSAGE_BYTES``-byte strings that stand more than once; ``n_chars`` follows.

    Null texts stay null, empty and shorter ones as they are; equal or null ids don't matter; an empty table gives no rows.
    """
    out = without_repeats(docs, size=PASSAGE_BYTES)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids: one row per piece of a document with its place.

    A null or empty text is the end id alone; rows with equal or null ids are documents of their own; an empty table gives
    no rows.
    """
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack_sequences),
]
# a trained network, cut passages and fitted patterns are no SQL; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage staged, and the stage before it, is removed when it is written."""
    docs, place = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch_scope(spark) as scope:
            docs, written = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
            scope.keep(written)
        if place:
            discard(spark, place)
        place = written
    return docs
