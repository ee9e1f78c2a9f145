"""Folds and bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; null for a null id."""
    return (F.crc32(F.col(id_col).cast("string")) % folds).cast("int")


def training_rows(documents: DataFrame, labels: DataFrame, label: str, in_training: Column, per_class: int) -> DataFrame:
    """(doc_id, text, y, weight): at most ``per_class`` labelled documents of each class, those with the least hash of their
    id, weighted so that the classes count as in all labels. ``in_training`` is a condition on ``doc_id`` of the labels.

    Labels that are null or other than 0 and 1, or whose document is not there, are no examples. The sample is bounded
    by its parameter, so its ids may be broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & in_training)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in (0, 1):
        total = totals.get(y, 0)
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        part = part.withColumn("weight", F.lit(total / max(1, min(total, per_class))).cast("double"))
        picked = part if picked is None else picked.unionByName(part)
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "doc_id")
