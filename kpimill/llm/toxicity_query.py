"""op1 over ``documents``."""

from pyspark.sql import functions as F

from kpimill.llm.labelled import fold
from kpimill.llm.registry import query, table
from kpimill.llm.toxicity import fit, score


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    net = fit(documents, table(spark, sf_dir, "labels"), "toxic", fold("doc_id", 5) != 0)
    return score(documents, net).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
