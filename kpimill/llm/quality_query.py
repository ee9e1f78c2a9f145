"""op8 over ``documents``."""

from pyspark.sql import functions as F

from kpimill.llm.labelled import fold
from kpimill.llm.quality import fit, score
from kpimill.llm.registry import query, table


@query("op8_quality")
def op8_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = fit(documents, table(spark, sf_dir, "labels"), "quality", fold("doc_id", 4) != 2)
    return score(documents, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
