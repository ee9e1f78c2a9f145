"""Calculated fields of BI workbooks (XML)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

COLUMN_SCHEMA = "_caption string, _name string, calculation struct<_formula: string>"


def read_workbook_calcs(spark: SparkSession, path: str) -> DataFrame:
    """Name, remote name, formula and comment of every captioned calculation.

    Comment lines go to the comment; inside formulas the internal names are replaced by captions. Names are
    matched as bracketed tokens by a join, so a workbook's size does not matter.
    """
    columns = (
        spark.read.format("xml").option("rowTag", "column").schema(COLUMN_SCHEMA).load(path)
        .select(F.col("_metadata.file_path").alias("file"), "_caption", "_name", "calculation")
        .where("_caption IS NOT NULL AND calculation IS NOT NULL")
    )
    return resolve_formulas(columns.selectExpr("file", "_caption AS caption", "_name AS name", "calculation._formula AS formula"))


def resolve_formulas(calcs: DataFrame) -> DataFrame:
    """(file, caption, name, formula) -> name, remote_name, formula, comment."""
    calcs = calcs.distinct()
    captions = calcs.groupBy("file", F.col("name").alias("token")).agg(
        F.concat(F.lit("["), F.min("caption"), F.lit("]")).alias("shown"))
    lines = F.split("formula", "\r\n|\n")
    is_comment = lambda x: x.startswith("//")
    joined = lambda parts: F.concat_ws("", F.transform(parts, lambda x: F.concat(x, F.lit(" "))))
    split = calcs.where("formula IS NOT NULL").select(
        "file", "caption", "name",
        joined(F.filter(lines, lambda x: ~is_comment(x))).alias("body"),
        joined(F.filter(lines, is_comment)).alias("comment"),
    )
    tokens = split.select(
        "*", F.posexplode_outer(F.regexp_extract_all("body", F.lit(r"\[[^\]\[]*\]|[^\[]+|\["), F.lit(0))).alias("pos", "token"))
    named = tokens.join(captions, ["file", "token"], "left")
    parts = F.sort_array(F.collect_list(F.struct("pos", F.coalesce("shown", "token", F.lit("")).alias("t"))))
    return (
        named.groupBy("file", "caption", "name", "body", "comment")
        .agg(F.array_join(F.transform(parts, lambda p: p["t"]), "").alias("formula"))
        .select(F.concat(F.lit("["), "caption", F.lit("]")).alias("name"), F.col("name").alias("remote_name"),
                "formula", "comment")
        .distinct()
    )
