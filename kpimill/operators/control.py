"""Load control: watermarks and the freshness gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def slice_watermark(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Latest date and number of rows per slice."""
    return df.groupBy(*keys).agg(F.max(date_col).alias("max_date"), F.count(F.lit(1)).alias("row_count"))


def freshness_gate(
    new: DataFrame, stored: DataFrame, keys: list[str], date_col: str, month_col: str, file_col: str | None = None
) -> DataFrame:
    """Per slice, whether the new rows replace the stored ones.

    They do when their latest date is not older than the stored one (the month start when nothing is stored)
    *and* they have more rows. Where several files bring the same slice, every file is judged by itself; of those
    that may replace it (of all, when none may) the one with the latest date and then the most rows stands for it.
    """
    fresh = slice_watermark(new, keys + ([file_col] if file_col else []), date_col)
    kept = slice_watermark(stored, keys, date_col).select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.col("max_date").alias("stored_max_date"),
        F.col("row_count").alias("stored_row_count"),
    )
    newer = F.col("max_date") >= F.coalesce("stored_max_date", month_col)
    more = F.col("row_count") > F.coalesce("stored_row_count", F.lit(0))
    same = [F.equal_null(F.col(k), F.col(f"__{k}")) for k in keys]
    judged = (
        fresh.join(kept, same, "left")
        .drop(*[f"__{k}" for k in keys])
        .withColumn("load", F.coalesce(newer & more, F.lit(False)))
    )
    if not file_col:
        return judged
    rest = [c for c in judged.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct("load", "max_date", "row_count", file_col))
    return judged.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def accepted(new: DataFrame, decision: DataFrame, keys: list[str], file_col: str | None = None) -> DataFrame:
    """The new rows of the slices the gate lets through."""
    on = keys + ([file_col] if file_col else [])
    yes = decision.where("load").select(*[F.col(k).alias(f"__{k}") for k in on])
    return new.join(yes, [F.equal_null(F.col(k), F.col(f"__{k}")) for k in on], "left_semi")
