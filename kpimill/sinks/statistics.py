"""Column statistics that merge: made per partition, kept in a table, made again only where a load has changed something.

A row is one column of one partition: rows, nulls, least and greatest value, a HyperLogLog sketch of the distinct values and a
KLL sketch of the quantiles of numbers. Counts and bounds add up exactly; the sketches merge without loss of accuracy, so the
statistics of a table are those of its partitions merged, whatever was loaded when.

The distinct count is off by 1.6 % (one standard error, ``LOG_K`` = 12), the rank of a quantile by less than 1.7 % with a
certainty of 99 % (``K`` = 200).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kpimill.sinks.versions import VersionedTable, open_table

LOG_K, K = 12, 200
DISTINCT_ERROR, RANK_ERROR = 0.016, 0.017
QUANTILES = (0.25, 0.5, 0.75)
SCHEMA = (
    "partition string, column_name string, row_count bigint, null_count bigint, low double, high double, low_text string, "
    "high_text string, distinct_sketch binary, quantile_sketch binary"
)


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def partition_key(columns: list[str]) -> Column:
    """The values of a partition as one text."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})


def column_profiles(df: DataFrame, partition: Column, columns: list[str] | None = None) -> DataFrame:
    """One row per partition and column, from one pass over the rows; sketches are combined before the shuffle."""
    columns = columns or df.columns
    kinds = {f.name: f.dataType for f in df.schema}
    null = lambda t: F.lit(None).cast(t)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        number, text = value.cast("double"), value.cast("string")
        is_number = _is_number(kinds[c])
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(value.isNull()).alias("null_count"),
                (F.min(number) if is_number else null("double")).alias("low"),
                (F.max(number) if is_number else null("double")).alias("high"),
                (null("string") if is_number else F.min(text)).alias("low_text"),
                (null("string") if is_number else F.max(text)).alias("high_text"),
                F.hll_sketch_agg(text, LOG_K).alias("distinct_sketch"),
                (F.kll_sketch_agg_double(number, K) if is_number else null("binary")).alias("quantile_sketch"),
            ).alias(f"c{i}")
        )
    wide = df.groupBy(partition.alias("partition")).agg(*aggs)
    rows = wide.select("partition", F.col("__rows").alias("row_count"), F.inline(F.array(*[f"c{i}" for i in range(len(columns))])))
    return rows.select(*T.StructType.fromDDL(SCHEMA).names)


def merged(profiles: DataFrame) -> DataFrame:
    """Statistics per column of all partitions together: column_name, row_count, null_count, low, high (numbers), low_text,
    high_text (others), distinct_count (an estimate), quantiles (estimates, numbers only)."""
    per = profiles.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_count"), F.kll_merge_agg_double("quantile_sketch").alias("__q"),
    )
    known = F.col("low").isNotNull()
    quantiles = F.when(known, F.kll_sketch_get_quantile_double("__q", F.array(*map(F.lit, QUANTILES))))
    return per.withColumn("quantiles", quantiles).drop("__q")


def update_statistics(
    spark: SparkSession, path: str, df: DataFrame, partition_by: list[str], changed: Column | None = None, columns: list[str] | None = None
) -> VersionedTable:
    """Make the profiles of the changed partitions (a condition on the partition columns; all if none is given) again.

    Only rows of changed partitions are read, and partitions that are gone lose their profiles.
    """
    store = open_table(spark, path, SCHEMA)
    key = partition_key(partition_by)
    rows = df if changed is None else df.where(changed)
    fresh = column_profiles(rows, key, columns)
    if changed is None:
        store.replace(F.lit(True), fresh)
        return store
    # the condition on the stored keys: their values are taken out of the text again
    values = F.from_json("partition", T.StructType([T.StructField(c, T.StringType()) for c in partition_by]))
    kinds = {f.name: f.dataType for f in df.schema}
    held = store.read().select("partition").distinct().select("partition", *[values[c].cast(kinds[c]).alias(c) for c in partition_by])
    gone = [r[0] for r in held.where(changed).select("partition").collect()]  # as many as folders
    wanted = F.col("partition").isin(gone + [r[0] for r in rows.select(key.alias("k")).distinct().collect()])
    store.replace(wanted, fresh)
    return store


def table_statistics(store: VersionedTable) -> DataFrame:
    return merged(store.read())
