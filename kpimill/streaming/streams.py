"""Streaming forms: bars from ticks, latest books and status, file arrivals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kpimill.operators.market import PARTIAL_BAR, bar_aggs, merged_bars, partial_bars, tick_order
from kpimill.session import discard, staged
from kpimill.sinks.versions import VersionedTable, open_table


def stream_ohlcv(
    ticks: DataFrame, ts: str, key: str, price: str, tie: str, width: str = "1 minute", delay: str = "10 minutes"
) -> DataFrame:
    """Bars from a stream of ticks; ticks later than the watermark are dropped, a bar is final when it passes. ``run_to_bars``
    keeps late ticks."""
    return (
        ticks.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("w"), key)
        .agg(*bar_aggs(price, ts, tie))
        .select(F.col("w.start").alias("bar_start"), key, "open", "highest", "lowest", "close", "volume")
    )


def bars_table(spark: SparkSession, path: str) -> VersionedTable:
    """Where ``run_to_bars`` keeps its partial bars, by day."""
    return open_table(spark, path, PARTIAL_BAR, ["bar_day"])


def run_to_bars(
    ticks: DataFrame, table: VersionedTable, checkpoint: str, ts: str, key: str, price: str, tie: str, width: str = "1 minute",
    delay: str = "10 minutes", feed: str = "ticks",
) -> None:
    """Keep bars up to date with a stream of ticks, late ones included, until the input that is there now is used up.

    Each batch of ticks is made into partial bars, which are merged with the stored bars of the days they touch; no state
    is held between batches and no tick is dropped. A tick is late when it is more than ``delay`` older than the newest one
    of the batches before; late ticks change their bars like any other, and their number stands in the version's notes. A
    batch goes in by one commit with its number, so one that is given again changes nothing.
    """
    spark = table.spark

    def merge(rows: DataFrame, batch: int) -> None:
        if table.seen(feed, batch):
            return
        before = table.manifest()["notes"] or {"newest": None, "late": 0, "late_in_all": 0}
        rows, stage = staged(rows, "ticks")
        limit = F.lit(before["newest"]).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        seen = rows.agg(F.max(F.col(ts).cast("timestamp")).cast("string").alias("newest"), F.count_if(F.col(ts) < limit).alias("late")).first()
        new, place = staged(partial_bars(rows.where(F.col(ts).isNotNull()), ts, key, price, width, tie), "bars")
        days = [r[0] for r in new.select("bar_day").distinct().collect()]  # as many as folders
        touched = F.col("bar_day").isin(days) if days else F.lit(False)
        newest = max(filter(None, (before["newest"], seen["newest"])), default=None)
        notes = {"newest": newest, "late": seen["late"], "late_in_all": before["late_in_all"] + seen["late"]}
        table.replace(touched, merged_bars(table.read().where(touched).unionByName(new)), (feed, batch), notes)
        discard(spark, stage, place)

    ticks.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def table_stream(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table as a stream of its files; ``path`` may be a folder or a single file."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", hadoop.getName()).parquet(str(hadoop.getParent()))


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream's rows to a parquet table until the input that is there now is used up."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    glob: str = "*",
    sep: str = ";",
    files_per_batch: int = 100,
) -> None:
    """Handle newly arrived delimited files in batches, each file once; the checkpoint remembers which.

    The handler gets the rows with their file name. It must be repeatable: a batch that failed half-way is
    given again.
    """
    rows = (
        spark.readStream.schema(schema).option("header", True).option("sep", sep)
        .option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).csv(path)
        .withColumn("data_source", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    )
    query = (
        rows.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def stream_latest(events: DataFrame, key: str, ts: str, tie: str, fields: list[str]) -> DataFrame:
    """The last event per instrument from a stream, by (time, whole-number tie-break): one row of state per instrument."""
    last = events.groupBy(key).agg(F.max_by(F.struct(*fields), tick_order(ts, tie)).alias("s"))
    return last.select(key, "s.*")


def stream_latest_book(books: DataFrame, key: str, ts: str, tie: str, depth: int) -> DataFrame:
    """The latest order book per instrument from a stream of books, cut to a depth."""
    cut = books.withColumns({c: F.slice(c, 1, depth) for c in ("bids", "asks")})
    return stream_latest(cut, key, ts, tie, [ts, "bids", "asks"])


def run_to_latest(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Keep a small table of a stream's current rows (one per instrument) until the input that is there now is used up."""

    def replace(rows: DataFrame, _: int) -> None:
        rows.write.mode("overwrite").parquet(path)

    query = (
        stream.writeStream.outputMode("complete").foreachBatch(replace)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
