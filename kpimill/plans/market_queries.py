"""Market-data queries, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpimill.operators import market
from kpimill.plans.registry import ORACLES, query
from kpimill.session import scratch_path
from kpimill.sources import analog as A
from kpimill.sources.analog import table, with_views
from kpimill.streaming import streams


def _bars_sql(trunc: str) -> str:
    return with_views("ticks", f"""
    SELECT date_trunc('{trunc}', ts) AS bar_start, ticker, first(price ORDER BY ts, event_id) AS open, max(price) AS highest,
      min(price) AS lowest, last(price ORDER BY ts, event_id) AS close, count(*) AS volume FROM ticks GROUP BY 1, 2""")


def _bars(spark, sf, width):
    bars = market.ohlcv(A.ticks(spark, sf), "ts", "ticker", "price", width, "event_id")
    return bars.withColumn("bar_start", F.col("bar_start").cast("timestamp_ntz"))


@query("ohlcv_minute", _bars_sql("minute"))
def ohlcv_minute(spark, sf):
    return _bars(spark, sf, "1 minute")


@query("ohlcv_daily", _bars_sql("day"))
def ohlcv_daily(spark, sf):
    return _bars(spark, sf, "1 day")


@query("stream_ohlcv", f"""
    SELECT * FROM ({_bars_sql('minute')})
    WHERE bar_start + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_ohlcv(spark, sf):
    """Minute bars from a stream of the events table; only bars that the watermark has closed are written."""
    batch = table(spark, sf, "events")
    raw = streams.table_stream(spark, f"{sf}/events.parquet", batch.schema)
    ticks = raw.selectExpr("CAST(ts AS TIMESTAMP) AS ts", "event_type AS ticker", "value AS price", "event_id")
    path, checkpoint = scratch_path(spark, "bars"), scratch_path(spark, "bars-checkpoint")
    bars = streams.stream_ohlcv(ticks, "ts", "ticker", "price", "event_id")
    bars = bars.withColumn("bar_start", F.col("bar_start").cast("timestamp_ntz"))
    streams.run_to_table(bars, path, checkpoint)
    return spark.read.schema(bars.schema).parquet(path)


@query("stream_ohlcv_late", _bars_sql("minute"))
def stream_ohlcv_late(spark, sf):
    """Minute bars from ticks that come in no order at all, in several batches: late ones change the bars they belong to."""
    source, path, checkpoint = (scratch_path(spark, n) for n in ("shuffled-ticks", "late-bars", "late-bars-checkpoint"))
    ticks = table(spark, sf, "events").selectExpr("CAST(ts AS TIMESTAMP) AS ts", "event_type AS ticker", "value AS price", "event_id")
    ticks.repartition(3, F.xxhash64("event_id")).write.parquet(source)
    bars = streams.bars_table(spark, path)
    streams.run_to_bars(streams.table_stream(spark, source, ticks.schema, files_per_batch=1), bars, checkpoint, "ts", "ticker", "price", "event_id")
    return bars.read().select(F.col("bar_start").cast("timestamp_ntz").alias("bar_start"), F.col("key").alias("ticker"), "open", "highest", "lowest", "close", "volume")


_CLOSES_SQL = """closes AS (SELECT c_mktsegment AS ticker, arg_max(o_totalprice, o_orderkey) AS close
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)"""


def _closes(spark, sf):
    """Last close per ticker: one candle each."""
    customer = table(spark, sf, "customer").selectExpr("c_custkey AS o_custkey", "c_mktsegment AS ticker")
    return table(spark, sf, "orders").join(customer, "o_custkey").groupBy("ticker").agg(
        F.max_by("o_totalprice", "o_orderkey").alias("close"))


def _rates(spark):
    return spark.createDataFrame([("USD", 76.0)], "currency string, rate double")


_VALUED_SQL = "SELECT name, ticker, currency, lots, close, round(lots * close, 2) AS cur_value, " \
    "round(lots * close * CASE currency WHEN 'USD' THEN 76.0::DOUBLE ELSE 1.0::DOUBLE END, 2) AS base_value " \
    "FROM positions JOIN closes USING (ticker)"


def _valued(spark, sf):
    return market.position_value(A.positions(spark, sf), _closes(spark, sf), _rates(spark))


@query("position_value", with_views("positions", _VALUED_SQL, _CLOSES_SQL))
def position_value(spark, sf):
    return _valued(spark, sf).selectExpr(
        "name", "ticker", "currency", "lots", "close", "round(cur_value, 2) AS cur_value", "round(base_value, 2) AS base_value")


@query("position_share", with_views("positions", f"""
    SELECT ticker, round(sum(base_value), 2) AS value, round(sum(base_value) / (SELECT sum(base_value) FROM ({_VALUED_SQL})), 8) AS share
    FROM ({_VALUED_SQL}) GROUP BY 1""", _CLOSES_SQL))
def position_share(spark, sf):
    shares = market.position_share(_valued(spark, sf), "ticker")
    return shares.selectExpr("ticker", "round(value, 2) AS value", "round(share, 8) AS share")


@query("portfolio_total", with_views("positions", """
    SELECT round(CAST(sum(CAST(average_price AS DECIMAL(18,2)) * r) AS DOUBLE), 2) AS total_price,
      round(CAST(sum(CAST(expected_yield AS DECIMAL(18,2)) * r) AS DOUBLE), 2) AS total_yield
    FROM (SELECT *, CASE currency WHEN 'USD' THEN 76 ELSE 1 END AS r FROM positions)"""))
def portfolio_total(spark, sf):
    total = market.portfolio_total(A.positions(spark, sf), _rates(spark))
    return total.selectExpr("round(total_price, 2) AS total_price", "round(total_yield, 2) AS total_yield")


@query("book_depth", with_views("book", """
    SELECT instrument, side, price, event_id, CAST(row_number() OVER (PARTITION BY instrument, side ORDER BY
      CASE side WHEN 'bid' THEN -price ELSE price END, event_id) AS INTEGER) AS level FROM book QUALIFY level <= 3"""))
def book_depth(spark, sf):
    return market.book_depth(A.book(spark, sf), "instrument", 3, "event_id")


@query("latest_book", """
    SELECT instrument, ts, bids[1:2] AS bids, asks[1:2] AS asks FROM (
      SELECT event_type AS instrument, max(ts) AS ts, arg_max([value, value - 1, value - 2], (ts, event_id)) AS bids,
        arg_max([value + 1, value + 2, value + 3], (ts, event_id)) AS asks FROM events GROUP BY 1)""")
def latest_book(spark, sf):
    """Last book event per instrument, cut to two levels."""
    return market.latest_book(_books(table(spark, sf, "events")), "instrument", "ts", 2, "event_id")


def _books(events):
    return events.selectExpr(
        "event_type AS instrument", "ts", "event_id", "array(value, value - 1, value - 2) AS bids", "array(value + 1, value + 2, value + 3) AS asks")


@query("latest_status", """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS ts FROM events GROUP BY 1""")
def latest_status(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("event_type", "status")
    return market.latest_status(events, "user_id", ["ts", "event_id"], ["status", "ts"])


def _event_stream(spark, sf):
    return streams.table_stream(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)


def _current(spark, stream, name):
    path = scratch_path(spark, name)
    streams.run_to_latest(stream, path, scratch_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_latest_book", ORACLES["latest_book"])
def stream_latest_book(spark, sf):
    """The same from a stream of book events."""
    return _current(spark, streams.stream_latest_book(_books(_event_stream(spark, sf)), "instrument", "ts", "event_id", 2), "books")


@query("stream_latest_status", ORACLES["latest_status"])
def stream_latest_status(spark, sf):
    """The same from a stream of status events."""
    events = _event_stream(spark, sf).withColumnRenamed("event_type", "status")
    return _current(spark, streams.stream_latest(events, "user_id", "ts", "event_id", ["status", "ts"]), "status")


@query("file_arrivals", "SELECT event_type, count(*) AS n, min(event_id)::BIGINT AS first_id FROM events GROUP BY 1")
def file_arrivals(spark, sf):
    """Delimited files that arrive in two portions, each handled once; a third look finds nothing new."""
    source, path, checkpoint = (scratch_path(spark, n) for n in ("arriving", "arrived", "arrivals-checkpoint"))
    events = table(spark, sf, "events").selectExpr("CAST(event_id AS STRING) AS event_id", "event_type")

    def handle(rows, batch):
        rows.write.mode("append").parquet(path)

    for portion in ("event_id % 2 = 0", "event_id % 2 = 1", "false"):
        events.where(portion).write.mode("append").option("header", True).option("sep", ";").csv(source)
        streams.stream_files(spark, source, events.schema, handle, checkpoint, glob="part-*.csv")
    stored = spark.read.parquet(path)
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min(F.expr("CAST(event_id AS BIGINT)")).alias("first_id"))
