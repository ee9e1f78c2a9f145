"""Market data: bars from ticks, valuation of positions, order books, latest status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kpimill.session import materialize


def tick_order(ts: str, tie: str) -> Column:
    """One sortable number from a time and a whole-number tie-break.

    As a fixed-width value it lets first and last price be hash-aggregated; a struct would force a sort of all
    ticks before the aggregation.
    """
    micros = f"CAST(unix_micros(CAST({ts} AS TIMESTAMP)) AS DECIMAL(19,0))"
    shift = f"CAST('1{'0' * 19}' AS DECIMAL(20,0))"
    return F.expr(f"{micros} * {shift} + CAST({tie} AS DECIMAL(19,0))")


def bar_aggs(price: str, ts: str, tie: str) -> list[Column]:
    """Open, high, low, close and number of ticks of a group; ties in time are broken by a whole-number column."""
    at = tick_order(ts, tie)
    return [
        F.min_by(price, at).alias("open"),
        F.max(price).alias("highest"),
        F.min(price).alias("lowest"),
        F.max_by(price, at).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    ]


PARTIAL_BAR = (
    "bar_day date, bar_start timestamp, key string, open double, first_at decimal(38,0), close double, last_at decimal(38,0), highest double, "
    "lowest double, volume bigint"
)


def partial_bars(ticks: DataFrame, ts: str, key: str, price: str, width: str, tie: str) -> DataFrame:
    """Bars that can be merged: first and last price stand with their place in time."""
    at = tick_order(ts, tie)
    bars = ticks.groupBy(F.window(ts, width).alias("w"), F.col(key).cast("string").alias("key")).agg(
        *bar_aggs(price, ts, tie), F.min(at).alias("first_at"), F.max(at).alias("last_at"))
    return bars.select(
        F.to_date("w.start").alias("bar_day"), F.col("w.start").cast("timestamp").alias("bar_start"), "key", F.col("open").cast("double").alias("open"),
        F.col("first_at").cast("decimal(38,0)").alias("first_at"), F.col("close").cast("double").alias("close"),
        F.col("last_at").cast("decimal(38,0)").alias("last_at"), F.col("highest").cast("double").alias("highest"),
        F.col("lowest").cast("double").alias("lowest"), "volume")


def merged_bars(partials: DataFrame) -> DataFrame:
    """One bar per start and key from any number of partial ones, whatever their order; a partial bar again."""
    return partials.groupBy("bar_day", "bar_start", "key").agg(
        F.min_by("open", "first_at").alias("open"), F.min("first_at").alias("first_at"), F.max_by("close", "last_at").alias("close"),
        F.max("last_at").alias("last_at"), F.max("highest").alias("highest"), F.min("lowest").alias("lowest"), F.sum("volume").alias("volume"))


def ohlcv(ticks: DataFrame, ts: str, key: str, price: str, width: str, tie: str) -> DataFrame:
    """Bars per key and time window of a fixed width; combined map-side, so a busy instrument is no hot spot."""
    return (
        ticks.groupBy(F.window(ts, width).alias("w"), key)
        .agg(*bar_aggs(price, ts, tie))
        .select(F.col("w.start").alias("bar_start"), key, "open", "highest", "lowest", "close", "volume")
    )


def position_value(positions: DataFrame, candles: DataFrame, rates: DataFrame, on: str = "ticker") -> DataFrame:
    """Positions with each candle's close: lots x close, and the same in base currency (rate 1 when unlisted)."""
    value = F.col("lots") * F.col("close")
    return (
        candles.join(positions, on)
        .join(rates, "currency", "left")
        .withColumn("cur_value", value)
        .withColumn("base_value", value * F.coalesce("rate", F.lit(1.0)))
        .drop("rate")
    )


def position_share(valued: DataFrame, by: str = "name", value: str = "base_value") -> DataFrame:
    """Value and share of the total by name. The positions are valued once: the total is that of the written per-name rows."""
    per_name = materialize(valued.groupBy(by).agg(F.sum(value).alias("value")), "per-name")
    return per_name.withColumn("share", F.col("value") / per_name.agg(F.sum("value")).scalar())


def portfolio_total(positions: DataFrame, rates: DataFrame) -> DataFrame:
    """Total price and total yield of all positions in base currency."""
    rate = F.coalesce("rate", F.lit(1.0))
    return positions.join(rates, "currency", "left").agg(
        F.sum(F.col("average_price") * rate).alias("total_price"),
        F.sum(F.col("expected_yield") * rate).alias("total_yield"),
    )


def book_depth(levels: DataFrame, key: str, depth: int, tie: str) -> DataFrame:
    """First ``depth`` levels per instrument and side: bids from the highest price, asks from the lowest.

    The rank limit is applied per input partition before the shuffle, so no task sorts a whole side.
    """
    signed = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    order = W.partitionBy(key, "side").orderBy("__signed", tie)
    return (
        levels.withColumn("__signed", signed)
        .withColumn("level", F.row_number().over(order))
        .where(F.col("level") <= depth)
        .drop("__signed")
    )


def _last_events(events: DataFrame, key: str, at: Column) -> DataFrame:
    """The event of each key with the greatest order number: found by a hash aggregation, then picked by (key, number)."""
    numbered = events.withColumn("__at", at)
    last = numbered.groupBy(F.col(key).alias("__key")).agg(F.max("__at").alias("__last"))
    same = [F.equal_null(F.col(key), F.col("__key")), F.col("__at") == F.col("__last")]
    return numbered.join(last, same, "left_semi")


def latest_book(books: DataFrame, key: str, ts: str, depth: int, tie: str) -> DataFrame:
    """Latest book per instrument from events that carry arrays of bids and asks, cut to a depth; of equal times the one with
    the greater tie-break (a whole number, unique per instrument and time)."""
    last = _last_events(books, key, tick_order(ts, tie))
    return last.select(key, ts, F.slice("bids", 1, depth).alias("bids"), F.slice("asks", 1, depth).alias("asks"))


def latest_status(events: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """Last event per instrument by (time, whole-number tie-break)."""
    return _last_events(events, key, tick_order(*order)).select(key, *fields)
