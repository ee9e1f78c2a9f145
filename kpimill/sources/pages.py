"""Paged replies with positional rows, and lists of nested positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kpimill.functions import fixed_values as fv

PAGE_SCHEMA = "start bigint, history struct<columns: array<string>, data: array<array<string>>>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).json(path)


def block_rows(pages: DataFrame, fields=fv.HISTORY_FIELDS, keep: list[str] | None = None) -> DataFrame:
    """Rows of columns+data blocks, fields found by name on each page; missing numbers become 0.

    The first field is the text key, the others are numbers.
    """
    at = [F.array_position("history.columns", F.lit(f)).cast("int") - 1 for f in fields]
    rows = pages.select(*(keep or []), *[p.alias(f"__p{i}") for i, p in enumerate(at)], F.explode("history.data").alias("r"))
    cell = lambda i: F.get("r", F.col(f"__p{i}"))
    key = cell(0).alias(fields[0])
    numbers = [F.coalesce(cell(i).cast("double"), F.lit(0.0)).alias(f) for i, f in enumerate(fields) if i]
    return rows.select(*(keep or []), key, *numbers)


def page_gaps(pages: DataFrame, group: str | None = None) -> DataFrame:
    """Pages whose start is neither 0 nor the end of another page: something between is missing."""
    keys = [group] if group else []
    ends = pages.select(*[F.col(k).alias(f"__{k}") for k in keys],
                        (F.col("start") + F.size("history.data")).alias("__end")).where(F.size("history.data") > 0)
    cond = [F.col("start") == F.col("__end")] + [F.col(k) == F.col(f"__{k}") for k in keys]
    return pages.where(F.col("start") > 0).join(ends, cond, "left_anti").select(*keys, "start")


POSITION_SCHEMA = """positions array<struct<figi: string, ticker: string, isin: string, instrument_type: string,
    balance: double, blocked: double, expected_yield: struct<currency: string, value: double>, lots: bigint,
    average_position_price: struct<currency: string, value: double>,
    average_position_price_no_nkd: struct<currency: string, value: double>, name: string>>"""


def flatten_positions(portfolios: DataFrame) -> DataFrame:
    """One flat row per position: 13 columns."""
    return portfolios.select(F.explode("positions").alias("p")).selectExpr(
        "p.figi", "p.ticker", "p.isin", "p.instrument_type", "p.balance", "p.blocked",
        "p.expected_yield.currency AS expected_yield_currency", "p.expected_yield.value AS expected_yield_value",
        "p.lots", "p.average_position_price.currency AS average_price_currency",
        "p.average_position_price.value AS average_price_value",
        "p.average_position_price_no_nkd.value AS average_price_no_nkd", "p.name",
    )


def candle_rows(histories: DataFrame, ticker: str, candles: str, date_from: str, date_to: str) -> DataFrame:
    """Candles of nested histories inside a date range, one row each."""
    return (
        histories.select(F.col(ticker).alias("ticker"), F.explode(candles).alias("c"))
        .where((F.col("c.time") >= F.lit(date_from).cast("timestamp_ntz")) & (F.col("c.time") < F.lit(date_to).cast("timestamp_ntz")))
        .selectExpr("c.time AS date", "ticker", "c.o AS open", "c.h AS highest", "c.l AS lowest", "c.c AS close", "c.v AS volume")
    )
