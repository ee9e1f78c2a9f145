"""Distinct counts that can be refreshed a day at a time: exact bitmaps of subscribers per day and group.

A day's subscribers of a group are bitmaps of 32,768 neighbouring ids each. Weeks and months are unions of their days'
bitmaps, so no period has to go back to the lots, and when a day is loaded again only that day's bitmaps are made again.
Lot counts, volumes and values of the day stand beside the bitmaps and are added up. The subscribers of both roles together
are the union of the sellers' and the purchasers' bitmaps, made when they are counted, not stored. Bitmaps suit ids that are numbered
densely; a bitmap of few ids costs its 4 KB in memory, though little on disk.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from kpimill.functions.periods import Window, trunc_sql
from kpimill.operators.cube import ENTRY_KEYS, TABLE_NAMES
from kpimill.sinks.versions import VersionedTable

DISTINCT_ARMS = ("distinct_sellers", "distinct_purchasers", "distinct_all")
DAILY_SCHEMA = (
    "month date, day date, arm string, traffic_type string, branch_id int, bucket bigint, bitmap binary, "
    "lots bigint, volume double, value double"
)
PARTITION_BY = ["month"]


def _side(arm: str, role: str, date: str, wanted: str, with_lot: bool) -> str:
    measures = {"lot": ("lot_id", "BIGINT"), "volume": ("lot_volume", "DOUBLE"), "value": ("lot_value", "DOUBLE")}
    lot = ", ".join(f"'{n}', CAST({c if with_lot else 'NULL'} AS {t})" for n, (c, t) in measures.items())
    return (
        f"CASE WHEN {wanted.format(d=f'CAST({date} AS DATE)')} THEN named_struct('arm', '{arm}', 'day', CAST({date} AS DATE), 'traffic_type', traffic_type, "
        f"'branch_id', CAST(branch_id_{role} AS INT), 'subs_id', CAST(subs_id_{role} AS BIGINT), {lot}) END"
    )


def daily_bitmaps(lots: DataFrame, wanted: str = "{d} IS NOT NULL", arms: Iterable[str] = DISTINCT_ARMS) -> DataFrame:
    """Bitmaps and sums per day, arm, group and bucket of ids, from one scan of the lots. ``wanted`` is SQL on a date ``{d}``.

    ``distinct_all`` has no rows of its own where both other arms are there. A row of no bucket holds the lots without a subscriber; they count as lots, not as subscribers.
    """
    sold, bought = "lot_placement_date", "lot_purchase_date"
    entries = {
        "distinct_sellers": [("seller", sold, True)],
        "distinct_purchasers": [("purchaser", bought, True)],
        "distinct_all": [("seller", sold, False), ("purchaser", bought, False)],
    }
    arms = list(arms)
    if {"distinct_sellers", "distinct_purchasers"} <= set(arms):
        arms = [a for a in arms if a != "distinct_all"]
    parts = [_side(a, role, date, wanted, lot) for a in arms for role, date, lot in entries[a]]
    dates = {date for a in arms for _, date, _ in entries[a]}
    needed = " OR ".join(wanted.format(d=f"CAST({d} AS DATE)") for d in sorted(dates))
    rows = lots.where(needed).selectExpr(f"explode(array({', '.join(parts)})) AS e").where("e IS NOT NULL").select("e.*")
    keys = ["day", "arm", "traffic_type", "branch_id"]
    # the ids are exchanged, not the bitmaps that a task could make of its own few: those hold less the more tasks there are
    parts = int(lots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("bucket", F.expr("bitmap_bucket_number(subs_id)")).repartition(parts, *keys, "bucket")
    return (
        rows.groupBy(*keys, "bucket")
        .agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(subs_id))").alias("bitmap"),
            F.count("lot").alias("lots"), F.sum("volume").alias("volume"), F.sum("value").alias("value"),
        )
        .selectExpr("trunc(day, 'month') AS month", *keys, "bucket", "bitmap", "lots", "volume", "value")
    )


def days_sql(days: Iterable[dt.date]) -> str:
    """The condition ``{d}`` is one of the days."""
    return "{d} IN (" + ", ".join(f"DATE '{d}'" for d in sorted(days)) + ")"


def refresh_days(table: VersionedTable, lots: DataFrame, days: Iterable[dt.date], batch: tuple[str, int] | None = None) -> dict[str, int]:
    """Make the bitmaps of some days again from the lots; other days are neither read from the lots nor written, but for
    those in the same month's files."""
    wanted = days_sql(days)
    return table.replace(F.expr(wanted.format(d="day")), daily_bitmaps(lots, wanted), batch)


def distinct_counts(daily: DataFrame, windows: list[Window], arms: Iterable[str] = DISTINCT_ARMS) -> DataFrame:
    """The distinct arms of the period cube over the windows, in its layout, from daily bitmaps."""
    arms = list(arms)
    if "distinct_all" in arms:
        measures = ("lots", "volume", "value")
        both = daily.where("arm <> 'distinct_all'").withColumns({"arm": F.lit("distinct_all"), **{c: F.lit(None).cast(daily.schema[c].dataType) for c in measures}})
        daily = daily.unionByName(both)
    daily = daily.where(F.col("arm").isin(arms))
    out = None
    for win in windows:
        keys: list[Column] = [F.expr(trunc_sql("day", win.kind)).alias("report_date"), *(F.col(c) for c in ("arm", "traffic_type", "branch_id"))]
        sums = [F.sum(c).alias(c) for c in ("lots", "volume", "value")]
        # per bucket of ids first: a group that holds much of the data is spread over its buckets
        buckets = daily.where(win.sql("day")).groupBy(*keys, "bucket").agg(F.expr("bitmap_or_agg(bitmap)").alias("bitmap"), *sums)
        one = buckets.groupBy("report_date", "arm", "traffic_type", "branch_id").agg(F.expr("sum(bitmap_count(bitmap))").alias("subs"), *sums)
        one = one.withColumn("period", F.lit(win.kind))
        out = one if out is None else out.unionByName(one)
    names = "element_at(map({}), arm)".format(", ".join(f"'{a}', '{TABLE_NAMES[a]}'" for a in DISTINCT_ARMS))
    known = {
        "period": "period", "table_name": names, "report_date": "report_date", "traffic_type": "traffic_type",
        "branch_id_seller": "CASE WHEN arm <> 'distinct_purchasers' THEN branch_id END",
        "branch_id_purchaser": "CASE WHEN arm <> 'distinct_sellers' THEN branch_id END",
    }
    return out.selectExpr(
        *[f"CAST({known.get(k, 'NULL')} AS {t}) AS {k}" for k, t in ENTRY_KEYS.items()],
        "CASE WHEN arm <> 'distinct_purchasers' THEN subs END AS sellers_count",
        "CASE WHEN arm <> 'distinct_sellers' THEN subs END AS purchasers_count",
        "CASE WHEN arm <> 'distinct_all' THEN lots END AS lot_count",
        "volume AS lot_volume",
        "value AS sold_value",
    )
