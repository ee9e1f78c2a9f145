"""Reporting periods: truncation, period ends, period windows and calendar helpers."""

from __future__ import annotations

import calendar
import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KINDS = ("daily", "weekly", "monthly")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _check(kind: str) -> None:
    if kind not in KINDS:
        raise ValueError(f"period kind must be one of {KINDS}, got {kind!r}")


def trunc_sql(date: str, kind: str) -> str:
    """SQL of the first day of the day, ISO week or month a date belongs to."""
    _check(kind)
    day = f"CAST({date} AS DATE)"
    return day if kind == "daily" else f"trunc({day}, '{'week' if kind == 'weekly' else 'month'}')"


def end_sql(date: str, kind: str) -> str:
    """SQL of the last day of the day, ISO week or month a date belongs to."""
    _check(kind)
    day = f"CAST({date} AS DATE)"
    if kind == "daily":
        return day
    return f"date_add(trunc({day}, 'week'), 6)" if kind == "weekly" else f"last_day({day})"


def trunc_period(col: Column | str, kind: str) -> Column:
    """First day of the day, ISO week or month a date belongs to."""
    _check(kind)
    day = _col(col).cast("date")
    return day if kind == "daily" else F.trunc(day, "week" if kind == "weekly" else "month")


def period_end(col: Column | str, kind: str) -> Column:
    """Last day of the day, ISO week or month a date belongs to."""
    _check(kind)
    day = _col(col).cast("date")
    if kind == "daily":
        return day
    return F.date_add(F.trunc(day, "week"), 6) if kind == "weekly" else F.last_day(day)


@dataclass(frozen=True)
class Window:
    """Whole periods of one kind, first day to last day inclusive."""

    kind: str
    start: dt.date
    end: dt.date

    def sql(self, date: str) -> str:
        return f"{date} BETWEEN DATE '{self.start}' AND DATE '{self.end}'"


def window(kind: str, start: dt.date, till: dt.date) -> Window:
    """Whole periods from ``start`` while the period start is not after ``till``.

    ``till`` is moved to the end of its period. A start inside a period is refused: the periods
    would overlap or leave gaps.
    """
    _check(kind)
    if kind == "weekly":
        if start.weekday() != 0:
            raise ValueError(f"weekly periods start on a Monday, got {start}")
        end = till + dt.timedelta(days=6 - till.weekday())
    elif kind == "monthly":
        if start.day != 1:
            raise ValueError(f"monthly periods start on the 1st, got {start}")
        end = till.replace(day=calendar.monthrange(till.year, till.month)[1])
    else:
        end = till
    return Window(kind, start, end)


def period_spine(spark: SparkSession, kind: str, start: dt.date, till: dt.date) -> DataFrame:
    """One row per period: kind, first day, last day."""
    w = window(kind, start, till)
    step = {"daily": "1 day", "weekly": "7 days", "monthly": "1 month"}[kind]
    starts = F.sequence(F.lit(w.start), F.lit(w.end), F.expr(f"interval {step}"))
    if w.end < w.start:
        starts = F.array().cast("array<date>")
    first = F.col("period_start")
    return (
        spark.range(1)
        .select(F.lit(kind).alias("period"), F.explode(starts).alias("period_start"))
        .withColumn("period_end", period_end(first, kind))
    )


def refresh_windows(max_date: dt.date, months_from: dt.date) -> list[Window]:
    """The three rolling ranges of a refresh: 31 days, 20 full ISO weeks, all full months."""
    monday = max_date - dt.timedelta(days=max_date.weekday())
    one = dt.timedelta(days=1)
    return [
        window("daily", max_date - dt.timedelta(days=30), max_date),
        window("weekly", monday - dt.timedelta(weeks=20), monday - one),
        window("monthly", months_from, max_date.replace(day=1) - one),
    ]


def refresh_ranges(status: DataFrame, max_col: str, months_from: dt.date) -> DataFrame:
    """The same three ranges as rows (period, from_date, till_date) from a load-status row."""
    top = F.col(max_col).cast("date")
    ranges = F.array(
        F.struct(F.lit("daily").alias("period"), F.date_sub(top, 30).alias("from_date"), top.alias("till_date")),
        F.struct(
            F.lit("weekly").alias("period"),
            F.trunc(F.date_sub(top, 140), "week").alias("from_date"),
            F.date_sub(F.trunc(top, "week"), 1).alias("till_date"),
        ),
        F.struct(
            F.lit("monthly").alias("period"),
            F.lit(months_from).alias("from_date"),
            F.date_sub(F.trunc(top, "month"), 1).alias("till_date"),
        ),
    )
    return status.select(F.inline(ranges))


def quarter_dates(label: str) -> tuple[dt.date, dt.date] | tuple[None, None]:
    """First and last day of ``Q1'20`` or ``1Q'20``, for labels known when the plan is built."""
    parts = [re.sub("[^0-9]", "", p) for p in label.split("'")]
    if len(parts) != 2 or not all(parts) or not 1 <= int(parts[0]) <= 4:
        return None, None
    year, month = 2000 + int(parts[1]), 3 * int(parts[0]) - 2
    return dt.date(year, month, 1), dt.date(year, month + 2, calendar.monthrange(year, month + 2)[1])


def quarter_start(label: Column | str) -> Column:
    """``Q1'20`` or ``1Q'20`` -> 2020-01-01; NULL for anything else."""
    parts = F.split(_col(label), "'")
    quarter = F.regexp_replace(F.get(parts, F.lit(0)), "[^0-9]", "").try_cast("int")
    year = F.regexp_replace(F.get(parts, F.lit(1)), "[^0-9]", "").try_cast("int")
    ok = quarter.between(1, 4) & year.isNotNull() & (F.size(parts) == 2)
    return F.when(ok, F.make_date(year + 2000, quarter * 3 - 2, F.lit(1)))


def quarter_end(start: Column | str) -> Column:
    return F.date_sub(F.add_months(_col(start), 3), 1)


def excel_serial(days: Column | str) -> Column:
    """Spreadsheet day number -> date (day 2 is 1900-01-01 on the sheet's calendar after its leap-year slip)."""
    return F.date_add(F.lit(dt.date(1899, 12, 30)), _col(days).cast("int"))


def make_month(year: Column | str, month: Column | str) -> Column:
    """First of the month from year and month texts."""
    return F.make_date(F.trim(_col(year)).try_cast("int"), F.trim(_col(month)).try_cast("int"), F.lit(1))


def shift_year(df: DataFrame, date_col: str, years: int, zero_col: str | None = None) -> DataFrame:
    """Copy rows to another year; optionally with the measure set to zero. 29 February moves to the 28th."""
    out = df.withColumn(date_col, F.add_months(date_col, 12 * years))
    return out.withColumn(zero_col, F.lit(0).cast(df.schema[zero_col].dataType)) if zero_col else out
