"""Wide to long, long to wide, and calendar expansion."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def melt(df: DataFrame, ids: list[str], values: list[str] | None, var: str, val: str) -> DataFrame:
    """One row per id and value column; NULL values stay. ``values`` defaults to every other column."""
    values = [c for c in df.columns if c not in ids] if values is None else values
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in values], var, val)


def melt_as(df: DataFrame, ids: list[str], columns: list[tuple[str, dict[str, object]]], val: str) -> DataFrame:
    """The same with given labels: for every listed column one row, with its label columns and its value.

    Labels are literals of the plan, so nothing is parsed per row, and two columns may share a label.
    """
    rows = [F.struct(*[F.lit(v).alias(k) for k, v in labels.items()], F.col(f"`{c}`").alias(val)) for c, labels in columns]
    return df.select(*[F.col(f"`{c}`") for c in ids], F.inline(F.array(*rows)))


PIVOT_COLUMNS = 10_000


def values_of(df: DataFrame, col: str) -> list:
    """The values of a column that becomes headers, sorted. More than ``PIVOT_COLUMNS`` are refused: no table is that wide."""
    found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(PIVOT_COLUMNS + 1).collect()]
    if len(found) > PIVOT_COLUMNS:
        raise ValueError(f"{col} has more than {PIVOT_COLUMNS} values")
    return sorted(found)


def pivot_sum(df: DataFrame, index: list[str], col: str, val: str, values: list) -> DataFrame:
    """Sum of ``val`` by index, one column per listed value. The list is given, so no extra job looks it up."""
    return df.groupBy(*index).pivot(col, values).agg(F.sum(val))


def allocate_daily(df: DataFrame, month_col: str, val_col: str, passthrough: str) -> DataFrame:
    """Spread a monthly value evenly over the days of its month.

    Rows for which the SQL condition ``passthrough`` is true keep their date and value; rows for which it is
    NULL belong to neither side and are left out.
    """
    others = [c for c in df.columns if c not in (month_col, val_col)]
    days = (
        f"CASE WHEN {passthrough} THEN array(CAST({month_col} AS DATE)) "
        f"ELSE sequence(trunc({month_col}, 'month'), last_day({month_col}), INTERVAL 1 DAY) END"
    )
    share = f"CASE WHEN {passthrough} THEN {val_col} ELSE {val_col} / day(last_day({month_col})) END"
    return (
        df.where(f"({passthrough}) IS NOT NULL")
        .selectExpr(*[f"`{c}`" for c in others], f"{share} AS __share", f"explode({days}) AS __day")
        .withColumnsRenamed({"__share": val_col, "__day": month_col})
        .select(*df.columns)
    )


def quarter_to_months(df: DataFrame, col: str) -> DataFrame:
    """Each quarter row becomes three monthly rows."""
    months = F.explode(F.array(*[F.add_months(col, i) for i in range(3)]))
    return df.withColumn(col, months)


CALENDAR_KEYS = 10_000


def replicate(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """Every row once per distinct date of a calendar.

    Only dates and numbers are taken as calendar keys, and at most ``CALENDAR_KEYS`` of them (27 years of days): they are
    gathered into one array inside the plan and exploded per row, so neither side is crossed with the other. A larger
    table is no calendar and fails the query.
    """
    kind = keys.schema[col].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.IntegralType)):
        raise ValueError(f"{col} is {kind.simpleString()}, not a calendar")
    found = keys.where(F.col(col).isNotNull()).select(col).distinct().limit(CALENDAR_KEYS + 1)
    few = F.when(F.count(F.lit(1)) <= CALENDAR_KEYS, F.sort_array(F.collect_list(col)))
    values = found.agg(few.otherwise(F.raise_error(F.lit(f"more than {CALENDAR_KEYS} values of {col}: not a calendar"))).alias("v")).scalar()
    return df.withColumn(col, F.explode(values))


def split_levels(df: DataFrame, geo: str, area: str, levels: dict[str, str]) -> DataFrame:
    """One column per level: the area where the geography level contains the mark, else NULL."""
    return df.withColumns({name: F.when(F.col(geo).contains(mark), F.col(area)) for name, mark in levels.items()})


def last_duplicate_columns(names: list[str]) -> dict[int, str]:
    """Position -> name of the last occurrence of every header that is repeated; single headers are left out."""
    last: dict[str, int] = {}
    seen: dict[str, int] = {}
    for i, name in enumerate(names):
        seen[name] = seen.get(name, 0) + 1
        last[name] = i
    return {i: n for n, i in sorted(last.items(), key=lambda kv: kv[1]) if seen[n] > 1}


def columns_with_marker(names: list[str], marker: str, keys: int) -> list[str]:
    """The first ``keys`` columns and every later one whose header contains the marker."""
    return [n for i, n in enumerate(names) if i < keys or marker in n]


def drop_by_rule(df: DataFrame, rule: Callable[[str], bool], keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns by a rule on their names, except the canonical ones."""
    kept = set(keep)
    return df.drop(*[c for c in df.columns if c not in kept and rule(c)])


def keep_one_total(area: str, mark: str, total: str) -> Column:
    """Areas that are not totals, plus the one named total. NULL areas satisfy neither."""
    return ~F.col(area).contains(mark) | (F.col(area) == total)
