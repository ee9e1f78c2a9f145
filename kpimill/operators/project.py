"""Renames, target layouts and column mapping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from kpimill.functions.text import nan_to_null


def rename_synonyms(df: DataFrame, synonyms: dict[str, str]) -> DataFrame:
    """Map header spellings to canonical names.

    Several spellings of one name in the same table become one column: the canonical column first, then the
    spellings in table order, first non-NULL value wins.
    """
    sources: dict[str, list[str]] = {}
    for c in df.columns:
        sources.setdefault(synonyms.get(c, c), []).append(c)
    out = []
    for name, cols in sources.items():
        cols = sorted(cols, key=lambda c: c != name)
        value = F.coalesce(*[F.col(f"`{c}`") for c in cols]) if len(cols) > 1 else F.col(f"`{cols[0]}`")
        out.append(value.alias(name))
    return df.select(*out)


def rename_by(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[fn(c) for c in df.columns])


def positional_rename(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def conform(df: DataFrame, schema: T.StructType | str, constants: dict | None = None) -> DataFrame:
    """Project to a target layout: its order and types, absent columns and not-a-number as NULL, others dropped."""
    constants = constants or {}
    have = {c.lower(): c for c in df.columns}

    def value(name: str) -> Column:
        if name in constants:
            return constants[name] if isinstance(constants[name], Column) else F.lit(constants[name])
        return F.col(f"`{have[name.lower()]}`") if name.lower() in have else F.lit(None)

    def filled(f: T.StructField) -> Column:
        cast = value(f.name).cast(f.dataType)
        return (nan_to_null(cast) if isinstance(f.dataType, T.DoubleType) else cast).alias(f.name)

    return df.select(*[filled(f) for f in _schema(schema)])


def default_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add the columns that are absent, with a default value."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def default_mapping(targets: list[str], sources: list[str], override: dict[str, str | None] | None = None) -> dict:
    """Target i <- source i; targets beyond the last source <- NULL; overrides last."""
    mapping = {t: sources[i] if i < len(sources) else None for i, t in enumerate(targets)}
    return mapping | (override or {})


def map_columns(df: DataFrame, mapping: dict[str, str | None]) -> DataFrame:
    """Target columns from source columns; a missing source gives NULL."""
    return df.select(*[(F.col(f"`{s}`") if s else F.lit(None).cast("string")).alias(t) for t, s in mapping.items()])


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns whose expressions cost much and are filtered on.

    A filter on a plain projected column is pushed below it and evaluates the expression again, once per use;
    the generator keeps it above.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    made = F.explode(F.array(F.struct(*[e.alias(n) for n, e in columns.items()])))
    out = df.select(*kept, made.alias("__made"))
    return out.select(*kept, *[F.col(f"__made.{n}").alias(n) for n in columns])


def relabel(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    """Replace exact values; others stay."""
    return df.replace(mapping, subset=[col]) if mapping else df
