"""Dictionary lookups: joins by name or code, buckets, representative keys, longest prefix, unmatched keys.

Joins carry no hints: Spark broadcasts a dictionary when its statistics or its measured shuffle size allow it,
and splits hot keys of the other side when they do not.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from kpimill.session import materialize


def map_dim(df: DataFrame, dim: DataFrame, on: dict[str, str], how: str = "inner", where: Column | None = None) -> DataFrame:
    """Join a dictionary on differently named keys; the dictionary's key columns are not kept. ``where`` limits the rows that
    are looked up, as a part of the join's condition."""
    keys = dim.withColumnsRenamed({d: f"__{d}" for d in on.values()})
    cond = [F.col(f"`{f}`") == F.col(f"`__{d}`") for f, d in on.items()] + ([where] if where is not None else [])
    return df.join(keys, cond, how).drop(*[f"__{d}" for d in on.values()])


def other_bucket(dim: DataFrame, names: DataFrame, name_col: str, id_col: str, other: str = "Other") -> DataFrame:
    """Smallest id per listed name, all other names in one bucket. The list is a table, found at run time."""
    listed = names.select(F.col(names.columns[0]).alias("__name")).distinct()
    smallest = dim.groupBy(name_col).agg(F.min(id_col).alias(id_col))
    flagged = smallest.join(listed, F.col(name_col) == F.col("__name"), "left")
    bucket = F.when(F.col("__name").isNotNull(), F.col(name_col)).otherwise(other)
    return flagged.groupBy(bucket.alias(name_col)).agg(F.min(id_col).alias(id_col))


def representative_key(dim: DataFrame, by: list[str], id_col: str) -> DataFrame:
    """Smallest id per group of names or codes."""
    return dim.groupBy(*by).agg(F.min(id_col).alias(id_col))


def unmatched(df: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """Keys of a feed that the dictionary does not know, with their row counts; counted before the lookup."""
    keys = list(on)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    known = dim.select(*[F.col(d).alias(f"__{d}") for d in on.values()])
    return counts.join(known, [F.col(f) == F.col(f"__{d}") for f, d in on.items()], "left_anti")


def dial_codes(dictionary: DataFrame, codes_col: str, dest_col: str, min_len: int = 2) -> DataFrame:
    """Code -> destination from joined code lists; the smallest destination wins a repeated code."""
    return (
        dictionary.select(F.explode(F.split(codes_col, ", ")).alias("code"), F.col(dest_col).alias("dest"))
        .where(F.length("code") >= min_len)
        .groupBy("code")
        .agg(F.min("dest").alias("dest"))
    )


def longest_prefix(
    df: DataFrame, key: str, dictionary: DataFrame, codes_col: str, dest_col: str, out: str, min_len: int = 2
) -> DataFrame:
    """Destination of the longest code that the key starts with; NULL when none of at least ``min_len`` does.

    A key is only as good as its first characters, as many as the longest code has: its stem. The distinct stems are
    merged once with the codes in text order, and every stem looks at the last code of each length before it: if any code
    of a length starts the stem, it is that one, as every later code of the length is greater than the stem. So a stem is one
    row and one look, however deeply codes are nested; stems and codes meet by their first ``min_len`` characters. Answers go
    back to the rows by stem: Spark broadcasts them where their measured size allows it and splits hot stems otherwise.
    """
    codes = materialize(dial_codes(dictionary, codes_col, dest_col, min_len), "codes")
    lengths = sorted(r[0] for r in codes.select(F.length("code")).distinct().collect())  # one per length
    stems = df.select(F.substring(F.col(key), 1, max(lengths, default=min_len)).alias("at")).where(F.length("at") >= min_len).distinct()
    both = codes.select(F.col("code").alias("at"), F.struct("dest").alias("__code")).unionByName(stems, allowMissingColumns=True)
    before = Window.partitionBy(F.substring("at", 1, min_len)).orderBy("at", F.col("__code").isNull())
    is_code = F.col("__code").isNotNull()
    last = lambda n: F.last(F.when(is_code & (F.length("at") == n), F.struct("at", "__code")), ignorenulls=True)
    seen = both.select("at", is_code.alias("__is_code"), *(last(n).over(before.rowsBetween(Window.unboundedPreceding, 0)).alias(f"__c{n}") for n in lengths))
    best = F.coalesce(*(F.when(F.startswith("at", f"__c{n}.at"), F.col(f"__c{n}.__code")) for n in reversed(lengths)), F.lit(None).cast("struct<dest:string>"))
    answers = seen.where("NOT __is_code").select(F.col("at").alias("__stem"), best.alias("__best"))
    answers = answers.where("__best IS NOT NULL").select("__stem", F.col("__best.dest").alias(out))
    stem = F.substring(F.col(key), 1, max(lengths, default=min_len))
    return df.join(answers, stem == F.col("__stem"), "left").drop("__stem")


def membership(names: DataFrame, dim: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Distinct names of a feed that are not in a dictionary."""
    known = dim.select(F.col(on[1]).alias("__known"))
    return names.select(on[0]).distinct().join(known, F.col(on[0]) == F.col("__known"), "left_anti")


def retail_branches(branch: DataFrame, region: DataFrame, marks: Iterable[str], deferred: str) -> DataFrame:
    """Branches with their region, without excluded names and without unassigned clusters."""
    keep = F.col("product_cluster_name").isNotNull() & F.col("branch_id").isNotNull()
    for mark in marks:
        keep = keep & ~F.col("branch_name").like(f"%{mark}%")
    keep = keep & (F.col("product_cluster_name") != deferred)
    return branch.where(keep).join(region, "region_id")
