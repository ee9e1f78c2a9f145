"""Table differences and delta loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kpimill.session import materialize

SIDES = ("left_only", "right_only", "both")


def table_diff(left: DataFrame, right: DataFrame, which: str | None = "right_only") -> DataFrame:
    """Compare two tables on all common columns, NULL equal to NULL.

    Each distinct row comes once with its side and its number of copies on either side: copies are counted
    map-side and never paired, so a row repeated millions of times costs nothing. ``which=None`` keeps the rows
    that are on one side only. ``repeat_rows`` turns counts back into copies.
    """
    common = [c for c in left.columns if c in right.columns]
    tagged = left.select(*common, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(*common, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    counted = tagged.groupBy(*common).agg(F.sum("__l").alias("left_rows"), F.sum("__r").alias("right_rows"))
    side = F.when(F.col("right_rows") == 0, "left_only").when(F.col("left_rows") == 0, "right_only").otherwise("both")
    out = counted.withColumn("side", side)
    return out.where(F.col("side") != "both") if which is None else out.where(F.col("side") == which)


BUCKETS = 4096


def _row_hash(columns: list[str], first: int) -> Column:
    """64-bit hash of a row; nulls count by their place."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(first), nulls, *[F.col(f"`{c}`") for c in columns])


def bucket_digests(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, s1, s2): per hash bucket of the rows their number and the sums of two hashes, which don't depend on their
    order. The digest of a coarser bucket is the sum of its parts, so they add up to one digest of the whole table."""
    total = lambda c: F.sum(c.cast("decimal(20,0)")).alias
    bucket = F.pmod(_row_hash(columns, 1), F.lit(buckets)).alias("bucket")
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), total(_row_hash(columns, 2))("s1"), total(_row_hash(columns, 3))("s2"))


def changed_buckets(left: DataFrame, right: DataFrame, columns: list[str], buckets: int = BUCKETS) -> list[int]:
    """Buckets whose rows differ between two tables: none if the tables are equal. At most ``buckets`` rows of each side
    are shuffled and compared, however large the tables are."""
    a = bucket_digests(left, columns, buckets).select("bucket", F.struct("n", "s1", "s2").alias("a"))
    b = bucket_digests(right, columns, buckets).select("bucket", F.struct("n", "s1", "s2").alias("b"))
    differ = a.join(b, "bucket", "full").where(~F.equal_null("a", "b")).select("bucket")
    return sorted(r[0] for r in differ.collect())


def table_diff_by_digest(left: DataFrame, right: DataFrame, which: str | None = "right_only", buckets: int = BUCKETS) -> DataFrame:
    """``table_diff`` of tables that are mostly equal: rows of buckets with equal digests are read but not shuffled.

    Only sides that differ can be asked for. Two different sets of rows with the same number and the same two 64-bit sums
    would pass as equal.
    """
    if which == "both":
        raise ValueError("rows on both sides are not found by digests: use table_diff")
    common = [c for c in left.columns if c in right.columns]
    left, right = left.select(*common), right.select(*common)
    differ = changed_buckets(left, right, common, buckets)
    here = F.pmod(_row_hash(common, 1), F.lit(buckets)).isin(differ) if differ else F.lit(False)
    return table_diff(left.where(here), right.where(here), which)


def repeat_rows(df: DataFrame, count_col: str, chunk: int = 65_536) -> DataFrame:
    """Each row as often as its count says, in chunks that can be spread over tasks."""
    n = F.col(count_col)
    chunks = df.where(n > 0).withColumn("__c", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk))))
    here = F.least(n - F.col("__c") * chunk, F.lit(chunk)).cast("int")
    return chunks.withColumn("__i", F.explode(F.sequence(F.lit(1), here))).drop("__c", "__i", count_col)


def delta_keys(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a new load whose key combination is not loaded yet, NULL equal to NULL."""
    known = materialize(old.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct(), "known-keys")
    return new.join(known, [F.equal_null(F.col(k), F.col(f"__{k}")) for k in keys], "left_anti")


def fresh_keys(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """The key combinations themselves."""
    return delta_keys(new.select(*keys).distinct(), old, keys)
