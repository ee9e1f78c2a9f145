"""Table writes: slice replacement, reload, append, backup, audit history, incremental refresh.

A table is a folder of parquet files, partitioned by the columns its slices are cut on. Slice replacement
rewrites only the partitions it touches, by dynamic partition overwrite: the new files appear when the job
commits, and a failed or repeated run leaves the same result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from kpimill.session import discard, staged

OPEN_FILES_CONF, OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters", 64  # with more partitions a task sorts its rows
MAX_KEYS = 10_000  # distinct values of a slice's dictionary column; more is no dictionary and is refused


@dataclass(frozen=True)
class SliceSpec:
    """One description of a slice for filtering new rows, backing up and deleting old ones.

    Bounds left out are taken from the data, key lists left out are all distinct values; the upper bound is
    moved to its month's end. ``keys`` maps a dictionary column of the data (versions, accounts) to its allowed
    values, which become literals of the predicate; blanks around them don't count, as in the data.
    """

    date_col: str
    min_date: dt.date | None = None
    max_date: dt.date | None = None
    keys: dict[str, list[str] | None] = field(default_factory=dict)

    def __post_init__(self):
        clean = {k: [x.strip() for x in v] if v else v for k, v in self.keys.items()}
        object.__setattr__(self, "keys", clean)

    def resolve(self, df: DataFrame) -> "SliceSpec":
        """Fill in what was left out from the data. A column with more than ``MAX_KEYS`` values is refused."""
        row = df.agg(F.min(self.date_col).alias("lo"), F.max(self.date_col).alias("hi")).first()
        high = self.max_date or row["hi"]
        if high is not None:
            high = (high.replace(day=1) + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1)
        keys = {k: v if v else _distinct_keys(df, k) for k, v in self.keys.items()}
        return SliceSpec(self.date_col, self.min_date or row["lo"], high, keys)

    def column(self, rename: dict[str, str] | None = None) -> Column:
        """The predicate; ``rename`` maps the data's columns to the target's."""
        name = lambda c: (rename or {}).get(c, c)
        cond = F.col(name(self.date_col)).between(F.lit(self.min_date), F.lit(self.max_date))
        for k, values in self.keys.items():
            cond = cond & F.trim(name(k)).isin(values)
        return cond


def _distinct_keys(df: DataFrame, col: str) -> list[str]:
    found = df.select(F.trim(col).alias("k")).where("k IS NOT NULL").distinct().limit(MAX_KEYS + 1).collect()
    if len(found) > MAX_KEYS:
        raise ValueError(f"{col} has more than {MAX_KEYS} values: name the keys of the slice")
    return sorted(r["k"] for r in found)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (old, new))
    if not a.getFileSystem(spark._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"cannot rename {old} to {new}")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows are counted while they are written, not in a pass of their own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _rows(seen: Observation) -> int:
    return _seen(seen, "rows")


def _seen(seen: Observation, name: str) -> int:
    try:
        return seen.get[name]
    except Py4JJavaError:  # Spark leaves the counter out together with an input it knows to be empty
        return 0


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """A task keeps the files of several partitions open, instead of sorting its rows by partition first."""
    before = spark.conf.get(OPEN_FILES_CONF)
    spark.conf.set(OPEN_FILES_CONF, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES_CONF, before)


def _write(
    df: DataFrame, path: str, partition_by: list[str] | None, mode: str, overwrite: str = "static", gather: bool = True
) -> None:
    """Write, with rows gathered per partition first: few files for small ones, several tasks for large ones. Without
    ``gather`` they stay in their tasks, each of which writes a file for every partition that it has rows of."""
    if partition_by and gather:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).option("partitionOverwriteMode", overwrite)
    with nullcontext() if gather else _open_files(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def full_reload(df: DataFrame, path: str, partition_by: list[str] | None = None, gather: bool = True) -> int:
    """Replace all rows; gives the number written. ``gather`` as in ``replace_slice``."""
    df, seen = _counted(df)
    _write(df, path, partition_by, "overwrite", gather=gather)
    return _rows(seen)


def append(df: DataFrame, path: str, columns: list[str] | None = None, partition_by: list[str] | None = None) -> int:
    """Positional append: the i-th column goes to the i-th target column; gives the number of rows added."""
    if columns:
        if len(columns) != len(df.columns):
            raise ValueError(f"{len(df.columns)} columns for a target with {len(columns)}")
        df = df.toDF(*columns)
    df, seen = _counted(df)
    _write(df, path, partition_by, "append")
    return _rows(seen)


def _recover(spark: SparkSession, path: str) -> None:
    """Undo a swap that was cut off between its two renames: the old version is still there."""
    if not exists(spark, path) and exists(spark, f"{path}__backup"):
        _rename(spark, f"{path}__backup", path)


def _swap(spark: SparkSession, df: DataFrame, path: str, keep_backup: bool = False, check=None) -> None:
    """Write next to the table, then rename: for tables without partitions. ``check`` may refuse what was written."""
    _delete(spark, f"{path}__next")
    df.write.parquet(f"{path}__next")
    try:
        if check:
            check()
    except ValueError:
        _delete(spark, f"{path}__next")
        raise
    _delete(spark, f"{path}__backup")
    _rename(spark, path, f"{path}__backup")
    _rename(spark, f"{path}__next", path)
    if not keep_backup:
        _delete(spark, f"{path}__backup")


def _refuse_outside(outside: int) -> None:
    if outside:
        raise ValueError(f"{outside} new rows lie outside the slice that is replaced; nothing was changed")


def _partitions(df: DataFrame, partition_by: list[str]) -> dict[tuple, int]:
    """Rows per partition value: as many entries as there are folders, which the driver lists anyway."""
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*partition_by).count().collect()}


def _in_partitions(partition_by: list[str], values: set[tuple]) -> Column:
    """Literal partition filter, so that only those folders are read."""
    if len(partition_by) == 1:
        col = F.col(partition_by[0])
        filled = [v for (v,) in values if v is not None]
        return (col.isin(filled) | col.isNull()) if (None,) in values else col.isin(filled)
    cond = F.lit(False)
    for row in values:
        cond = cond | _all_equal(partition_by, row)
    return cond


def _all_equal(cols: list[str], row: tuple) -> Column:
    out = F.lit(True)
    for c, v in zip(cols, row):
        out = out & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
    return out


def replace_slice(
    spark: SparkSession,
    path: str,
    predicate: Column,
    df: DataFrame | None = None,
    partition_by: list[str] | None = None,
    keep_backup: bool = False,
    gaining: set[tuple] | None = None,
    stored: bool = False,
    gather: bool = True,
) -> dict[str, int]:
    """Delete the rows for which the predicate is true, then add the new rows; gives both row counts.

    Rows for which it is NULL stay. Every new row must satisfy the predicate: one that does not is refused before
    anything is changed, as a repeated run could not replace it. With partitions only those that lose or gain rows are
    rewritten, and one that ends up empty is removed. The new rows are staged first: they are computed once, and the
    partitions they go to are read from what is staged, not from what a caller believes. ``gaining`` is a check only: new
    rows in a partition that it does not name are refused. ``df=None`` clears the slice.

    ``stored``: the new rows come from files that stay as they are meanwhile, other than this table's, by steps that give the
    same rows each time; they are not staged again. ``gather=False``: rows are written by the tasks that hold them, for new rows
    whose tasks are large and have few partitions each.
    """
    if not partition_by:
        _recover(spark, path)
    reader = spark.read if df is None else spark.read.schema(df.schema)
    target = reader.parquet(path)
    new = target.limit(0) if df is None else df.select(*target.columns)
    inside = F.coalesce(predicate, F.lit(False))
    if not partition_by:
        deleted = target.where(predicate).count()
        seen = Observation()
        new = new.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~inside).alias("outside"))
        _swap(spark, target.where(~inside).unionByName(new), path, keep_backup, lambda: _refuse_outside(_seen(seen, "outside")))
        return {"deleted": deleted, "inserted": 0 if df is None else _rows(seen)}
    if keep_backup:
        raise ValueError("backups of partitioned tables are made with backup_slice")
    stage, gained = None, {}
    if df is not None:
        if not stored:
            new, stage = staged(new, "slice")
        found = new.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("__n"), F.count_if(~inside).alias("__out")).collect()
        gained = {tuple(r[:-2]): r["__n"] for r in found}
        outside = sum(r["__out"] for r in found)
        if outside or (gaining is not None and not set(gained) <= gaining):
            if stage:
                discard(spark, stage)
            _refuse_outside(outside)
            raise ValueError(f"new rows go to partitions that were not named: {sorted(set(gained) - gaining, key=repr)[:5]}")
    lost = _partitions(target.where(predicate), partition_by)
    touched = set(lost) | set(gained)
    if touched:
        kept = target.where(_in_partitions(partition_by, touched) & ~inside)
        # of a partition that loses rows and gains none, an old file that the write leaves there means that it kept none
        old = {row: _any_file(spark, _folder(spark, path, partition_by, row)) for row in set(lost) - set(gained)}
        # the kept rows come from folders this write replaces: those are only dropped when the job commits
        _write(kept.unionByName(new), path, partition_by, "overwrite", "dynamic", gather)
        for row, file in old.items():
            if file and exists(spark, file):
                _delete(spark, _folder(spark, path, partition_by, row))
        spark.catalog.refreshByPath(path)
    if stage:
        discard(spark, stage)
    return {"deleted": sum(lost.values()), "inserted": sum(gained.values())}


def _any_file(spark: SparkSession, folder: str) -> str | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return next((f.getPath().toString() for f in listed if f.isFile()), None)


def _folder(spark: SparkSession, path: str, partition_by: list[str], row: tuple) -> str:
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = [names.getPartitionPathString(c, None if v is None else str(v)) for c, v in zip(partition_by, row)]
    return "/".join([path, *parts])


def clear_slice(spark: SparkSession, path: str, predicate: Column, partition_by: list[str] | None = None) -> dict[str, int]:
    return replace_slice(spark, path, predicate, None, partition_by)


def backup_slice(
    spark: SparkSession, path: str, backup: str, predicate: Column, partition_by: list[str] | None = None
) -> None:
    """Copy a slice of the table into its backup table, replacing the same slice there.

    The rows are cut by partition already, so they are neither staged nor gathered.
    """
    rows = spark.read.parquet(path).where(predicate)
    if exists(spark, backup):
        replace_slice(spark, backup, predicate, rows, partition_by, stored=True, gather=False)
    else:
        full_reload(rows, backup, partition_by, gather=False)


def incremental_refresh(
    spark: SparkSession, path: str, source: DataFrame, date_col: str, since: dt.date, partition_by: list[str] | None = None
) -> None:
    """Drop rows from a date on and append the source's rows from that date on; the old version is kept."""
    cond = F.col(date_col) >= F.lit(since)
    if partition_by:
        backup_slice(spark, path, f"{path}__backup", cond, partition_by)
        replace_slice(spark, path, cond, source.where(cond), partition_by)
    else:
        replace_slice(spark, path, cond, source.where(cond), keep_backup=True)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Delimited text with a header; blanks around values are kept."""
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


HISTORY_SCHEMA = "loaded_at timestamp_ntz, file_name string, schema_name string, table_name string, user_name string"


def add_history(
    spark: SparkSession, path: str, file_name: str, schema_name: str, table_name: str, user: str, at: dt.datetime
) -> None:
    """One audit row per load, time cut to seconds."""
    row = [(at.replace(microsecond=0, tzinfo=None), file_name, schema_name, table_name, user)]
    spark.createDataFrame(row, HISTORY_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def get_history(spark: SparkSession, path: str, user: str) -> DataFrame:
    """A user's own loads, newest first."""
    rows = spark.read.schema(HISTORY_SCHEMA).parquet(path).where(F.col("user_name") == user)
    return rows.orderBy(F.col("loaded_at").desc()).drop("user_name")


def analyze(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """Collect column statistics and show them: rows, nulls, least and greatest value (exact), distinct values (an estimate)."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    size = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}["Statistics"]
    total = int(size.split(", ")[1].split()[0])
    rows = []
    for c in columns:
        info = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {c}").collect()}
        known = lambda k: None if info[k] == "NULL" else info[k]
        rows.append((c, total, int(info["num_nulls"]), known("min"), known("max"), int(info["distinct_count"])))
    schema = "column_name string, row_count bigint, null_count bigint, min_value string, max_value string, distinct_count bigint"
    return spark.createDataFrame(rows, schema)
