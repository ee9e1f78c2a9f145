"""Tables whose content is what their newest manifest lists, so that a change is one rename.

A table is a folder with ``data/<commit>/...`` (parquet files that are never changed) and ``versions/<number>.json``. A
manifest names the file sets of one version, one per partition value, with their rows, and a ledger: per feed the number of
the last batch that went in. A change writes its new files where nobody looks, then a manifest under a name of its own,
and commits by renaming that to the next number, which fails if the number is taken. A reader lists the files of one
manifest, so it sees the table before a change or after it; a writer that stops half-way leaves files that no manifest
names. Batches are entered in the ledger by the same rename that shows their rows, so one that is given twice is known.

The rename must fail on an existing name and be atomic, as on HDFS and local disks. Versions stay readable until
``expire`` removes them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kpimill.sinks.tables import _delete, _refuse_outside, exists


CODEC = "zstd"  # bitmaps and sketches are mostly zeros, which other codecs leave three times as large


class Conflict(RuntimeError):
    """Another writer committed the version that this one was about to."""


class VersionedTable:
    """``watch`` is told every step of a change before it is taken: prepared, written, listed, committed."""

    def __init__(self, spark: SparkSession, path: str, watch: Callable[[str], None] = lambda step: None):
        self.spark, self.path, self.watch = spark, path.rstrip("/"), watch

    # --- manifests ---

    def _jpath(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _fs(self):
        return self._jpath().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        if not exists(self.spark, f"{self.path}/versions"):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(self._jpath("versions"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict:
        if version is None:
            found = self.versions()
            if not found:
                raise ValueError(f"no table at {self.path}")
            version = found[-1]
        stream = self._fs().open(self._jpath("versions", f"{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> int:
        """Show a manifest under its number; fails if that is taken."""
        number = manifest["version"]
        text = json.dumps(manifest, ensure_ascii=False)
        hidden, shown = self._jpath("versions", f".{uuid.uuid4().hex}"), self._jpath("versions", f"{number:012d}.json")
        out = self._fs().create(hidden, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.watch("listed")
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        no_options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        full = self._fs().makeQualified(hidden), self._fs().makeQualified(shown)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(full[0].toUri(), conf).rename(*full, no_options)
        except Exception as e:
            if "AlreadyExists" in str(e):
                self._fs().delete(hidden, False)
                raise Conflict(f"version {number} of {self.path} exists already") from e
            raise
        self.watch("committed")
        return number

    # --- reading ---

    def _frame(self, manifest: dict, entries: list[dict]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        if not entries:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{e['folder']}" for e in entries])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as it is now, or was at a version; what is committed later does not change the frame."""
        m = self.manifest(version)
        return self._frame(m, m["files"])

    def rows(self, version: int | None = None) -> int:
        return sum(e["rows"] for e in self.manifest(version)["files"])

    def last_batch(self, feed: str) -> int | None:
        return self.manifest()["ledger"].get(feed)

    def seen(self, feed: str, batch: int) -> bool:
        """Whether a batch of a feed is in the table; the batches of a feed come in the order of their numbers."""
        last = self.last_batch(feed)
        return last is not None and batch <= last

    # --- changing ---

    def create(self, schema: T.StructType | str, partition_by: list[str] | None = None) -> None:
        """An empty table; fails if there is one."""
        kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        # files are read with what parquet can promise: every column may be null
        kind = T.StructType([T.StructField(f.name, f.dataType) for f in kind])
        self._commit({"version": 1, "schema": kind.jsonValue(), "partition_by": partition_by or [], "files": [], "ledger": {}, "notes": None})

    def _keys(self, manifest: dict) -> list[Column]:
        return [F.col(c).cast("string").alias(f"__p{i}") for i, c in enumerate(manifest["partition_by"])]

    def _write(self, df: DataFrame, manifest: dict, folder: str, inside: Column | None = None) -> tuple[list[dict], int]:
        """Write rows to a folder of their own; gives its file sets with their rows, and how many rows are not ``inside``."""
        keys, target = self._keys(manifest), f"{self.path}/{folder}"
        names = [f"__p{i}" for i in range(len(keys))]
        if keys:
            df.select("*", *keys).hint("rebalance", *map(F.col, names)).write.partitionBy(*names).parquet(target, compression=CODEC)
        else:
            df.write.parquet(target, compression=CODEC)
        texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
        outside = F.count_if(F.lit(False) if inside is None else ~inside)
        written = self.spark.read.schema(T.StructType(df.schema.fields + texts.fields)).parquet(target)
        counts = [r for r in written.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), outside.alias("out")).collect() if r["n"]]
        paths = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        place = lambda r: "/".join([folder, *(paths.getPartitionPathString(n, r[n]) for n in names)])
        return [{"folder": place(r), "values": [r[n] for n in names], "rows": r["n"]} for r in counts], sum(r["out"] for r in counts)

    def replace(
        self, predicate: Column, df: DataFrame | None = None, batch: tuple[str, int] | None = None, notes: object = None
    ) -> dict[str, int]:
        """Delete the rows for which the predicate is true and add the new ones, in one commit; gives both row counts.

        Rows for which it is NULL stay. A new row outside the predicate is refused before anything is changed. Only
        partitions that lose or gain rows are written again. ``batch`` (feed, number) is entered in the ledger; one that is
        there already changes nothing. ``notes`` (of JSON types) are kept with the version.
        """
        if batch and self.seen(*batch):
            return {"deleted": 0, "inserted": 0}
        m = self.manifest()
        keys, inside, folder = self._keys(m), F.coalesce(predicate, F.lit(False)), f"data/{uuid.uuid4().hex}"
        added: list[dict] = []
        if df is not None:
            # written once, to where they stay: no manifest names them before the commit
            schema = T.StructType.fromJson(m["schema"])
            added, outside = self._write(self._frame(m, []).unionByName(df.select(*schema.names)), m, f"{folder}/new", inside)
            if outside:
                _delete(self.spark, f"{self.path}/{folder}")
                _refuse_outside(outside)
        gained = {tuple(e["values"]): e["rows"] for e in added}
        self.watch("prepared")
        counted = lambda rows: {tuple(r[:-1]): r[-1] for r in rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).collect() if r[-1]}
        lost = counted(self._frame(m, m["files"]).where(predicate))
        # of partitions that lose rows the others are written again; one that only gains keeps its files
        stays = [e for e in m["files"] if tuple(e["values"]) not in lost]
        changed = [e for e in m["files"] if tuple(e["values"]) in lost]
        made = added + (self._write(self._frame(m, changed).where(~inside), m, f"{folder}/kept")[0] if changed else [])
        self.watch("written")
        ledger = {**m["ledger"], batch[0]: batch[1]} if batch else m["ledger"]
        self._commit({**m, "version": m["version"] + 1, "files": stays + made, "ledger": ledger, "notes": notes})
        return {"deleted": sum(lost.values()), "inserted": sum(gained.values())}

    def expire(self, keep: int = 2, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
        """Remove all but the last versions, and data folders that no kept version names and that are older than a writer
        may need them; gives the number of folders removed."""
        found = self.versions()
        kept = {e["folder"].split("/")[1] for v in found[-keep:] for e in self.manifest(v)["files"]}
        for v in found[:-keep]:
            self._fs().delete(self._jpath("versions", f"{v:012d}.json"), False)
        if not exists(self.spark, f"{self.path}/data"):
            return 0
        limit = (dt.datetime.now() - older_than).timestamp() * 1000
        old = [s for s in self._fs().listStatus(self._jpath("data")) if s.getPath().getName() not in kept and s.getModificationTime() <= limit]
        for s in old:
            _delete(self.spark, s.getPath().toString())
        return len(old)


def open_table(spark: SparkSession, path: str, schema: T.StructType | str, partition_by: list[str] | None = None, **options) -> VersionedTable:
    """The table at a path, made if there is none."""
    table = VersionedTable(spark, path, **options)
    if not table.versions():
        table.create(schema, partition_by)
    return table
