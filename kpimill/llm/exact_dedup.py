"""Exact duplicates against immutable snapshots that are screened by binary-fuse filters.

A snapshot is a written table of (digest, normalised text, ...), one row per distinct text, with one static
binary-fuse filter per bucket of digests. Of a new batch, duplicates inside the batch are grouped on their own; the
filters then tell which of the batch's distinct texts may be in a snapshot, and only those are joined with the
snapshot's buckets, where the bytes are compared. Snapshots are never changed: a batch adds a new one. A text that is in
a snapshot adds to the counts of the row it matched; one that is in none is a row of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpimill.llm.base import by_batch, row_schema, row_texts, spread, texts_of, with_row
from kpimill.session import materialize

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
FOLD = bytes.maketrans(UPPER, LOWER)
KEYS_PER_BUCKET = 50_000


# --- binary-fuse filter ---------------------------------------------------------------------------------------------


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over uint64 keys."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class BinaryFuse:
    """Static 3-wise binary-fuse filter with 16-bit fingerprints: three slots in three neighbouring segments per key.

    No key that it was built from is ever denied; another key passes with probability 2**-16.
    """

    def __init__(self, seed: int, segment: int, segments: int, slots: np.ndarray):
        self.seed, self.segment, self.segments, self.slots = seed, segment, segments, slots

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = _mix(keys, seed)
        first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        mask, at = np.uint64(segment - 1), first * np.uint64(segment)
        inside = _mix(h, 1)
        places = np.stack([at + np.uint64(k * segment) + ((inside >> np.uint64(20 * k)) & mask) for k in range(3)], axis=1)
        return places.astype(np.int64), (h & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys.astype(np.uint64))
        n = max(len(keys), 1)
        segment = min(1 << 18, 1 << max(2, int(np.floor(np.log(n) / np.log(3.33) + 2.25))))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        segments = max(1, -(-int(n * factor) // segment) - 2)
        for seed in range(1, 200):
            places, marks = cls._places(keys, seed, segment, segments)
            order = cls._peel(places, (segments + 2) * segment)
            if order is not None:
                slots = np.zeros((segments + 2) * segment, np.uint16)
                # keys taken off in one wave don't depend on one another: waves are filled last to first
                for ids, free in reversed(order):
                    p = places[ids]
                    slots[free] = marks[ids] ^ slots[p[:, 0]] ^ slots[p[:, 1]] ^ slots[p[:, 2]] ^ slots[free]
                return cls(seed, segment, segments, slots)
            segments += max(1, segments // 50)
        raise RuntimeError("no seed gives a filter")

    @staticmethod
    def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Waves of (keys, their free slot); None if a core is left."""
        n, flat = len(places), places.ravel()
        count = np.bincount(flat, minlength=size)
        held = np.zeros(size, np.int64)  # xor of the keys that stand in a slot
        np.bitwise_xor.at(held, flat, np.repeat(np.arange(n), 3))
        waves, left = [], n
        alone = np.flatnonzero(count == 1)
        while len(alone):
            ids, pick = np.unique(held[alone], return_index=True)
            waves.append((ids, alone[pick]))
            left -= len(ids)
            touched = places[ids].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(held, touched, np.repeat(ids, 3))
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        return waves if left == 0 else None

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        p, marks = self._places(keys.astype(np.uint64), self.seed, self.segment, self.segments)
        return (self.slots[p[:, 0]] ^ self.slots[p[:, 1]] ^ self.slots[p[:, 2]]) == marks

    def dump(self) -> bytes:
        return np.array([self.seed, self.segment, self.segments], "<i8").tobytes() + self.slots.astype("<u2").tobytes()

    @classmethod
    def load(cls, blob: bytes) -> BinaryFuse:
        seed, segment, segments = (int(x) for x in np.frombuffer(blob[:24], "<i8"))
        return cls(seed, segment, segments, np.frombuffer(blob[24:], "<u2"))


def _keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64)


# --- snapshots ------------------------------------------------------------------------------------------------------


@dataclass
class Snapshot:
    """``rows``: (row, digest, norm, keep_id, n), one row per distinct text, ``row`` naming it; ``filters``: (bucket, filter); ``buckets`` in all."""

    rows: DataFrame
    filters: DataFrame
    buckets: int


def bucket_of(buckets: int) -> Column:
    """Digests are evenly spread, so are buckets of them."""
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, norm, digest): the text in UTF-8 with A-Z lower-cased (null where it isn't wanted), and its SHA-256.
    A null text is the empty one."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            norm = [t.encode().translate(FOLD) for t in texts_of(batch, "text")]
            found = [hashlib.sha256(t).digest() for t in norm]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(norm, pa.binary()) if with_text else pa.nulls(len(norm), pa.binary()), pa.array(found, pa.binary())], ["doc_id", "norm", "digest"]
            )

        return step

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(rows, make, "doc_id long, norm binary, digest binary")


def group_batch(rows: DataFrame) -> DataFrame:
    """Duplicates inside one batch: (digest, norm, keep_id, n). Groups are on the bytes as well as the digest; copies
    are combined before the shuffle, however many there are."""
    return rows.groupBy("digest", "norm").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))


def freeze(groups: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET, name: str = "snapshot") -> Snapshot:
    """Write the distinct texts of a batch as an immutable snapshot with its filters."""
    rows = materialize(groups.withColumn("row", F.monotonically_increasing_id()), name)
    n = rows.count()
    buckets = spread(rows, keys_per_bucket, n)

    def build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in it:
            for b, d in zip(batch.column("bucket").to_pylist(), batch.column("digest").to_pylist()):
                held.setdefault(b, []).append(d)
        for b, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([BinaryFuse.build(_keys(found)).dump()], pa.binary())], ["bucket", "filter"])

    filters = rows.select("digest", bucket_of(buckets).alias("bucket")).repartition(buckets, "bucket").mapInArrow(build, "bucket int, filter binary")
    return Snapshot(rows, materialize(filters, name + "-filters"), buckets)


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The digests of a batch's groups that the snapshot's filters don't deny: (digest). Filters and digests meet by
    bucket; both are of bounded size there, and no filter is broadcast."""

    def pick(left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"digest": pd.Series([], dtype=object)})
        found = BinaryFuse.load(bytes(right["filter"].iloc[0])).may_hold(_keys([bytes(d) for d in left["digest"]]))
        return left.loc[found, ["digest"]]

    keys = groups.select("digest", bucket_of(snapshot.buckets).alias("bucket"))
    return keys.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(pick, "digest binary")


def match(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Groups of a batch whose bytes are in the snapshot: (row, digest, norm, keep_id, n) with the batch's keep_id and n, and
    the row of the snapshot that holds them."""
    maybe = screen(groups, snapshot).distinct()
    held = snapshot.rows.select("row", "digest", F.col("norm").alias("held_norm"))
    return (
        groups.join(maybe, "digest", "left_semi")
        .join(held, "digest")
        .filter(F.col("norm") == F.col("held_norm"))
        .select("row", "digest", "norm", "keep_id", "n")
    )


def updated(snapshot: Snapshot, hits: DataFrame) -> DataFrame:
    """(digest, keep_id, n) of a snapshot's rows, with what later batches' hits add to the rows they matched."""
    more = hits.groupBy("row").agg(F.max("keep_id").alias("more_id"), F.sum("n").alias("more_n"))
    rows = snapshot.rows.select("row", "digest", "keep_id", "n").join(more, "row", "left")
    return rows.select("digest", F.greatest("keep_id", "more_id").alias("keep_id"), (F.col("n") + F.coalesce("more_n", F.lit(0))).alias("n"))


def copy_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """(digest, keep_id, group_size) of every distinct text of a table that arrives in batches (by a hash of the id): the
    first becomes a snapshot, every later one is grouped on its own, screened against all snapshots before it, and what
    is new in it becomes a snapshot too. What the screen and the bytes find is what counts as a copy between batches."""
    rows = digests(df, id_col, text_col)
    batch = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1))), F.lit(batches))
    snapshots: list[Snapshot] = []
    hits: list[list[DataFrame]] = []  # of every snapshot
    last = None
    for b in range(batches):
        groups = group_batch(rows.filter(batch == b))
        if snapshots:
            groups = materialize(groups, "batch")
            found = None
            for k, s in enumerate(snapshots):
                more = match(groups, s).withColumn("snapshot", F.lit(k))
                found = more if found is None else found.unionByName(more)
            found = materialize(found, "hits")
            for k in range(len(snapshots)):
                hits[k].append(found.filter(F.col("snapshot") == k).select("row", "keep_id", "n"))
            groups = groups.join(found.select("digest", "norm"), ["digest", "norm"], "left_anti")
            if b == batches - 1:
                last = groups.select("digest", "keep_id", "n")
                break
        snapshots.append(freeze(groups))
        hits.append([])
    parts = [updated(s, reduce(DataFrame.unionByName, h)) if h else s.rows.select("digest", "keep_id", "n") for s, h in zip(snapshots, hits)]
    merged = reduce(DataFrame.unionByName, [*parts, last] if last is not None else parts)
    return materialize(merged.withColumnRenamed("n", "group_size"), "groups")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty; of equal texts the row with the
    largest id stays.

    Edge cases: a null id is the smallest (it is kept only as ``keep_id`` null when all ids of its group are null, and
    then ``kept`` is false); rows that share the largest id all count as kept; an empty table gives no rows; other
    columns of the input, whatever their names, are ignored.
    """
    groups = copy_groups(df, id_col, text_col, batches)
    rows = digests(df, id_col, text_col, with_text=False)
    return rows.select("doc_id", "digest").join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """The rows that stay, all columns as they are: of equal texts the one with the largest id, or, where all ids of a
    group are null, all of its rows; rows that share id and text are one document and stay together. A null text is the empty
    one; an empty table gives no rows; other columns may have any names."""
    groups = copy_groups(df, id_col, text_col, batches).select("digest", "keep_id")
    rows = with_row(df, id=F.col(f"`{id_col}`").cast("long"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [hashlib.sha256(t.encode().translate(FOLD)).digest() for t in row_texts(batch, text_col)]
            return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(found, pa.binary())], ["row", "id", "digest"])

        return step

    keyed = by_batch(rows, make, row_schema(rows, id="long", digest="binary"))
    return keyed.join(groups, "digest").filter(F.col("id").eqNullSafe(F.col("keep_id"))).select("row.*")
