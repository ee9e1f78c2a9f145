"""Passages that repeat: every byte under a string of ``size`` bytes that also starts elsewhere, by segments chosen by content.

This is not distributed prefix doubling: Spark neither sorts positions nor ranks them again until they are unique. Ranks
are hashes of bytes, and repeats are found by counting equal ranks. Ranks of a quarter of the length are made at every
byte inside a task. A window is a string of ``size`` bytes, its anchor the least quarter-length rank in it (the leftmost
of equals): a choice by content, so equal windows have equal anchors. Neighbouring windows with the same anchor position
are one segment.

Round by round segments are grouped by a longer rank and what is unique leaves: first by the anchor's rank (a window
repeats only where its anchor does), then by the rank of all bytes of the segment's windows (those that repeat are
repeated throughout), then, at the borders of repeated passages, by the bytes that blocks of neighbouring windows share,
and the windows that are left one by one; only their ranks are doubled up to the whole length, inside a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpimill.llm.base import by_batch, row_schema, row_texts, texts_of, with_row
from kpimill.session import materialize

SIZE = 400
BLOCK = 32  # neighbouring windows that are ranked together first


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Ranker:
    """64-bit ranks of all strings of one length in a text, from running sums of weighted bytes."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.byte = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.factor = int(rng.integers(0, 2**62)) * 4 + 3
        self.inverse = pow(self.factor, -1, 2**64)
        self.up = self.down = np.zeros(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, base in (("up", self.factor), ("down", self.inverse)):
                p = np.full(n, np.uint64(base))
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def __call__(self, data: np.ndarray, length: int) -> np.ndarray:
        n = len(data)
        self._powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[data] * self.down[:n], out=sums[1:])
        places = n - length + 1
        return _mix((sums[length:] - sums[:-length]) * self.up[:places])


def double(ranks: np.ndarray, length: int) -> np.ndarray:
    """Ranks of twice the length from pairs of ranks at that offset."""
    return _mix(ranks[:-length] * np.uint64(0xD6E8FEB86659FD93) + _mix(ranks[length:] + np.uint64(length)))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    places = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.uint64(2**64 - 1))
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:places], ahead[width - 1 : width - 1 + places])


def segments(data: np.ndarray, ranker: Ranker, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor rank of every segment of a text of at least ``size`` bytes."""
    quarter = max(1, size // 4)
    ranks = ranker(data, quarter)
    least = sliding_least(ranks, size - quarter + 1)
    # the anchor moves when the least rank changes, and when it stood at the place that the window leaves
    cut = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (ranks[: len(least) - 1] == least[:-1])]))
    return cut, np.append(cut[1:], len(least)) - 1, least[cut]


def window_ranks(data: np.ndarray, rankers: tuple[Ranker, Ranker], size: int) -> list[np.ndarray]:
    """Two independent ranks of every window of the stretch, doubled up from an eighth of the size or less."""
    length = size
    while length % 2 == 0 and length > 50:
        length //= 2
    out = []
    for r in rankers:
        ranks, n = r(data, length), length
        while n < size:
            ranks, n = double(ranks, n), 2 * n
        out.append(ranks)
    return out


def text_key(data: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(data)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def digests(raw: bytes, lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
    """Ranks of all bytes of segments: (segments, 2)."""
    found = [xxhash.xxh3_128_digest(raw[a : b + size]) for a, b in zip(lo.tolist(), hi.tolist())]
    return np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)


def find_segments(texts: DataFrame, size: int) -> DataFrame:
    """(k1, k2, lo, hi, anchor, f1, f2, n): the distinct segments of every text, with the first place and the number of each;
    k is a key of the text, f the rank of the segment's bytes."""

    def make():
        ranker = Ranker(1)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = []
            for text in texts_of(batch, "text"):
                raw = text.encode()
                if len(raw) >= size:
                    lo, hi, anchor = segments(np.frombuffer(raw, np.uint8), ranker, size)
                    f = digests(raw, lo, hi, size)
                    _, first, n = np.unique(f[:, 0] ^ (f[:, 1] << 1), return_index=True, return_counts=True)
                    key = np.tile(np.frombuffer(xxhash.xxh3_128_digest(raw), "<i8"), (len(first), 1))
                    parts.append((key, lo[first], hi[first], anchor[first].view(np.int64), f[first], n))
            if not parts:
                parts = [(np.zeros((0, 2), np.int64), *(np.zeros(0, np.int64),) * 3, np.zeros((0, 2), np.int64), np.zeros(0, np.int64))]
            key, lo, hi, anchor, f, n = (np.concatenate(x) for x in zip(*parts))
            columns = [key[:, 0], key[:, 1], lo.astype(np.int32), hi.astype(np.int32), anchor, f[:, 0], f[:, 1], n.astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["k1", "k2", "lo", "hi", "anchor", "f1", "f2", "n"])

        return step

    return by_batch(texts, make, "k1 long, k2 long, lo int, hi int, anchor long, f1 long, f2 long, n int")


def packed_texts(texts: DataFrame, size: int) -> DataFrame:
    """(k1, k2, packed): texts of at least ``size`` bytes, compressed, copies inside one task once."""

    def make():
        packer, seen = zstandard.ZstdCompressor(level=1), set()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, packed = [], []
            for text in texts_of(batch, "text"):
                raw = text.encode()
                if len(raw) >= size and (key := text_key(raw)) not in seen:
                    seen.add(key)
                    keys.append(key)
                    packed.append(packer.compress(raw))
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(packed, pa.binary())], ["k1", "k2", "packed"]
            )

        return step

    return by_batch(texts, make, "k1 long, k2 long, packed binary")


def _places(data: np.ndarray, ranker: Ranker, lo: int, hi: int, size: int) -> tuple[int, np.ndarray]:
    """The anchor's place of a segment, and its windows' distances to it in blocks of ``BLOCK``."""
    anchor = lo + int(ranker(data[lo : lo + size], max(1, size // 4)).argmin())
    return anchor, (anchor - np.arange(lo, hi + 1)) // BLOCK


def _blocks(size: int):
    """(c1, c2, segment, block, alone): the windows of wanted segments in blocks by their distance to the anchor, each with the
    rank of the bytes that all windows of the block have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker, unpack = Ranker(1), zstandard.ZstdDecompressor()
        for batch in batches:
            cores, segment, block, alone = [], [], [], []
            for packed, wanted in zip(batch.column("packed").to_pylist(), batch.column("wanted").to_pylist()):
                raw = unpack.decompress(packed)
                data = np.frombuffer(raw, np.uint8)
                for w in wanted:
                    anchor, of = _places(data, ranker, w["lo"], w["hi"], size)
                    for b in np.unique(of).tolist():
                        nearest, farthest = b * BLOCK, b * BLOCK + BLOCK - 1
                        core = raw[max(0, anchor - nearest) : max(0, anchor - farthest + size)]
                        cores.append(xxhash.xxh3_128_digest(core + b.to_bytes(4, "little")))
                        segment.append(w["segment"])
                        block.append(b)
                        alone.append(w["alone"])
            c = np.frombuffer(b"".join(cores), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c[:, 0])), pa.array(np.ascontiguousarray(c[:, 1])), pa.array(segment, pa.int64()), pa.array(block, pa.int32()), pa.array(alone, pa.bool_())],
                ["c1", "c2", "segment", "block", "alone"],
            )

    return run


def _windows(size: int):
    """(w1, w2, segment, at): the windows of the wanted blocks of segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, rankers, unpack = Ranker(1), (Ranker(2), Ranker(3)), zstandard.ZstdDecompressor()
        for batch in batches:
            for packed, wanted in zip(batch.column("packed").to_pylist(), batch.column("wanted").to_pylist()):
                data, out = np.frombuffer(unpack.decompress(packed), np.uint8), []
                for w in wanted:
                    _, of = _places(data, first, w["lo"], w["hi"], size)
                    keep = np.isin(of, w["blocks"])
                    w1, w2 = window_ranks(data[w["lo"] : w["hi"] + size], rankers, size)
                    out.append((w1[keep], w2[keep], np.full(keep.sum(), w["segment"]), np.arange(w["lo"], w["hi"] + 1)[keep]))
                w1, w2, segment, at = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(segment), pa.array(at.astype(np.int32))], ["w1", "w2", "segment", "at"]
                )

    return run


def _cut(size: int, with_text: bool):
    """(k1, k2, n_removed, n_spans, kept_sha256, kept_text) of texts with repeated segments (by rank) and windows (by place)."""

    def make():
        unpack, ranker = zstandard.ZstdDecompressor(), Ranker(1)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            removed, spans, hexes, kept = [], [], [], []
            for packed, whole, found in zip(*(batch.column(c).to_pylist() for c in ("packed", "whole", "found"))):
                raw = unpack.decompress(packed)
                data, edge = np.frombuffer(raw, np.uint8), np.zeros(len(raw) + 1, np.int32)
                if whole:
                    lo, hi, _ = segments(data, ranker, size)
                    gone = {(s["f1"], s["f2"]) for s in whole}
                    hit = np.array([tuple(f) in gone for f in digests(raw, lo, hi, size).tolist()])
                    np.add.at(edge, lo[hit], 1)
                    np.add.at(edge, hi[hit] + size, -1)
                at = np.array(found or [], np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + size, -1)
                covered = np.cumsum(edge[:-1]) > 0
                rest = data[~covered].tobytes()
                removed.append(int(covered.sum()))
                spans.append(int(np.count_nonzero(np.diff(np.concatenate([[0], covered.view(np.int8)])) == 1)))
                hexes.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode(errors="ignore") if with_text else None)
            return pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(hexes, pa.string()), pa.array(kept, pa.string())],
                ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

        return step

    return make


KEYED = "k1 long, k2 long, n_bytes long, sha string"


def repeated_parts(df: DataFrame, text_col: str = "text", size: int = SIZE, with_text: bool = False) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept_sha256, kept_text) for every distinct text with a byte to remove."""
    texts = df.select(F.col(f"`{text_col}`").alias("text"))
    found = materialize(find_segments(texts, size), "segments")

    # round 1: anchors that stand at more than one place
    often = found.groupBy("anchor").agg(F.sum("n").alias("all")).filter("all > 1").select("anchor")
    live = materialize(found.join(often, "anchor"), "segments-1")

    # round 2: whole segments; where one repeats, all of its windows do
    whole = live.groupBy("anchor", "f1", "f2").agg(F.sum("n").alias("all"), F.min("k1").alias("one"))
    whole = materialize(whole, "segments-2")
    kinds = whole.groupBy("anchor").agg(F.sum(F.when(F.col("all") == 1, 1).otherwise(0)).alias("singles"), F.count("*").alias("kinds"))
    # a segment that stands alone in its class has nothing to be compared with
    state = whole.join(kinds, "anchor").filter("all > 1 or kinds > 1").select("anchor", "f1", "f2", "all", "one", "singles")
    ranked = materialize(live.drop("n").join(state, ["anchor", "f1", "f2"]), "segments-3")
    repeated = ranked.filter("all > 1").select("k1", "k2", "f1", "f2").distinct()

    # round 3: the segments that stand alone but share an anchor, against each other and against one copy of each repeated
    # segment with that anchor: by the bytes common to neighbouring windows, which are nearly as long as a window
    alone = ranked.filter("all = 1").select("k1", "k2", "lo", "hi", F.lit(True).alias("alone"))
    partners = ranked.filter("all > 1 and singles > 0 and k1 = one").groupBy("anchor", "f1", "f2").agg(F.min(F.struct("k1", "k2", "lo", "hi")).alias("s"))
    wanted = alone.unionByName(partners.select("s.*", F.lit(False).alias("alone"))).withColumn("segment", F.monotonically_increasing_id())
    wanted = materialize(wanted, "segments-4")
    keys = repeated.select("k1", "k2").unionByName(wanted.select("k1", "k2")).distinct()
    there = materialize(packed_texts(texts, size).join(keys, ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("packed").alias("packed")), "texts")
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi", "segment", "alone")).alias("wanted"))
    blocks = there.join(lists, ["k1", "k2"]).select("packed", "wanted").mapInArrow(_blocks(size), "c1 long, c2 long, segment long, block int, alone boolean")
    blocks = materialize(blocks, "blocks")
    met = blocks.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.max("alone").alias("any")).filter("n > 1 and any").select("c1", "c2")
    left = blocks.join(met, ["c1", "c2"]).groupBy("segment").agg(F.collect_list("block").alias("blocks"))

    # round 4: the windows of blocks that are left
    lists = wanted.join(left, "segment").groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi", "segment", "blocks")).alias("wanted"))
    windows = materialize(there.join(lists, ["k1", "k2"]).select("packed", "wanted").mapInArrow(_windows(size), "w1 long, w2 long, segment long, at int"), "windows")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    hits = windows.join(twice, ["w1", "w2"]).select("segment", "at")
    single = hits.join(wanted.filter("alone").drop("lo", "hi"), "segment").groupBy("k1", "k2").agg(F.collect_list("at").alias("found"))

    whole = repeated.groupBy("k1", "k2").agg(F.collect_list(F.struct("f1", "f2")).alias("whole"))
    marked = whole.join(single, ["k1", "k2"], "full")
    schema = "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    return materialize(by_batch(there.join(marked, ["k1", "k2"]), _cut(size, with_text), schema), "repeats")


def keyed(rows: DataFrame, schema: T.StructType, texts: Callable[[pa.RecordBatch], list[str]]) -> DataFrame:
    """The first column of ``rows`` with the key, bytes and digest of the texts of its batches: k1, k2, n_bytes, sha."""
    carried = schema.names[0]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            raws = [t.encode() for t in texts(batch)]
            keys = [text_key(r) for r in raws]
            return pa.RecordBatch.from_arrays(
                [batch.column(carried), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(map(len, raws)), pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raws])],
                [carried, "k1", "k2", "n_bytes", "sha"],
            )

        return step

    return by_batch(rows, make, schema)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A text is its UTF-8 bytes (null: none). Removed is every byte covered by a string of ``size`` bytes that starts at
    another place too, in this or another text; strings may overlap and are judged on the input. Rows with equal or null
    ids are texts of their own; texts shorter than ``size`` lose nothing; an empty table gives no rows; other columns are
    ignored. A text is one row, and so are the places of its repeats: both must fit a task's memory.
    """
    parts = repeated_parts(df, text_col, size)
    rows = keyed(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), T.StructType.fromDDL(f"doc_id long, {KEYED}"), lambda b: texts_of(b, "text"))
    return rows.join(parts, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def without_repeats(df: DataFrame, text_col: str = "text", size: int = SIZE) -> DataFrame:
    """The input with the remaining text in place of each text: bytes of a character that was cut through are left out
    with it; a text that loses nothing stays as it is, null included. Equal or null ids don't matter; an empty table gives no
    rows; other columns may have any names."""
    parts = repeated_parts(df, text_col, size, with_text=True).select("k1", "k2", "kept_text")
    rows = with_row(df)
    joined = keyed(rows, row_schema(rows, **dict(c.split() for c in KEYED.split(", "))), lambda b: row_texts(b, text_col)).join(parts, ["k1", "k2"], "left")
    field = lambda c: F.col("row")[c]
    return joined.select(*(F.coalesce("kept_text", field(c)).alias(c) if c == text_col else field(c).alias(c) for c in df.columns))
