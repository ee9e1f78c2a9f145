"""Repeated strings by distributed prefix doubling over byte positions.

Every position that may start a repeated string of ``size`` bytes is a row with a rank: two positions have one rank if and
only if the bytes from them on are equal up to the length reached so far. A round pairs the rank of a position with the
rank at the offset of that length, sorts the distinct pairs, and gives each pair that stands twice or more its place in
that order as the new rank, so the length doubles; positions whose pair stands alone are dropped and never looked at
again. The last offset is shorter where ``size`` is no power of two times the first length. What is left at the end
starts a repeated string.

First ranks are hashes of some 50 bytes, taken inside a task, and only for positions that a content-chosen segment with a
repeated anchor leaves possible (see ``suffix_dedup``). Even so a position costs some 20 bytes in each of three shuffles a
round, and a byte is a position: on texts with many copies this writes many times the input. ``suffix_dedup`` groups
neighbouring positions instead; results are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpimill.llm.base import by_batch
from kpimill.llm.suffix_dedup import SIZE, Ranker, segments
from kpimill.session import materialize

FIRST = 50  # bytes that first ranks stand for, at most


def first_length(size: int) -> int:
    while size > FIRST:
        size = -(-size // 2)
    return size


def stored_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(t, doc_id, n_bytes, sha, packed): every row's text, compressed, under a number of its own."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def make():
        packer = zstandard.ZstdCompressor(level=1)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            raws = [t.encode() for t in batch.column("text").to_pylist()]
            columns = [pa.array(list(map(len, raws)), pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raws], pa.string()), pa.array(list(map(packer.compress, raws)), pa.binary())]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "sha", "packed"])

        return step

    made = by_batch(rows, make, "doc_id long, n_bytes long, sha string, packed binary")
    return materialize(made.select(F.monotonically_increasing_id().alias("t"), "*"), "doubling-texts")


def possible(texts: DataFrame, size: int) -> DataFrame:
    """(t, lo, hi): stretches of window starts whose anchor stands at another place too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker, unpack = Ranker(1), zstandard.ZstdDecompressor()
        for batch in batches:
            for t, packed in zip(batch.column("t").to_pylist(), batch.column("packed").to_pylist()):
                data = np.frombuffer(unpack.decompress(packed), np.uint8)
                if len(data) >= size:
                    lo, hi, anchor = segments(data, ranker, size)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(lo), t)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(anchor.view(np.int64))], ["t", "lo", "hi", "anchor"])

    found = materialize(texts.filter(F.col("n_bytes") >= size).select("t", "packed").mapInArrow(run, "t long, lo int, hi int, anchor long"), "doubling-segments")
    often = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    return found.join(often, "anchor").select("t", "lo", "hi")


def first_ranks(texts: DataFrame, stretches: DataFrame, size: int, length: int) -> DataFrame:
    """(t, p, r): positions that a window of the stretches holds, with the hash of ``length`` bytes."""
    lists = stretches.groupBy("t").agg(F.collect_list(F.struct("lo", "hi")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker, unpack = Ranker(2), zstandard.ZstdDecompressor()
        for batch in batches:
            for t, packed, wanted in zip(*(batch.column(c).to_pylist() for c in ("t", "packed", "wanted"))):
                data = np.frombuffer(unpack.decompress(packed), np.uint8)
                edge = np.zeros(len(data) + 2, np.int32)
                for w in wanted:
                    edge[w["lo"]] += 1
                    edge[w["hi"] + size - length + 1] -= 1
                p = np.flatnonzero(np.cumsum(edge[: len(data) - length + 1]) > 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), t)), pa.array(p.astype(np.int32)), pa.array(ranker(data, length)[p].view(np.int64))], ["t", "p", "r"])

    return texts.select("t", "packed").join(lists, "t").select("t", "packed", "wanted").mapInArrow(run, "t long, p int, r long")


def reranked(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(t, p, r) of the positions whose pair stands at another place too; r is the pair's place in the order of all pairs.

    Pairs are counted before they are shuffled and sorted, so one that holds a third of all positions is one row there.
    """
    often = pairs.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys)
    order = materialize(often.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id()), "doubling-order")
    return materialize(pairs.join(order, keys).select("t", "p", F.col("rank").alias("r")), "doubling-ranks")


def repeated_positions(texts: DataFrame, size: int) -> DataFrame:
    """(t, p): every position whose string of ``size`` bytes starts elsewhere too."""
    length = first_length(size)
    ranks = reranked(materialize(first_ranks(texts, possible(texts, size), size, length), "doubling-first"), ["r"])
    while length < size:
        offset = min(length, size - length)
        ahead = ranks.select("t", (F.col("p") - offset).alias("p"), F.col("r").alias("r2"))
        pairs = materialize(ranks.join(ahead, ["t", "p"]).select("t", "p", F.col("r").alias("r1"), "r2"), "doubling-pairs")
        ranks, length = reranked(pairs, ["r1", "r2"]), length + offset
    return ranks.select("t", "p")


def remove_repeats_by_doubling(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """The rows of ``suffix_dedup.remove_repeats``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, with the same edge cases."""
    texts = stored_texts(df, id_col, text_col)
    places = repeated_positions(texts, size).groupBy("t").agg(F.collect_list("p").alias("found"))

    def make():
        unpack = zstandard.ZstdDecompressor()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            removed, spans, hexes = [], [], []
            for packed, found in zip(batch.column("packed").to_pylist(), batch.column("found")):
                data, at = np.frombuffer(unpack.decompress(packed), np.uint8), np.asarray(found.values, np.int64)
                edge = np.zeros(len(data) + 1, np.int32)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + size, -1)
                covered = np.cumsum(edge[:-1]) > 0
                removed.append(int(covered.sum()))
                spans.append(int(np.count_nonzero(np.diff(np.concatenate([[0], covered.view(np.int8)])) == 1)))
                hexes.append(hashlib.sha256(data[~covered].tobytes()).hexdigest())
            return pa.RecordBatch.from_arrays([batch.column("t"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(hexes, pa.string())], ["t", "n_removed", "n_spans", "kept_sha256"])

        return step

    cut = by_batch(texts.select("t", "packed").join(places, "t"), make, "t long, n_removed long, n_spans long, kept_sha256 string")
    return texts.select("t", "doc_id", "n_bytes", "sha").join(cut, "t", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
