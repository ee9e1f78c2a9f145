"""Packing documents into sequences of bounded length by length patterns.

All piece lengths make a histogram (one number per length, so its size is the sequence length). Patterns of up to three
lengths that fill a sequence exactly are enumerated; non-negative least squares finds how often to repeat each so that
the pieces they use match the histogram; the counts are rounded to what is there, and the pieces left over are packed
best-fit by decreasing length, on counts again. Every piece then finds its place from its rank among the pieces of its
length. Only histograms and patterns are on the driver, and their size does not depend on the number of documents.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpimill.llm.base import forget, parts_of, texts_of
from kpimill.llm.chunks import ChunkEncoder, CompiledVocabulary
from kpimill.session import materialize

NNLS_STEPS = 400


def exact_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All multisets of one to three of the lengths that sum to ``size``: rows of three, unused places 0."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    short = lengths[lengths < size]
    out = [np.array([[size, 0, 0]])] if there[size] else []
    two = short[(2 * short >= size) & there[size - short]]
    out.append(np.stack([two, size - two, 0 * two], axis=1))
    for a in short:  # the largest of three
        rest = size - a
        b = short[(short <= a) & (2 * short >= rest) & (short < rest)]
        b = b[there[rest - b]]
        if len(b):
            out.append(np.stack([np.full(len(b), a), b, rest - b], axis=1))
    return np.concatenate(out).astype(np.int64)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, steps: int = NNLS_STEPS) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradients: repeat counts whose pieces match the histogram.

    Residuals count by the square root of the length: a long piece left over costs more sequences than a short one.
    """
    size = len(histogram) - 1
    weight = np.sqrt(np.arange(size + 1) / size)
    weight[0] = 0.0
    target = histogram * weight

    def use(x):
        return np.bincount(patterns.ravel(), weights=np.repeat(x, patterns.shape[1]), minlength=size + 1) * weight

    def back(r):
        return (r * weight)[patterns].sum(axis=1)

    v = np.ones(len(patterns))
    for _ in range(12):  # the largest eigenvalue bounds the step
        v = back(use(v))
        norm = np.linalg.norm(v) or 1.0
        v /= norm
    step = 1.0 / (1.05 * norm)
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(steps):
        nxt = np.maximum(y - step * back(use(y) - target), 0.0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t_next * (nxt - x)
        x, t = nxt, t_next
    return x


def best_fit(histogram: np.ndarray) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing on counts: pattern -> repeats. Open sequences are kept by their free space."""
    size = len(histogram) - 1
    free: list[int] = []  # sorted
    open_: dict[int, list[list]] = {}
    done: dict[tuple[int, ...], int] = {}

    def put(pattern, n, space):
        if not space:
            done[pattern] = done.get(pattern, 0) + n
        elif space in open_:
            open_[space].append([pattern, n])
        else:
            bisect.insort(free, space)
            open_[space] = [[pattern, n]]

    for length in range(size, 0, -1):
        left = int(histogram[length])
        while left:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                space = free[at]
                pattern, n = open_[space].pop()
                if not open_[space]:
                    del open_[space]
                    free.pop(at)
            else:
                space, pattern, n = size, (), left
            # a sequence that got a piece is the tightest one for the next, as long as it has room
            per = space // length
            whole = min(n, left // per)
            rest = left - whole * per if whole < n else 0
            for repeats, k in ((whole, per), (int(rest > 0), rest), (n - whole - (rest > 0) if pattern else 0, 0)):
                if repeats:
                    put(pattern + (length,) * k, repeats, space - k * length)
            left -= whole * per + rest
    for groups in open_.values():
        for pattern, n in groups:
            done[pattern] = done.get(pattern, 0) + n
    return done


def plan_patterns(histogram: np.ndarray, steps: int = NNLS_STEPS) -> dict[tuple[int, ...], int]:
    """Patterns and their repeats that use every piece of the histogram exactly once."""
    size = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    plan: dict[tuple[int, ...], int] = {}
    patterns = exact_patterns(np.flatnonzero(left), size)
    if len(patterns):
        fitted = fit_counts(patterns, histogram.astype(float), steps)
        order = np.argsort(-fitted, kind="stable")
        for p, n in zip(patterns[order].tolist(), np.rint(fitted[order]).astype(np.int64).tolist()):
            if n <= 0:
                break
            p = tuple(x for x in p if x)
            n = min(n, *(int(left[x]) // p.count(x) for x in p))
            if n > 0:
                for x in p:
                    left[x] -= n
                plan[p] = plan.get(p, 0) + n
    for p, n in best_fit(left).items():
        plan[p] = plan.get(p, 0) + n
    return plan


@dataclass
class Places:
    """Where the piece of a rank among the pieces of its length goes; sorted by (length, first rank)."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.length.astype(np.int64) << 44 | self.rank
        at = np.searchsorted(key, length.astype(np.int64) << 44 | rank, "right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def places(plan: dict[tuple[int, ...], int]) -> Places:
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in plan.items():
        offset = 0
        for length in pattern:
            first = used.get(length, 0)
            rows.append((length, first, sequence, offset))
            used[length] = first + n
            offset += length
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Places(*(table[:, i] for i in range(4)))


def cut_pieces(df: DataFrame, vocabulary: str, end_id: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """(part, doc_id, piece, start, length, ids_crc32, ids, rank): texts as ids with ``end_id``, longer ones cut into pieces of
    ``size`` of which the first may be shorter; ``rank`` counts the pieces of one length in one task."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    compiled = CompiledVocabulary(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # the cache of an encoder fills within a task, so none is kept for the next one
        run, end = ChunkEncoder(compiled.encoder()), np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in (part for whole in batches for part in parts_of(whole)):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                blob = run(text) + end
                n = len(blob) // 4
                start, length = 0, (n - 1) % size + 1
                for piece in range(-(-n // size)):
                    out.append((part, doc, piece, start, length, zlib.crc32(blob[4 * start : 4 * (start + length)]), int(seen[length])))
                    seen[length] += 1
                    start, length = start + length, size
            names = ["part", "doc_id", "piece", "start", "length", "ids_crc32", "rank"]
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        del run
        forget()

    return rows.mapInArrow(cut, "part int, doc_id long, piece int, start long, length long, ids_crc32 long, rank long")


def pack(df: DataFrame, vocabulary: str, end_id: int = 0, size: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone; rows with equal or null ids are documents of their own; an empty table
    gives no rows; other columns of the input are ignored. The pieces are written once, so that ranks and places speak of
    the same rows whatever is lost later.
    """
    pieces = materialize(cut_pieces(df, vocabulary, end_id, size, id_col, text_col), "pieces")
    counts = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(size + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        histogram[r["length"]] = r["n"]
    # plain values: a broadcast object would need its class on the executors' path
    where = df.sparkSession.sparkContext.broadcast(vars(places(plan_patterns(histogram))))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Places(**where.value)
        for batch in batches:
            if batch.num_rows:
                length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
                sequence, offset = known.of(length, rank)
                keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])

    ranked = pieces.join(base, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
