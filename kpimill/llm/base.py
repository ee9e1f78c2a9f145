"""Helpers shared by the operators: Arrow batches in tasks, partition counts, connected components."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpimill.session import discard, staged


def give_back() -> None:
    """Hand the memory that a task has freed back to the system: its worker lives on beside other processes of the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def parts_of(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in parts of so many rows, whose texts need not all be Python strings at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def parts_by_bytes(batch: pa.RecordBatch, column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A batch in parts with so many bytes of text, or of one longer row."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(), dtype=np.int64), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def by_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """Map Arrow batches by a function that ``make`` builds once in every task (its tables and caches live there).

    The caches are many small objects without cycles, which Python's cycle collector would walk again and again; it
    rests while the task runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        try:
            sys._kpimill_used = False
            step = make()
            if not sys._kpimill_used:  # what another operator's tasks have left here is not needed any more
                sys._kpimill_kept = None
            for batch in batches:
                if batch.num_rows:
                    yield step(batch)
        finally:
            gc.enable()
            give_back()

    return df.mapInArrow(run, schema)


def by_group(df: DataFrame, keys: list[str], make: Callable[[], Callable[[pa.Table, np.ndarray], pa.RecordBatch]], schema: str) -> DataFrame:
    """Rows are dealt by their keys and sorted; ``step(table, cuts)`` gets whole groups, ``cuts`` being where each begins
    and the end of the last one. The callers see to it that groups are bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        sys._kpimill_kept = None
        try:
            step, held = make(), None
            for batch in batches:
                table = pa.Table.from_batches([batch])
                if held is not None:
                    table = pa.concat_tables([held, table])
                if not table.num_rows:
                    continue
                new = np.zeros(table.num_rows, bool)
                new[0] = True
                for k in keys:
                    v = table.column(k).to_numpy()
                    new[1:] |= v[1:] != v[:-1]
                cuts = np.flatnonzero(new)
                # the last group may go on in the next batch
                held = table.slice(cuts[-1])
                if cuts[-1]:
                    yield step(table.slice(0, cuts[-1]), cuts)
            if held is not None and held.num_rows:
                yield step(held, np.array([0, held.num_rows]))
        finally:
            gc.enable()
            give_back()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def kept(key: str, make: Callable[[], object]) -> object:
    """What ``make`` builds, kept by the worker process for the next tasks that ask for the same key.

    Spark runs many tasks in one Python worker, and tables that fill up as texts come in are worth keeping. Only the last
    key's object is held, until tasks of ``by_batch`` run that keep nothing. Code shipped by value has no module to keep it in, so it hangs on ``sys``.
    """
    held = getattr(sys, "_kpimill_kept", None)
    sys._kpimill_used = True
    if held is None or held[0] != key:
        held = sys._kpimill_kept = None
        give_back()
        held = sys._kpimill_kept = (key, make())
    return held[1]


def forget() -> None:
    """Drop what the worker process keeps and hand the memory back, for a task that needs much or is an operator's last one."""
    sys._kpimill_kept = None
    give_back()


def with_row(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows as one struct column ``row``, and further columns beside it: names of the input can't clash with them."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *(c.alias(k) for k, c in columns.items()))


def row_schema(rows: DataFrame, **more: str) -> T.StructType:
    """The schema of ``row`` and further columns of plain types."""
    return T.StructType([rows.schema["row"], *T.StructType.fromDDL(", ".join(f"{k} {t}" for k, t in more.items())).fields])


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column as Python strings; null is the empty text."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def row_texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts inside ``row``."""
    return [t if t is not None else "" for t in batch.column("row").field(column).to_pylist()]


def spread(df: DataFrame, rows_per_task: int, rows: int) -> int:
    """How many tasks a table of so many rows is dealt to, the session's shuffle width at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


class Forest:
    """Union-find over 0..n-1 inside one task; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return int(i)

    def join(self, i: int, others: np.ndarray) -> None:
        roots = {self.root(int(j)) for j in others}
        roots.add(self.root(i))
        low = min(roots)
        for r in roots:
            self.parent[r] = low

    def labels(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if (q == p).all():
                return p
            p = q


def linked_sets(n: int, linked: Callable[[int], np.ndarray]) -> np.ndarray:
    """Labels (smallest member) of the connected sets of n items, where ``linked(i)`` names all items linked with i.

    Items that already hang together need not be compared with one another: an edge between two sets has an end
    outside the largest one, so it is enough that every item outside the largest set is compared with all. A tight
    group costs one comparison with all per group, not one per member.
    """
    forest, done, taken = Forest(n), np.zeros(n, bool), np.zeros(n, bool)

    def look(i: int) -> None:
        found = linked(i)
        done[i] = True
        taken[found] = True
        forest.join(i, found)

    for i in range(n):
        if not taken[i]:
            look(i)
    while True:
        labels = forest.labels()
        rest = np.flatnonzero((labels != np.bincount(labels, minlength=n).argmax()) & ~done) if n else labels
        if not len(rest):
            return labels
        # one item of every open set at a time, which may join sets before their other members are looked at
        for i in rest[np.unique(labels[rest], return_index=True)[1]]:
            look(int(i))


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of an undirected graph: (node, component), the smallest reachable node.

    ``edges`` has long columns ``a`` and ``b``; loops, repeats and nulls are allowed and do nothing. Only nodes with an
    edge are returned. Alternating large-star and small-star contraction: every round is two aggregations that combine
    before their shuffle and one join, written to the shared folder; nothing is gathered on the driver but two sums.
    """
    spark = edges.sparkSession
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    e, place = staged(edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select(high, low).distinct(), name)
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, between = staged(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e, after = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        discard(spark, place, between)  # a round reads the one before only
        place = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
