"""Near-duplicate embeddings by an inverted multi-index.

Each half of a vector has a codebook of its own; a vector lives in the cell of the product grid that its nearest code
words name. A search visits cells in the order of the summed distances of their two code words, nearest first
(multi-sequence traversal), until the wanted share of true neighbours lies within: how far that is, is measured once on
the true neighbours, among all vectors, of a bounded sample. What shares a visited cell is verified by its cosine in
double precision. Every vector is indexed and every vector searches; a pair is found from either side.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpimill.llm.base import by_batch, by_group, components
from kpimill.session import materialize

THRESHOLD = 0.9
RECALL = 0.995
SAMPLE = 8000  # vectors that the codebooks and the radius are fitted on
PER_CELL = 100  # vectors a cell holds on average
CELL_BLOCK = 2048
SEARCHED = 2000  # vectors whose true neighbours among all vectors are found by brute force, for the radius
ENOUGH = 400  # true pairs that a radius is taken from
BORDER = 0.02  # pairs less than this above the threshold are border pairs
STEP = 1 / 512  # radii are counted in steps, and rounded up


# --- the index ------------------------------------------------------------------------------------------------------------


def code_book(points: np.ndarray, words: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """k-means code words of a sample."""
    book = points[rng.choice(len(points), min(words, len(points)), replace=False)].copy()
    for _ in range(rounds):
        near = ((book**2).sum(1) - 2 * points @ book.T).argmin(1)
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=len(book))
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


class Grid:
    """The product grid of two code books; ``radius``: how much farther than the nearest cell a search goes."""

    def __init__(self, first: np.ndarray, second: np.ndarray, radius: float = 0.0):
        self.first, self.second, self.radius, self.half = first, second, radius, first.shape[1]

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How much farther than its nearest word every word of either book is from every vector."""
        out = []
        for book, part in ((self.first, unit[:, : self.half]), (self.second, unit[:, self.half :])):
            d = (book**2).sum(1) - 2 * part @ book.T
            out.append(d - d.min(1, keepdims=True))
        return out[0], out[1]

    def visit(self, d1: np.ndarray, d2: np.ndarray) -> list[int]:
        """Cells in the order of their summed distance, up to the radius: multi-sequence traversal of two sorted lists."""
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        s1, s2 = d1[o1].tolist(), d2[o2].tolist()
        heap, seen, cells = [(0.0, 0, 0)], {(0, 0)}, []
        while heap:
            d, i, j = heapq.heappop(heap)
            if d > self.radius:
                break
            cells.append(int(o1[i]) * len(self.second) + int(o2[j]))
            for i2, j2 in ((i + 1, j), (i, j + 1)):
                if i2 < len(s1) and j2 < len(s2) and (i2, j2) not in seen:
                    seen.add((i2, j2))
                    heapq.heappush(heap, (s1[i2] + s2[j2], i2, j2))
        return cells


def reach(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The radius that each pair (row i of x, row j of y, both given by their ``distances``) needs to be found from one of
    its sides at least."""
    (x1, x2), (y1, y2) = x, y
    there = x1[i, y1.argmin(1)[j]] + x2[i, y2.argmin(1)[j]]
    back = y1[j, x1.argmin(1)[i]] + y2[j, x2.argmin(1)[i]]
    return np.minimum(there, back)


def turned(x: np.ndarray, toward: np.ndarray, threshold: float) -> np.ndarray:
    """Unit vectors turned by the threshold's angle."""
    turn = toward - (toward * x).sum(1, keepdims=True) * x
    turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
    return threshold * x + np.sqrt(1 - threshold**2) * turn


def fit_grid(sample: np.ndarray, n: int, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 5) -> Grid:
    """Code books from a sample of unit vectors, and the least radius: that of made neighbours at the threshold, the
    sample's vectors turned in random directions. ``widened`` adds what true neighbours need."""
    rng = np.random.default_rng(seed)
    words = int(np.clip(round(np.sqrt(n / PER_CELL)), 1, max(1, len(sample) // 4)))
    half = sample.shape[1] // 2
    grid = Grid(code_book(sample[:, :half], words, rng), code_book(sample[:, half:], words, rng))
    x = sample[rng.choice(len(sample), min(len(sample), 4000), replace=False)]
    y, i = turned(x, rng.standard_normal(x.shape), threshold), np.arange(len(x))
    grid.radius = float(np.quantile(reach(grid.distances(x), grid.distances(y), i, i), recall))
    return grid


def radius_of(steps: np.ndarray, weight: np.ndarray, recall: float) -> float:
    """The least radius with the wanted share of the weight within."""
    order = np.argsort(steps, kind="stable")
    share = np.cumsum(weight[order])
    at = min(int(np.searchsorted(share, recall * share[-1])), len(share) - 1)
    return float(steps[order][at] * STEP)


def widened(grid: Grid, sample: np.ndarray, found: np.ndarray, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 5) -> Grid:
    """The grid with the radius that true pairs need. ``found``: (searched vector, is a border pair, steps, pairs) rows.

    The wanted share holds for all pairs, for the pairs of each searched vector on average (one crowded group doesn't
    outvote the others), and for border pairs if there are enough. With too few pairs in all, the sample's vectors turned
    toward one another count as well, as they differ the way the data does.
    """
    radii = [grid.radius]
    if len(found):
        who, border, steps, n = found.T
        radii += [radius_of(steps, n, recall), radius_of(steps, n / np.bincount(who, weights=n)[who], recall)]
        if n[border > 0].sum() >= ENOUGH:
            radii.append(radius_of(steps[border > 0], n[border > 0], recall))
    if not len(found) or found[:, 3].sum() < ENOUGH:
        rng = np.random.default_rng(seed)
        x = sample[rng.choice(len(sample), min(len(sample), 4000), replace=False)]
        y, i = turned(x, sample[rng.integers(0, len(sample), len(x))], threshold), np.arange(len(x))
        radii.append(float(np.quantile(reach(grid.distances(x), grid.distances(y), i, i), recall)))
    grid.radius = max(radii)
    return grid


# --- Spark ------------------------------------------------------------------------------------------------------------------


def dump(a: np.ndarray) -> bytes:
    """A vector as bytes behind a mark of their kind: half as many where single precision holds every component exactly."""
    with np.errstate(over="ignore"):
        small = a.astype("<f4")
    return b"f" + small.tobytes() if np.array_equal(small, a) else b"d" + a.astype("<f8").tobytes()


def width_of(blob: bytes) -> int:
    return (len(blob) - 1) // (4 if blob[:1] == b"f" else 8)


def load(blobs: list[bytes]) -> np.ndarray:
    """Vectors of one width in double precision, one a row."""
    kinds = {b[:1] for b in blobs}
    if len(kinds) == 1:
        flat = np.frombuffer(b"".join(b[1:] for b in blobs), "<f4" if kinds == {b"f"} else "<f8")
        return flat.reshape(len(blobs), -1).astype(np.float64)
    return np.stack([np.frombuffer(b[1:], "<f4" if b[:1] == b"f" else "<f8").astype(np.float64) for b in blobs])


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec, width, same): vec is the vector's bytes (``dump``), null where it can link with nothing; ``same`` a key of
    its double-precision bytes."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            blobs, widths, keys = [], [], []
            ids = batch.column("vec_id").to_pylist()
            for i, v in zip(ids, batch.column("vec").to_pylist()):
                blob = None
                if i is not None and v and None not in v:
                    a = np.array(v, np.float64) + 0.0  # no negative zeros
                    norm = np.linalg.norm(a / max(np.abs(a).max(), 1e-300)) if np.isfinite(a).all() else 0.0
                    blob = dump(a) if norm > 0 else None
                blobs.append(blob)
                widths.append(len(v) if blob else None)
                keys.append(xxhash.xxh3_128_digest(a.tobytes()) if blob else None)
            return pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(blobs, pa.binary()), pa.array(widths, pa.int32()), pa.array(keys, pa.binary())], ["vec_id", "vec", "width", "same"]
            )

        return step

    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return by_batch(rows, make, "vec_id long, vec binary, width int, same binary")


def units(blobs: list[bytes]) -> np.ndarray:
    a = load(blobs)
    a = a / np.abs(a).max(axis=1, keepdims=True)
    return a / np.linalg.norm(a, axis=1, keepdims=True)


def _verify(threshold: float):
    """(node, links, low) for the vectors of a cell that link with another: the weight of the partners found here, and the
    least node of what hangs together here."""

    def pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        column = lambda c: table.column(c).to_numpy()
        is_home = column("is_home")
        node, weight, home, unit = column("node"), column("weight"), column("home"), units(table.column("vec").to_pylist())
        h, p = np.flatnonzero(is_home), np.flatnonzero(~is_home)
        if not len(h) or not len(p):
            return (np.zeros(0, np.int64),) * 3
        cell = table.column("cell")[0].as_py()
        near = unit[p] @ unit[h].T >= threshold
        near &= node[p][:, None] != node[h][None, :]
        # a pair counts where the lower node searches, and where the higher one does only if the lower one doesn't come
        # to the higher one's cell
        once = near & (node[p][:, None] < node[h][None, :])
        abroad, back = np.flatnonzero(near.any(axis=1) & (home[p] != cell)), np.flatnonzero(near.any(axis=0))
        if len(abroad):
            # whether the vector at home (column) visits the cell that the one from abroad (row) lives in
            cells, row = np.unique(home[p[abroad]], return_inverse=True)
            lists = table.column("visits").take(pa.array(h[back])).combine_chunks()
            owner = np.repeat(np.arange(len(back)), np.diff(lists.offsets.to_numpy()))
            seen = lists.flatten().to_numpy()
            at = np.minimum(np.searchsorted(cells, seen), len(cells) - 1)
            hit = cells[at] == seen
            comes = np.zeros((len(cells), len(back)), bool)
            comes[at[hit], owner[hit]] = True
            late = near[np.ix_(abroad, back)] & ~once[np.ix_(abroad, back)] & ~comes[row]
            once[np.ix_(abroad, back)] |= late
        links = np.zeros(table.num_rows, np.int64)
        links[p] += once @ weight[h]
        links[h] += once.T @ weight[p]
        # least node of each connected part, by passing the least label along the links until it stays
        big = np.iinfo(np.int64).max
        low_p, low_h = node[p].copy(), node[h].copy()
        rows, cols = np.nonzero(near)
        while len(rows):
            before = low_p.sum(), low_h.sum()
            np.minimum.at(low_h, cols, low_p[rows])
            np.minimum.at(low_p, rows, low_h[cols])
            if before == (low_p.sum(), low_h.sum()):
                break
        low = np.full(table.num_rows, big)
        low[p], low[h] = low_p, low_h
        hit = np.zeros(table.num_rows, bool)
        hit[p], hit[h] = near.any(axis=1), near.any(axis=0)
        return node[hit], links[hit], low[hit]

    def step(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        found = [pairs(table.slice(a, b - a)) for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)], ["node", "links", "low"])

    return step


def index(reps: DataFrame, grids: dict[int, tuple[Grid | None, int]]) -> DataFrame:
    """(node, weight, vec, home, visits): every vector's own cell and the cells that its search visits. ``grids``: of every
    width, its grid and the number of its first cell; without a grid, all vectors of the width are in that one cell."""
    # plain arrays: a broadcast object would need its class on the executors' path
    book = reps.sparkSession.sparkContext.broadcast({w: (g and (g.first, g.second, g.radius), first) for w, (g, first) in grids.items()})

    def make():
        known = {w: (g and Grid(*g), first) for w, (g, first) in book.value.items()}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            blobs = batch.column("vec").to_pylist()
            widths = np.array([width_of(v) for v in blobs])
            home, visits = np.zeros(len(blobs), np.int64), [[]] * len(blobs)
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                g, first = known[width]
                if g is None:
                    home[at] = first
                    cells = [[first]] * len(at)
                else:
                    d1, d2 = g.distances(units([blobs[i] for i in at]))
                    home[at] = first + d1.argmin(1) * len(g.second) + d2.argmin(1)
                    cells = [[first + c for c in g.visit(a, b)] for a, b in zip(d1, d2)]
                for i, c in zip(at, cells):
                    visits[i] = c
            return pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "weight", "vec")), pa.array(home, pa.int64()), pa.array(visits, pa.list_(pa.int64()))],
                ["node", "weight", "vec", "home", "visits"],
            )

        return step

    return by_batch(reps.select("node", "weight", "vec"), make, "node long, weight long, vec binary, home long, visits array<long>")


def true_pairs(reps: DataFrame, grid: Grid, searched: list[tuple[int, bytes]], threshold: float) -> np.ndarray:
    """(searched vector, is a border pair, steps, pairs): how many true neighbours each searched vector (node, vec) has
    among all vectors, by the radius that finds them. Every cosine is taken, in blocks; only counts leave the tasks."""
    book = reps.sparkSession.sparkContext.broadcast(((grid.first, grid.second, grid.radius), searched))

    def make():
        g, own = Grid(*book.value[0]), book.value[1]
        nodes, unit = np.array([n for n, _ in own], np.int64), units([v for _, v in own])
        far, turned_over = g.distances(unit), unit.T.astype(np.float32)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            kinds, counts = [np.zeros((0, 3), np.int64)], [np.zeros(0, np.int64)]
            node, vec = batch.column("node").to_numpy(), batch.column("vec")
            for a in range(0, len(node), 256):
                part = units(vec.slice(a, 256).to_pylist())
                cosine = part.astype(np.float32) @ turned_over
                i, j = np.nonzero((cosine >= threshold - 1e-6) & (node[a : a + 256, None] != nodes))
                if len(i):
                    steps = np.ceil(reach(g.distances(part), far, i, j) / STEP).astype(np.int64)
                    kind, n = np.unique((2 * j + (cosine[i, j] < threshold + BORDER)) << 32 | steps, return_counts=True)
                    kinds.append(np.stack([kind >> 33, kind >> 32 & 1, kind & 0xFFFFFFFF], axis=1))
                    counts.append(n)
            columns = [*np.concatenate(kinds).T, np.concatenate(counts)]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], ["who", "border", "steps", "n"])

        return step

    counts = by_batch(reps.select("node", "vec"), make, "who long, border long, steps long, n long").groupBy("who", "border", "steps").agg(F.sum("n").alias("n"))
    return np.array([tuple(r) for r in counts.collect()], np.int64).reshape(-1, 4)


def fitted(reps: DataFrame, width: int, n: int, threshold: float, recall: float) -> Grid | None:
    """The grid of a width with so many distinct vectors; none where one cell holds them all."""
    if round(np.sqrt(n / PER_CELL)) <= 1:
        return None
    taken = max(1, min(SAMPLE, (64 << 20) // (8 * width)))
    own, by = reps.filter(F.col("width") == width).select("node", "vec", "same"), F.xxhash64("same")
    sample = units([bytes(r["vec"]) for r in own.orderBy(by, "same").limit(taken).select("vec").collect()])
    grid = fit_grid(sample, n, threshold, recall)
    # from the other end of the order, so that code words aren't fitted on them where there are enough others
    last = own.orderBy(by.desc(), F.desc("same")).limit(min(SEARCHED, taken)).select("node", "vec").collect()
    return widened(grid, sample, true_pairs(own, grid, [(r["node"], bytes(r["vec"])) for r in last], threshold), threshold, recall)


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per input row: vec_id, n_links (other rows with a cosine of at least the threshold, as found), component_id
    (smallest id reachable), kept (the id is it).

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and so do rows with a null id
    (they are kept, their component is null). Vectors of several lengths have a grid per length, and link with those of
    their own length only. Rows with one id are vectors of their own. An empty table gives no rows; other columns are ignored. Equal vectors
    are one entry of the index with their number as weight; a crowded cell is compared in blocks by many tasks.
    """
    spark = df.sparkSession
    rows = materialize(vectors(df, id_col, vec_col), "vectors")
    good = rows.filter("width is not null")
    classes = good.groupBy("same").agg(F.min("vec_id").alias("low_id"), F.count("*").alias("weight"), F.first("vec").alias("vec"), F.first("width").alias("width"))
    reps = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    widths = {r["width"]: r["n"] for r in reps.groupBy("width").agg(F.count("*").alias("n")).collect()}
    found = spark.createDataFrame([], "node long, links long, low long")
    if max(widths.values(), default=0) > 1:
        grids, first = {}, 0
        for width, n in sorted(widths.items()):
            grid = fitted(reps, width, n, threshold, recall)
            grids[width] = grid, first
            first += len(grid.first) * len(grid.second) if grid else 1
        placed = materialize(index(reps, grids), "vector-index")
        searches = placed.select("node", "weight", "vec", "home", F.explode("visits").alias("cell"), F.array().cast("array<long>").alias("visits"), F.lit(False).alias("is_home"))
        homes = placed.select("node", "weight", "vec", "home", F.col("home").alias("cell"), "visits", F.lit(True).alias("is_home"))
        crowd = searches.groupBy("cell").agg(F.count("*").alias("search_n")).join(homes.groupBy("cell").agg(F.count("*").alias("home_n")), "cell")
        crowd = crowd.select("cell", F.ceil(F.col("home_n") / CELL_BLOCK).alias("hb"), F.ceil(F.col("search_n") / CELL_BLOCK).alias("sb"))
        crowd = materialize(crowd, "cells")
        block = lambda b: F.pmod(F.xxhash64("node"), F.col(b))
        every = lambda b: F.explode(F.sequence(F.lit(0).cast("long"), F.col(b) - 1))
        dealt_s = searches.join(crowd, "cell").withColumn("h", every("hb")).withColumn("s", block("sb"))
        dealt_h = homes.join(crowd, "cell").withColumn("s", every("sb")).withColumn("h", block("hb"))
        dealt = dealt_s.unionByName(dealt_h).drop("hb", "sb")
        found = materialize(by_group(dealt, ["cell", "h", "s"], lambda: _verify(threshold), "node long, links long, low long"), "vector-links")
    linked = components(found.select(F.col("node").alias("a"), F.col("low").alias("b")), "vector-components")
    low = linked.join(reps.select("node", "low_id"), "node").groupBy("component").agg(F.min("low_id").alias("component_id"))
    label = linked.join(low, "component").select("node", "component_id")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = reps.select("same", "node", "weight", "low_id").join(label, "node", "left").join(links, "node", "left")
    known = known.select("same", F.coalesce("component_id", "low_id").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    known = materialize(known, "vector-labels")
    lone = F.col("width").isNull()
    whole = rows.filter(~lone).select("vec_id", "same").join(known, "same").select("vec_id", "n_links", "component_id")
    bare = rows.filter(lone).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return whole.unionByName(bare).withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))
