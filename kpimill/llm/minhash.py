"""Near-duplicates by MinHash: an inverted join over signature coordinates, with every link confirmed on full sets.

Texts with the same shingle set are one class. A class's signature has one minimum per coordinate; the classes are
posted under each (coordinate, value) pair. A pair of classes whose sets are alike agrees in at least ``MATCHES`` of
``COORDINATES`` coordinates (a pair at the threshold is missed with a probability of 3.8e-5), so with every class's
pairs ordered from the rarest to the commonest, two such classes share a pair among the first m - MATCHES + 1 of their m
shared ones: only that prefix is posted, and the commonest pairs, whose lists are long, are skipped. Inside a list the
collisions of whole signatures are counted and pairs at the match threshold kept. What hangs together by such pairs is
brought together once, and its links are confirmed by exact set sizes. Lists and groups of any size are cut into blocks
that meet pairwise, so no task holds one whole, and a tight group yields a tree of links, not all of its pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpimill.llm.base import by_batch, by_group, components, linked_sets, texts_of, with_row
from kpimill.session import materialize

WORDS = 5
THRESHOLD = 75  # hundredths of intersection over union
COORDINATES, MATCHES = 32, 14
LIST_BLOCK = 1024  # classes of a list that are compared in one task, from each of two blocks
GROUP_SHINGLES = 3_000_000  # shingles of a candidate group that are compared in one task, from each of two blocks
KEPT_WORDS = 500_000
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
FOLD = bytes.maketrans(UPPER, LOWER)


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Texts to sorted distinct 64-bit shingle codes. Words are runs of other characters than the six ASCII blanks, with
    A-Z lower-cased; fewer words than a shingle has are one shingle; no words, no shingles."""

    def __init__(self, words: int = WORDS, kept: int = KEPT_WORDS):
        self.n, self.kept = words, kept
        self.codes: dict[bytes, int] = {}
        self.factors = _odd(words, 3)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().translate(FOLD).split()
        if not words:
            return np.zeros(0, np.uint64)
        codes = self.codes
        try:
            w = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
        except KeyError:
            new = {x for x in words if x not in codes}
            if len(codes) + len(new) > self.kept:
                codes.clear()
                new = set(words)
            codes.update((x, xxhash.xxh3_64_intdigest(x)) for x in new)
            w = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
        if len(w) < self.n:
            return mix((w * self.factors[: len(w)]).sum(keepdims=True) + np.uint64(len(w) * 0x9E3779B97F4A7C15 % 2**64))
        last = len(w) - self.n + 1
        total = np.zeros(last, np.uint64)
        for k, f in enumerate(self.factors):
            total += w[k : k + last] * f
        return np.unique(mix(total))


class Signer:
    """Shingle sets to signatures: the least 32-bit hash of the set in every coordinate."""

    def __init__(self, coordinates: int = COORDINATES):
        self.factors, self.shifts = _odd(coordinates, 5), _odd(coordinates, 6)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        best = np.full(len(self.factors), 0xFFFFFFFF, np.uint64)
        for a in range(0, len(codes), 4096):
            part = codes[a : a + 4096, None] * self.factors + self.shifts
            np.minimum(best, (part >> np.uint64(32)).min(axis=0), out=best)
        return best.astype(np.uint32)


def sketches(df: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, set_key, sig): set_key is a 128-bit hash of the whole set; it and sig are null for no shingles."""

    def make():
        shingle, sign = Shingler(words), Signer()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, keys, sigs = [], [], []
            for t in texts_of(batch, "text"):
                codes = shingle(t)
                sizes.append(len(codes))
                keys.append(xxhash.xxh3_128_digest(codes.tobytes()) if len(codes) else None)
                sigs.append(sign(codes).view(np.int32) if len(codes) else None)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))],
                ["doc_id", "n_shingles", "set_key", "sig"],
            )

        return step

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(rows, make, "doc_id long, n_shingles long, set_key binary, sig array<int>")


def in_blocks(df: DataFrame, blocks: Column, member: Column) -> DataFrame:
    """Deal the members of large groups to pairs of blocks (``pair``): any two members of a group meet in some pair.

    A group of one block stays as it is. Of n blocks, each member goes to the n - 1 pairs that its block is in.
    """
    block = F.pmod(F.xxhash64(member), F.col("blocks"))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: j != F.col("block"))
    )
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    return df.withColumn("blocks", blocks.cast("long")).withColumn("block", block).withColumn("other", F.explode(others)).withColumn("pair", pair).drop("block", "other", "blocks")


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _tree(ids: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(labels != np.arange(len(labels)))
    return ids[at], ids[labels[at]]


def _list_edges(matches: int):
    """Trees of the classes in a list that agree in so many coordinates."""

    def step(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        ids = table.column("rep").to_numpy()
        sigs = np.concatenate([c.flatten().to_numpy() for c in table.column("sig").chunks]).reshape(len(ids), -1)
        starts, sizes, out = cuts[:-1], np.diff(cuts), []
        two = starts[sizes == 2]
        if len(two):
            hit = two[(sigs[two] == sigs[two + 1]).sum(axis=1) >= matches]
            out.append((ids[hit], ids[hit + 1]))
        for a, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            part = sigs[a : a + n]
            labels = linked_sets(n, lambda i, part=part: np.flatnonzero((part == part[i]).sum(axis=1) >= matches))
            out.append(_tree(ids[a : a + n], labels))
        return _edges(out)

    return step


def _alike(sets: list[np.ndarray], threshold: int) -> Callable[[int], np.ndarray]:
    """For item i: all items whose intersection with it is at least the threshold's share of the union. Sizes of
    intersections are counted from the items that hold each of its shingles."""
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), sizes)[np.argsort(local, kind="stable")]
    held = np.bincount(local)
    first = np.cumsum(held) - held

    def linked(i: int) -> np.ndarray:
        own = local[starts[i] : ends[i]]
        n = held[own]
        at = np.repeat(first[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(holder[at], minlength=len(sizes))
        return np.flatnonzero(100 * both >= threshold * (sizes + sizes[i] - both))

    return linked


def _group_edges(words: int, threshold: int):
    """Trees of the texts in a group whose sets are alike."""
    shingle = Shingler(words)

    def step(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        ids, texts = table.column("rep").to_numpy(), table.column("text").to_pylist()
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a > 1:
                sets = [shingle(t or "") for t in texts[a:b]]
                there = [i for i, s in enumerate(sets) if len(s)]
                if len(there) > 1:
                    out.append(_tree(ids[a:b][there], linked_sets(len(there), _alike([sets[i] for i in there], threshold))))
        return _edges(out)

    return step


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD, matches: int = MATCHES) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links), kept (the id is it).

    Null and empty texts and texts of blanks have no shingles and no links; their component is their own id. Rows that
    share an id are one document with several texts: each row has its own n_shingles, and what one of them links is
    linked. A row with a null id keeps it, links nothing, and is kept. An empty table gives no rows; other columns of the
    input are ignored.
    """
    made = materialize(sketches(df, id_col, text_col, words), "sketches")
    known = made.filter("set_key is not null and doc_id is not null")
    classes = materialize(known.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    reps = known.join(classes, "set_key").filter("doc_id = rep").groupBy("rep", "set_key").agg(F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
    reps = materialize(reps, "reps")

    # (coordinate, value) pairs that two classes or more share
    pairs = reps.select("rep", "set_key", F.posexplode("sig").alias("c", "v"))
    shared = pairs.groupBy("c", "v").agg(F.count("*").alias("df")).filter("df > 1")
    ordered = pairs.join(shared, ["c", "v"]).groupBy("rep", "set_key").agg(F.sort_array(F.collect_list(F.struct("df", "c", "v"))).alias("own")).filter(F.size("own") >= matches)
    prefix = ordered.select("rep", "set_key", F.explode(F.slice("own", F.lit(1), F.size("own") - matches + 1)).alias("p"))
    # two lists under one hash are compared as one, which changes nothing but the work
    posted = prefix.join(reps.select("set_key", "sig"), "set_key").select("rep", "sig", F.xxhash64("p.c", "p.v").alias("list"), "p.df")
    posted = in_blocks(posted, F.ceil(F.col("df") / LIST_BLOCK), F.col("sig")).drop("df")
    candidates = by_group(posted, ["list", "pair"], lambda: _list_edges(matches), "a long, b long").distinct()
    groups = materialize(components(candidates, "candidates"), "candidate-groups")

    # every candidate class is read once more, with all that may be linked with it
    sized = groups.join(reps.groupBy(F.col("rep").alias("node")).agg(F.sum("n_shingles").alias("n")), "node")
    sizes = sized.groupBy("component").agg(F.sum("n").alias("total"))
    members = materialize(sized.join(sizes, "component").select("node", "component", "total"), "members")
    texts = df.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    # both sides grow with the corpus: always by shuffle, never by broadcast
    brought = texts.hint("merge").join(members, texts["rep"] == members["node"]).select("rep", "text", "component", "total")
    dealt = in_blocks(brought, F.ceil(F.col("total") / GROUP_SHINGLES), F.col("rep")).drop("total")
    links = by_group(dealt, ["component", "pair"], lambda: _group_edges(words, threshold), "a long, b long").distinct()
    linked = components(links, "links").select(F.col("node").alias("rep"), "component")

    label = materialize(classes.join(linked, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component")), "labels")
    rows = made.drop("sig")
    whole = rows.filter("set_key is not null").join(label, "set_key", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
    bare = rows.filter("set_key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    return whole.unionByName(bare).select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component"))).alias("kept"),
    )


def without_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of the documents that stay, all columns as they are: the smallest id of each group of linked documents, and
    rows with a null id. Null and empty texts have no links and stay; rows that share an id stay or go together; an empty table
    gives no rows; other columns may have any names."""
    out = near_duplicates(df, id_col, text_col, words, threshold).filter("not kept").select(F.col("doc_id").alias("id")).distinct()
    return with_row(df, id=F.col(f"`{id_col}`").cast("long")).join(out, "id", "left_anti").select("row.*")
