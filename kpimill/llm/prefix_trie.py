"""Prefix trie of conversations by a depth-band rollup.

A node is a distinct sequence of first turns, and is called by its depth and its smallest member. Every turn is hashed
together with its depth, so the running sum of these hashes names a sequence; nodes are what groups by it.

Subtree sums go in bands of a fixed number of levels. A node explodes to its ancestors inside its own band only, whose
ids it collects along one of its members. What lies under the last level of the band above (a band root) is then one
number per band root, and the band roots form a tree of their own, that many times less deep: it is rolled up in the same
way, band by band, until one band is left. The finished totals of the band roots go up their own band once more. So a
node explodes to at most one band of ancestors, twice, and the number of rounds grows with the logarithm of the depth.

All of it is DataFrame functions; a long conversation is cut into blocks for its running sums, and numbered by ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpimill.llm.chat import stage_turns
from kpimill.session import materialize

BAND = 8
BLOCK = 1024  # turns that are summed in one window
CHUNK_BITS = 16  # ids of one chunk of a list differ in these bits only


def numbered(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, idx, n, role, text): every turn's place in its conversation, from 1, and how many there are. Null turns come first,
    equal ones in the order of a hash; null roles and texts are empty; rows with a null conversation id are left out."""
    staged = stage_turns(df.filter(F.col(conv_col).isNotNull()), conv_col, turn_col, role_col, text_col)
    pieces = staged.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count("*").alias("k"))
    over = Window.partitionBy("conv_id")
    before = over.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv_id", "part", (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"), F.sum("k").over(over).alias("n"))
    return staged.join(pieces, ["conv_id", "part"]).select(
        "conv_id", (F.col("seq") + F.col("shift")).alias("idx"), "n", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def with_heads(turns: DataFrame, head: Column, base: Column, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the head of another: ((conv_id, d, role, text), (conv_id, n)) of all turns and all conversations.

    ``turns`` is what ``numbered`` gives. Conversation c becomes the first ``head`` (a column of conv_id, at most ``longest``) turns of
    conversation ``base``, all if there are fewer and none if it is absent, and its own turns after the first ``head``.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("n").alias("n"))
    known = sizes.select("conv_id", "n", head.alias("h"), base.alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    known = known.join(bases, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("n_head"), "n")
    known = materialize(known, "conversations")
    first = turns.filter(F.col("idx") <= longest).select(F.col("conv_id").alias("base"), "idx", "role", "text")
    heads = first.join(known, "base").filter("idx <= h").select("conv_id", F.col("idx").alias("d"), "role", "text")
    # the number of head turns differs from the head only where the other conversation is short; only those are looked up
    short = known.filter("n_head < h").select("conv_id", (F.col("h") - F.col("n_head")).alias("less"))
    own = turns.filter(F.col("idx") > head).join(short, "conv_id", "left").select("conv_id", (F.col("idx") - F.coalesce("less", F.lit(0))).alias("d"), "role", "text")
    return heads.unionByName(own), known.select("conv_id", (F.col("n_head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))


def chained(turns: DataFrame) -> DataFrame:
    """(conv_id, d, chars, s1, s2): s names the first d turns of the conversation: the sums of two hashes of each with its depth."""
    x = turns.select(
        "conv_id", "d", F.length("text").alias("chars"), F.expr(f"(d - 1) div {BLOCK}").alias("block"),
        F.xxhash64("d", "role", "text").cast("decimal(20,0)").alias("x1"), F.xxhash64("text", F.lit(1), "role", "d").cast("decimal(20,0)").alias("x2"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    x = materialize(x.select("conv_id", "block", "d", "chars", F.sum("x1").over(inside).alias("s1"), F.sum("x2").over(inside).alias("s2")), "turn-hashes")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # the last sums of every full block
    ends = x.filter(F.col("d") % BLOCK == 0).select("conv_id", F.col("block"), "s1", "s2")
    more = ends.select("conv_id", (F.col("block") + 1).alias("block"), F.sum("s1").over(before).alias("p1"), F.sum("s2").over(before).alias("p2"), "s1", "s2")
    more = more.select("conv_id", "block", (F.col("s1") + F.coalesce("p1", F.lit(0))).alias("o1"), (F.col("s2") + F.coalesce("p2", F.lit(0))).alias("o2"))
    long = x.filter("block > 0").join(more, ["conv_id", "block"]).select("conv_id", "d", "chars", (F.col("s1") + F.col("o1")).alias("s1"), (F.col("s2") + F.col("o2")).alias("s2"))
    kind = "decimal(38,0)"
    both = x.filter("block = 0").select("conv_id", "d", "chars", "s1", "s2").unionByName(long)
    return both.withColumns({"s1": F.col("s1").cast(kind), "s2": F.col("s2").cast(kind)})


def band_paths(members: DataFrame, top: int, band: int) -> DataFrame:
    """(node, d, path): of every node of ``members`` (c, d, node; depths from 1) the nodes on its way, from its band's root to itself."""
    level = members.withColumn("band", F.expr(f"(d - 1) div {band}"))
    roots = members.filter(F.col("d") % band == 0).withColumn("band", F.expr(f"d div {band}"))
    way = Window.partitionBy("c", "band").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = level.withColumn("own", F.lit(True)).unionByName(roots.withColumn("own", F.lit(False))).withColumn("path", F.collect_list("node").over(way))
    path = F.when(F.col("band") == 0, F.concat(F.array(F.lit(top).cast("long")), "path")).otherwise(F.col("path"))
    return rows.filter("own and c = node").select("node", "d", path.alias("path"))


def _up(rows: DataFrame, band: int, values: list[str], with_root: bool) -> DataFrame:
    """(node, d, at_root, values) for the ancestors of each row in its band, itself included."""
    step = F.posexplode("path") if with_root else F.posexplode(F.slice("path", 2, band))
    up = rows.select("d", F.size("path").alias("k"), *values, step.alias("j", "node"))
    depth = F.col("d") - F.col("k") + 1 + F.col("j") + (0 if with_root else 1)
    return up.select("node", depth.alias("d"), *([(F.col("j") == 0).alias("at_root")] if with_root else [F.lit(False).alias("at_root")]), *values)


def subtree_sums(members: DataFrame, own: DataFrame, top: int, depth: int, values: list[str], band: int = BAND) -> DataFrame:
    """(node, d, values): sums over the subtree of every node, itself included, of ``own`` (node, d, values; depths from 1).
    The tree's root (``top``, depth 0) gets the sum of all."""
    sums = [F.sum(v).alias(v) for v in values]
    paths = materialize(band_paths(members, top, band), "paths")
    local = _up(paths.join(own, ["node", "d"]), band, values, True).groupBy("node", "d", "at_root").agg(*sums)
    local = materialize(local, "band-sums")
    inside, under = local.filter("not at_root").drop("at_root"), local.filter("at_root").drop("at_root")
    if depth > band:
        roots = members.filter(F.col("d") % band == 0).withColumn("d", F.expr(f"d div {band}"))
        weights = under.filter("d > 0").withColumn("d", F.expr(f"d div {band}"))
        done = subtree_sums(roots, weights, top, depth // band, values, band)
        done = done.withColumn("d", F.col("d") * band)
        rest = _up(paths.join(done.filter("d > 0"), ["node", "d"]), band, values, False).drop("at_root")
        inside = inside.unionByName(rest)
        under = under.filter("d = 0").unionByName(done.filter("d = 0"))
    else:
        under = under.filter("d = 0")
    return materialize(inside.unionByName(under).groupBy("node", "d").agg(*sums), "subtree-sums")


class Trie:
    """``nodes``: conv_id, depth, parent_conv_id, n_convs, n_ends, n_children, n_leaves, saved_tokens; ``ends``: conv_id, depth, member,
    the members that have no more turns than the node's depth."""

    def __init__(self, nodes: DataFrame, ends: DataFrame):
        self.nodes, self.ends = nodes, ends


NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_ends long, n_children long, n_leaves long, saved_tokens long"


def prefix_trie(turns: DataFrame, conversations: DataFrame, band: int = BAND) -> Trie:
    """The trie of all distinct sequences of first turns, from the root without turns.

    ``turns``: conv_id, d (from 1, without gaps), role, text; ``conversations``: conv_id, n (number of turns, may be 0), once each. A
    node is named by its smallest member and its depth. ``n_leaves`` are childless nodes in its subtree, ``saved_tokens`` the sum
    over its subtree of (members - 1) times the characters of the node's last text. Subtrees include their top. Without a
    conversation there is no node, not even the root.
    """
    spark = turns.sparkSession
    everyone = conversations.agg(F.min("conv_id").alias("top"), F.count("*").alias("n"), F.sum((F.col("n") == 0).cast("long")).alias("bare"), F.max("n").alias("depth")).first()
    none = conversations.filter("n = 0").select(F.lit(everyone["top"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member"))
    if not everyone["n"]:
        return Trie(spark.createDataFrame([], NODES), none)
    top, depth = everyone["top"], everyone["depth"]
    last = conversations.select("conv_id", F.col("n").alias("d"), F.lit(1).cast("long").alias("ends"))
    chain = materialize(chained(turns).join(last, ["conv_id", "d"], "left").fillna(0, ["ends"]), "chain")
    found = chain.groupBy("d", "s1", "s2").agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.sum("ends").alias("n_ends"), F.max("chars").alias("chars")
    )
    found = materialize(found, "nodes")
    members = chain.join(found.select("d", "s1", "s2", "node"), ["d", "s1", "s2"]).select(F.col("conv_id").alias("c"), "d", "node", "ends")
    members = materialize(members, "members")
    own = found.select(
        "node", "d", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"), (F.col("n_convs") == F.col("n_ends")).cast("long").alias("n_leaves")
    )
    sums = subtree_sums(members.drop("ends"), own, top, depth, ["saved_tokens", "n_leaves"], band)
    # the parent is the last but one on the way, which always holds it
    above = band_paths(members.drop("ends"), top, band).select("node", "d", F.element_at("path", -2).alias("parent_conv_id"))
    base = found.select("node", "d", "n_convs", "n_ends").join(above, ["node", "d"])
    base = base.unionByName(spark.createDataFrame([(top, 0, everyone["n"], everyone["bare"], None)], "node long, d long, n_convs long, n_ends long, parent_conv_id long"))
    children = base.filter("d > 0").groupBy(F.col("parent_conv_id").alias("node"), (F.col("d") - 1).alias("d")).agg(F.count("*").alias("n_children"))
    nodes = base.join(sums, ["node", "d"], "left").join(children, ["node", "d"], "left").select(
        F.col("node").alias("conv_id"),
        F.col("d").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_ends",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),  # a root without children is a leaf
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
    )
    ends = members.filter("ends = 1").select(F.col("node").alias("conv_id"), F.col("d").cast("long").alias("depth"), F.col("c").alias("member"))
    return Trie(nodes, ends.unionByName(none))


def list_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256): SHA-256 of the members' ids, ascending, joined by commas.

    Lists are put together in chunks of at most 65,536 neighbouring ids; a SHA-256 cannot be taken in parts, so the chunks of
    one list pass through one task, one after another.
    """
    chunk = F.shiftright("member", CHUNK_BITS).alias("chunk")
    ids = F.transform(F.sort_array(F.collect_list("member")), lambda m: m.cast("string"))
    chunks = ends.groupBy("conv_id", "depth", chunk).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for b in batches:
            out = []
            for conv, depth, ids in zip(*(b.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
                if (conv, depth) == at:
                    digest.update(b"," + ids.encode())
                    continue
                if at is not None:
                    out.append((*at, digest.hexdigest()))
                at, digest = (conv, depth), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["conv_id", "depth", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*at, digest.hexdigest())], ["conv_id", "depth", "ends_sha256"])

    dealt = chunks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "chunk")
    return dealt.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")
