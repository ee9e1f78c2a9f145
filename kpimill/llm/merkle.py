"""Merkle manifest of a dataset by a nested-struct rollup.

Leaves are numbered inside their group, and a leaf's number in base three says where it is in the tree. Blocks of 3**6
leaves are rolled up by grouping the digits away one after another, lowest first: every step nests the (up to three)
children in a struct array and hashes them. All steps of a block run on one shuffle, by the block. The roots of blocks are
the leaves of the next blocks, up to one root for each group; those roots are the leaves of one last tree over the groups.

Proofs come down the same way. A block, still nested, gets the proof of its own root by a union that is grouped on the
block (no join, and null groups need no care); transforms then walk down the nested structs and collect the siblings on
the way, and an explode gives one row per leaf. A block never holds more than 729 leaves, whatever the size of its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpimill.session import materialize

FAN = 3
DIGITS = 6  # of a block
STEP = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its UTF-8 bytes after their number, ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """The leaf of a row: lowercase hex SHA-256 of its values."""
    return digest(*map(field, values))


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and a proof (steps from the leaf up, each with the digests left and right of it) lead to."""
    return F.aggregate(proof, start, lambda at, step: digest(step["left"], at, step["right"]))


def siblings(proof: Column) -> Column:
    """All siblings of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """The rows with ``rank`` (place in their group, from 0) and ``n`` (rows of the group). Rows are dealt by ranges, so a group
    may span many of them."""
    dealt = df.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order).withColumn("__seq", F.monotonically_increasing_id())
    rows = materialize(dealt, name)
    part = F.shiftright("__seq", 33).alias("__part")
    pieces = rows.groupBy(*groups, part).agg(F.min("__seq").alias("__first"), F.count("*").alias("__k"))
    over = Window.partitionBy(*groups)
    before = over.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__k").over(before), F.lit(0)) - F.col("__first")
    pieces = pieces.select(F.struct(*groups, "__part").alias("__piece"), shift.alias("__shift"), F.sum("__k").over(over).alias("n"))
    # a struct of the keys is never null, so null groups find their pieces too
    keyed = rows.withColumn("__piece", F.struct(*groups, part)).join(pieces, "__piece")
    return keyed.withColumn("rank", F.col("__seq") + F.col("__shift")).drop("__seq", "__piece", "__shift")


def rolled(nodes: DataFrame, group: str) -> DataFrame:
    """(group, block, n, hash, kids): the blocks of nodes (group, rank, n, hash, below), rolled up to one hash each. ``kids`` nests
    (digit, hash, below) once per digit."""
    digit = lambda j: F.expr(f"rank div {FAN**j}") % FAN
    block = F.expr(f"rank div {FAN**DIGITS}")
    df = nodes.select(group, block.alias("block"), "n", *(digit(j).cast("int").alias(f"d{j}") for j in range(DIGITS)), "hash", "below")
    df = df.repartition(group, "block")
    for j in range(DIGITS):
        higher = [f"d{i}" for i in range(j + 1, DIGITS)]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{j}").alias("digit"), "hash", "below")))
        df = df.groupBy(group, "block", "n", *higher).agg(kids.alias("kids"))
        # while a group has several nodes, every run is hashed, runs of one too
        up = F.when(F.col("n") > FAN**j, F.sha2(F.array_join(F.transform("kids", lambda k: k["hash"]), ""), 256)).otherwise(F.col("kids")[0]["hash"])
        df = df.select(group, "block", "n", *higher, up.alias("hash"), F.col("kids").alias("below"))
    return df.withColumnRenamed("below", "kids")


def unrolled(kids: Column, n: Column, proof: Column, j: int) -> Column:
    """The leaves under a block as an array of (below, hash, proof); ``j`` is the digit of ``kids``."""
    joined = lambda part: F.array_join(F.transform(part, lambda k: k["hash"]), "")

    def one(kid: Column, i: Column) -> Column:
        step = F.struct(joined(F.slice(kids, F.lit(1), i)).alias("left"), joined(F.slice(kids, i + 2, F.lit(FAN))).alias("right"))
        steps = F.when(n > FAN**j, F.concat(F.array(step), proof)).otherwise(proof)
        if j:
            return unrolled(kid["below"], n, steps, j - 1)
        return F.array(F.struct(kid["below"].alias("below"), kid["hash"].alias("hash"), steps.alias("proof")))

    return F.flatten(F.transform(kids, one))


def opened(blocks: DataFrame, above: DataFrame, group: str) -> DataFrame:
    """(group, below, hash, proof, subroot, root) of the nodes under blocks, given (group, block, proof, subroot, root) of the blocks."""
    nothing = lambda like, *names: [F.lit(None).cast(like.schema[c].dataType).alias(c) for c in names]
    both = blocks.select(group, "block", "n", "kids", *nothing(above, "proof", "subroot", "root")).unionByName(
        above.select(group, "block", *nothing(blocks, "n", "kids"), "proof", "subroot", "root")
    )
    met = both.groupBy(group, "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "proof", "subroot", "root")))
    each = met.select(group, "subroot", "root", F.explode(unrolled(F.col("kids"), F.col("n"), F.col("proof"), DIGITS - 1)).alias("leaf"))
    return each.select(group, "leaf.below", "leaf.hash", "leaf.proof", "subroot", "root")


def manifest(df: DataFrame, leaf: Column, group: Column, order: Column, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: group, leaf, subroot, root, proof, and the carried columns.

    Leaves of a group are ordered by ``order`` (nulls first; rows that tie, by their leaf). While a group has several nodes,
    every three neighbours (the last run may be shorter) become the hash of their hashes; what remains is its subroot, a
    lone leaf itself. Subroots, ordered by group (null first, by bytes), lead to the root in the same way. ``proof`` lists the steps
    from the leaf to the root, each with the joined digests left and right. Null groups are one group; an empty table
    gives no rows; other columns are ignored.
    """
    spark, carry = df.sparkSession, carry or {}
    carried = F.struct(*(c.alias(k) for k, c in carry.items())) if carry else F.struct(F.lit(1).alias("none"))
    leaves = numbered(df.select(group.alias("g"), order.alias("o"), leaf.alias("hash"), carried.alias("below")), ["g"], ["o", "hash"], "leaves")
    out = ["group", "leaf", "subroot", "root", "proof", *carry]
    nodes = materialize(leaves.select("g", "rank", "n", "hash", "below"), "ranked")
    most = nodes.agg(F.max("n")).first()[0]
    if most is None:
        kinds = {f.name: f.dataType for f in df.select(group.alias("group"), leaf.alias("leaf"), *(c.alias(k) for k, c in carry.items())).schema}
        empty = df.select(group.alias("group"), leaf.alias("leaf")).limit(0)
        return empty.select("group", "leaf", F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"), F.lit(None).cast(STEP).alias("proof"), *(F.lit(None).cast(kinds[k]).alias(k) for k in carry))

    def levels(nodes: DataFrame, most: int) -> list[DataFrame]:
        """Blocks of every level, the last one with a single block for each group."""
        made = []
        while True:
            made.append(materialize(rolled(nodes, "g"), "blocks"))
            if most <= FAN**DIGITS:
                return made
            most = -(-most // FAN**DIGITS)
            nodes = made[-1].select("g", F.col("block").alias("rank"), F.ceil(F.col("n") / FAN**DIGITS).alias("n"), "hash", F.struct("block").alias("below"))

    def down(made: list[DataFrame], above: DataFrame) -> DataFrame:
        """Nodes of the lowest level under the proofs of the top blocks."""
        for k, blocks in reversed(list(enumerate(made))):
            above = opened(blocks, above, "g")
            if k:
                above = above.select("g", F.col("below.block").alias("block"), "proof", "subroot", "root")
        return above

    own = levels(nodes, most)
    tops = own[-1].select(F.lit(0).alias("g"), F.col("g").alias("s"), "hash")
    tops = materialize(numbered(tops, ["g"], ["s"], "subroots").select("g", "rank", "n", "hash", F.struct("s", F.col("hash").alias("subroot")).alias("below")), "subroot-ranks")
    outer = levels(tops, tops.count())
    no_steps = F.array().cast(STEP)
    crown = outer[-1].select("g", "block", no_steps.alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    groups = down(outer, crown).select(F.col("below.s").alias("g"), F.lit(0).cast("long").alias("block"), "proof", F.col("below.subroot").alias("subroot"), "root")
    return down(own, groups).select(F.col("g").alias("group"), F.col("hash").alias("leaf"), "subroot", "root", "proof", *(F.col("below")[k].alias(k) for k in carry)).select(*out)
