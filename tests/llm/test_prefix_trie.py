"""The conversation trie against one made of dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from fixtures import here, table
from pyspark.sql import functions as F

from kpimill.llm import prefix_trie as module
from kpimill.llm.prefix_trie import list_digests, numbered, prefix_trie, with_heads
from kpimill.llm.prefix_trie_query import op12_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(convs):
    """convs: {conv: [(role, text)]}"""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    out = []
    for node, who in members.items():
        under = [m for m in members if m[: len(node)] == node]
        leaf = lambda m: not any(x[:-1] == m for x in members if x)
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in under if m)
        ends = ",".join(str(c) for c in who if len(convs[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((who[0], len(node), parent, len(who), sum(1 for m in under if len(m) == len(node) + 1), sum(map(leaf, under)), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(trie):
    nodes = trie.nodes.join(list_digests(trie.ends), ["conv_id", "depth"], "left").fillna(hashlib.sha256(b"").hexdigest(), ["ends_sha256"])
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=repr)


def rebuild(convs):
    out = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + convs[c][h:]
    return out


def frames(spark, convs):
    turns = [(c, d + 1, r, t) for c, x in convs.items() for d, (r, t) in enumerate(x)]
    return spark.createDataFrame(turns, "conv_id long, d long, role string, text string"), spark.createDataFrame([(c, len(x)) for c, x in convs.items()], "conv_id long, n long")


@pytest.mark.parametrize("band", [2, 3, 8])
def test_trie(spark, monkeypatch, band):
    monkeypatch.setattr(module, "BLOCK", 4)
    monkeypatch.setattr(module, "CHUNK_BITS", 2)
    rng = random.Random(band)
    turn = lambda: (rng.choice("ua"), rng.choice(["x", "yé", "", "zz z"]))
    convs = {c: [turn() for _ in range(rng.randrange(5))] for c in range(60)}
    deep = [turn() for _ in range(41)]
    for c in range(60, 80):
        convs[c] = deep[: rng.choice([5, 9, 16, 17, 40, 41])] + [turn() for _ in range(rng.randrange(3))]
    convs |= {c: [("u", "x")] for c in range(100, 140)} | {-5: []}
    assert rows_of(prefix_trie(*frames(spark, convs), band)) == brute(convs)


def test_small_tries(spark):
    assert rows_of(prefix_trie(*frames(spark, {}))) == []
    for convs in ({7: []}, {7: [], 3: []}, {7: [("", "")]}):
        assert rows_of(prefix_trie(*frames(spark, convs))) == brute(convs)


def test_odd_rows(spark, tmp_path):
    """Nulls in every column, equal and repeated turns, heads that are short or absent, and a clashing column."""
    rows = [(100, 0, "u", "a", 1), (100, 1, "s", "b", 1), (100, 2, "u", "c", 1)]
    for c in range(101, 140):
        rows += [(c, None, None, f"n{c % 3}", 1), (c, 5, "s", None, None), (c, 6, "u", "é" * 50000, 1), (c, 9, "u", "z", 1), (c, 9, "u", "z", 1)]
    rows += [(c, 1, "u", "short", 1) for c in range(240, 260)] + [(None, 1, "u", "nobody", 1)]
    rows += [(300, 1, "u", "one", 1)] + [(c, t, "u", str(t), 1) for c in range(301, 320) for t in range(8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = op12_prefix_trie(spark, str(tmp_path))
    assert got.columns == [c for c in COLUMNS] and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    convs = defaultdict(list)
    for c, t, r, x, _ in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1])):
        if c is not None:
            convs[c].append((r or "", x or ""))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rebuild(convs))
    empty = numbered(df.limit(0))
    assert prefix_trie(*with_heads(empty, F.lit(1), F.col("conv_id"), 1)).nodes.count() == 0


@here
def test_conversations(spark):
    convs = defaultdict(list)
    for r in table(spark, "conversations").orderBy("conv_id", F.col("turn").asc_nulls_first()).collect():
        convs[r["conv_id"]].append((r["role"] or "", r["text"] or ""))
    got = op12_prefix_trie(spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=repr) == brute(rebuild(convs))
