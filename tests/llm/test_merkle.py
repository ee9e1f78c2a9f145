"""The Merkle manifest against trees built from lists."""

import hashlib
import zlib

import pytest
from fixtures import here, table
from pyspark.sql import functions as F

from kpimill.llm import merkle
from kpimill.llm.merkle import folded, leaf_digest, manifest
from kpimill.llm.merkle_query import op13_merkle

sha = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(level):
    """Root of a list of hashes, and for each the (left, right) siblings on its way."""
    proofs = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for p, i in zip(proofs, at):
            run = runs[i // 3]
            p.append((run[: i % 3], run[i % 3 + 1 :]))
        at = [i // 3 for i in at]
        level = [sha(*r) for r in runs]
    return level[0], proofs


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    leaf = lambda r, text: sha(*map(enc, (*r[:4], text)))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        made[s] = own, *tree([leaf(r, r[4]) for r in own])
    root, tops = tree([made[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        own, subroot, proofs = made[s]
        for r, p in zip(own, proofs):
            steps = p + top
            at = leaf(r, r[4])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                at = leaf(r, r[4].replace("\n", ""))
            for left, right in steps:
                at = sha(*left, at, *right)
            out.append((r[0], leaf(r, r[4]), subroot, root, sha(*(h for left, right in steps for h in left + right)), at, at == root))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, g int, hash string, below string"


def run(spark, path, rows):
    full = [(d, t, la, s, n, 1, "x", None) for d, s, la, n, t in rows]
    spark.createDataFrame(full, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return op13_merkle(spark, str(path))


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_odd_rows(spark, tmp_path, monkeypatch, digits):
    """Nulls in every column, repeated ids and rows, empty and long texts, sources of many sizes, clashing columns."""
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rows = [(i, s, "é", i, "a\nb" if i % 3 else None) for s, n in (("a", 1), ("B", 3), ("é", 4), ("z", 28), ("", 9), (None, 10), ("a b", 82)) for i in range(n)]
    rows += [(None, "z", None, None, "x"), (None, None, None, None, None), (3, "z", "é", 3, "\n" * 9), (3, "z", "é", 3, "\n" * 9), (5, "z", "", 5, ""), (-6, "z", "l", 1, "w\n" * 30000)]
    assert got(run(spark, tmp_path, rows)) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, tmp_path, n):
    rows = [(i, "s", "l", 1, "t\n") for i in range(n)]
    found = got(run(spark, tmp_path, rows))
    assert found == (brute(rows) if n else [])


@here
def test_documents(spark):
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in table(spark, "documents").collect()]
    assert got(op13_merkle(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_proofs_fold_to_the_root(spark):
    df = spark.range(100).select("id", F.concat(F.lit("s"), F.col("id") % 4).alias("s"))
    made = manifest(df, leaf_digest(F.col("id")), F.col("s"), F.col("id"), {"id": F.col("id")})
    assert made.columns == ["group", "leaf", "subroot", "root", "proof", "id"]
    assert made.filter(folded(F.col("leaf"), F.col("proof")) == F.col("root")).count() == 100
    assert made.filter(folded(leaf_digest(F.col("id") + 1), F.col("proof")) == F.col("root")).count() == 0
