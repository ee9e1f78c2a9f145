"""Binary-fuse filters and exact deduplication."""

import hashlib

import numpy as np
import pytest
from fixtures import here, odd_documents, table

from kpimill.llm import exact_dedup as exact_dedup_module
from kpimill.llm.exact_dedup import BinaryFuse, exact_dedup, freeze, group_batch, digests, match, screen


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 60000])
def test_filter_denies_no_key(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, n, dtype=np.uint64)
    f = BinaryFuse.load(BinaryFuse.build(np.append(keys, keys)).dump())
    assert f.may_hold(keys).all()
    other = rng.integers(2**63, 2**64, 200_000, dtype=np.uint64)
    assert f.may_hold(other).mean() < 0.001
    if n == 60000:
        assert len(f.slots) < 1.35 * n


def brute(rows):
    fold = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(fold(t), []).append(d)
    out = []
    for d, t in rows:
        ids = [x for x in groups[fold(t)] if x is not None]
        keep = max(ids, default=None)
        out.append((d, keep, len(groups[fold(t)]), d is not None and d == keep, hashlib.sha256(fold(t).encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_odd_rows(spark, batches):
    df = odd_documents(spark)
    got = exact_dedup(df, batches=batches)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert exact_dedup(df.limit(0), batches=batches).count() == 0


@here
def test_documents(spark):
    df = table(spark, "documents")
    assert sorted(repr(tuple(r)) for r in exact_dedup(df).collect()) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_filters_screen_and_bytes_decide(spark):
    old = spark.createDataFrame([(i, f"old {i}") for i in range(500)], "doc_id long, text string")
    new = spark.createDataFrame([(i, f"old {i}" if i % 5 == 0 else f"new {i}") for i in range(1000, 1500)] + [(9, "OLD 9")], "doc_id long, text string")
    snapshot = freeze(group_batch(digests(old)), keys_per_bucket=64)
    groups = group_batch(digests(new))
    assert screen(groups, snapshot).count() < 20
    assert [(bytes(r.norm), r.keep_id) for r in match(groups, snapshot).collect()] == [(b"old 9", 9)]


def test_what_the_screen_finds_is_what_counts(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"Text {i % 50}") for i in range(200)], "doc_id long, text string")
    found = sorted((r.keep_id, r.group_size) for r in exact_dedup_module.copy_groups(df).collect())
    assert found == [(i, 4) for i in range(150, 200)]
    monkeypatch.setattr(exact_dedup_module, "screen", lambda groups, snapshot: groups.select("digest").limit(0))
    apart = exact_dedup_module.copy_groups(df).collect()
    assert len(apart) > 50 and sum(r.group_size for r in apart) == 200
