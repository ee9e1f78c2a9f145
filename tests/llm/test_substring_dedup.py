"""Repeated word windows against a count of every window."""

import hashlib
import random

import numpy as np
import pytest
from fixtures import here, odd_documents, table

from kpimill.llm import substring_dedup
from kpimill.llm.substring_dedup import covered, dump_block, load_block, remove_windows


def brute(rows, width):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, w in texts:
        for i in range(len(w) - width + 1):
            if d is not None:
                run = tuple(w[i : i + width])
                least[run] = min(d, least.get(run, d))
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and least[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        spans = [[i, next(j for j in range(i, len(w) + 1) if j not in gone)] for i in sorted(gone) if i - 1 not in gone]
        out.append(repr((d, len(w), len(gone), spans, hashlib.sha256(kept).hexdigest(), kept.decode())))
    return sorted(out)


def check(df, width):
    got = remove_windows(df, width=width, with_text=True)
    assert got.columns == ["doc_id", "n_words", "n_removed", "spans", "kept_sha256", "kept_text"]
    found = sorted(repr((r.doc_id, r.n_words, r.n_removed, [list(s) for s in r.spans], r.kept_sha256, r.kept_text)) for r in got.collect())
    assert found == brute([(r.doc_id, r.text) for r in df.collect()], width)


@pytest.mark.parametrize("width", [13, 3, 1])
def test_odd_rows(spark, width):
    df = odd_documents(spark)
    check(df, width)
    assert remove_windows(df.limit(0), width=width).count() == 0
    assert {r.kept_text for r in remove_windows(df).collect()} == {None}


@pytest.mark.parametrize("stretch", [7, 1 << 20])
def test_passages(spark, monkeypatch, stretch):
    monkeypatch.setattr(substring_dedup, "STRETCH", stretch)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 500)
    rng = random.Random(3)
    words = lambda n: [rng.choice("ab cd e f g ü".split()) for _ in range(n)]
    shared = [words(n) for n in (4, 5, 6, 9, 30)]
    rows = []
    for i in range(120):
        t = words(rng.randrange(12))
        for _ in range(rng.randrange(3)):
            t += rng.choice(shared) + words(rng.randrange(6))
        rows.append((rng.randrange(100), rng.choice([" ", "\n", " \t "]).join(t)))
    rows += [(500 + i, " ".join(shared[4])) for i in range(60)] + [(None, " ".join(shared[4])), (-1, " ".join(shared[3]))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 5)


@here
def test_documents(spark):
    check(table(spark, "documents"), 13)


def test_blocks_and_intervals():
    rng = np.random.default_rng(0)
    hashes, docs = np.sort(rng.integers(0, 2**64, 1000, dtype=np.uint64)), rng.integers(-50, 2**40, 1000)
    h, d = load_block(*dump_block(hashes, docs))
    assert (h == hashes).all() and (d == docs).all()
    assert covered(np.array([0, 2, 9]), 3, 12).tolist() == [[0, 5], [9, 12]]
    assert covered(np.array([], int), 3, 2).tolist() == []
