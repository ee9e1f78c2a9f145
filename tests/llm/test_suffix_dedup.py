"""Repeated passages against a count of every window."""

import hashlib
import random
from collections import Counter

import pytest
from fixtures import here, odd_documents, table

from kpimill.llm import prefix_doubling
from kpimill.llm.prefix_doubling import remove_repeats_by_doubling
from kpimill.llm.suffix_dedup import remove_repeats, without_repeats


def cover(raws, size):
    seen = Counter(r[i : i + size] for r in raws for i in range(len(r) - size + 1))
    out = []
    for r in raws:
        mark = bytearray(len(r))
        for i in range(len(r) - size + 1):
            if seen[r[i : i + size]] > 1:
                mark[i : i + size] = b"\1" * size
        out.append(mark)
    return out


def brute(rows, size):
    raws = [(t or "").encode() for _, t in rows]
    out = []
    for (d, _), r, mark in zip(rows, raws, cover(raws, size)):
        kept = bytes(b for b, m in zip(r, mark) if not m)
        runs = sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))
        out.append(repr((d, len(r), sum(mark), runs, hashlib.sha256(kept).hexdigest())))
    return sorted(out)


def check(df, size, remove=remove_repeats):
    got = remove(df, size=size)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute([(r.doc_id, r.text) for r in df.collect()], size)


BOTH = pytest.mark.parametrize("remove", [remove_repeats, remove_repeats_by_doubling])


@BOTH
@pytest.mark.parametrize("size", [400, 24, 7, 1])
def test_odd_rows(spark, size, remove):
    df = odd_documents(spark)
    check(df, size, remove)
    assert remove(df.limit(0), size=size).count() == 0


@BOTH
def test_passages(spark, remove, monkeypatch):
    monkeypatch.setattr(prefix_doubling, "FIRST", 6)
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [text(n) for n in (30, 31, 32, 33, 50, 120, 400)]
    rows = []
    for i in range(200):
        t = text(rng.randrange(80))
        for _ in range(rng.randrange(3)):
            p = rng.choice(shared)
            a = rng.randrange(len(p) // 2)
            t += p[a : a + rng.randrange(20, 500)] + text(rng.randrange(40))
        rows.append((i, t))
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(2000, "ab" * 300), (2001, "x" * 300), (2002, shared[6] * 2)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 32, remove)
    check(spark.createDataFrame(rows[:60], "doc_id long, text string"), 29, remove)


@here
@BOTH
def test_documents(spark, remove):
    check(table(spark, "documents"), 400, remove)


def test_text_without_repeats(spark):
    passage = "é" * 300
    rows = [(1, "a" + passage + "b", "x"), (2, passage + "!", "y"), (3, None, None), (4, "short", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = without_repeats(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1, "ab", "x"), (2, "!", "y"), (3, None, None), (4, "short", "z")]
