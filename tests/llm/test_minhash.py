"""Near-duplicates against all pairs of full sets; helpers for linked sets and components."""

import random

import numpy as np
import pytest
from fixtures import here, odd_documents, table

from kpimill.llm import minhash
from kpimill.llm.base import components, linked_sets


def test_linked_sets_are_all_links():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        near = rng.random((n, n)) < rng.choice([0.02, 0.05, 0.2, 0.9])
        near |= near.T
        label = np.arange(n)
        for _ in range(n):
            for i in range(n):
                label[i] = min([label[i], *label[near[i]]])
        got = linked_sets(n, lambda i: np.flatnonzero(near[i]))
        assert got.tolist() == label.tolist()


def test_a_tight_group_needs_few_looks():
    looks = []
    linked_sets(5000, lambda i: (looks.append(i), np.arange(5000))[1])
    assert len(looks) == 1


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, x) for x in range(2001, 2100)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e if x is not None}
    for _ in range(70):
        for a, b in edges:
            if a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
    assert got == {x: y for x, y in label.items() if any(x in e and e[0] != e[1] and None not in e for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in t.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = {d: d for d, _ in rows if d is not None}
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    links = set()
    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        both = {}
        for x in s:
            for j in holders[x]:
                if j < i and rows[j][0] is not None:
                    both[j] = both.get(j, 0) + 1
        links |= {(rows[i][0], rows[j][0]) for j, n in both.items() if 100 * n >= 75 * (len(s) + len(sets[j]) - n)}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted(repr((d, len(s), label.get(d), d is None or label[d] == d)) for (d, _), s in zip(rows, sets))


def check(df):
    got = minhash.near_duplicates(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_odd_rows(spark):
    df = odd_documents(spark)
    check(df)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


@here
def test_documents(spark):
    check(table(spark, "documents"))


def varied(n, seed=2):
    """A tight group, a chain of texts each near the next, and strangers that share a passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(120)], [word() for _ in range(30)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(3)):
            t[rng.randrange(len(t))] = word()
        out.append(" ".join(t))
    chain = [word() for _ in range(100)]
    for _ in range(n // 2):
        at = rng.randrange(90)
        chain = chain[:at] + [word() for _ in range(3)] + chain[at + 3 :]
        out.append(" ".join(chain))
    out += [" ".join([word() for _ in range(rng.randrange(5, 60))] + passage + [word() for _ in range(5)]) for _ in range(n)]
    rng.shuffle(out)
    return list(enumerate(out))


def test_groups_lists_and_blocks(spark, monkeypatch):
    df = spark.createDataFrame(varied(120), "doc_id long, text string")
    check(df)
    monkeypatch.setattr(minhash, "LIST_BLOCK", 16)
    monkeypatch.setattr(minhash, "GROUP_SHINGLES", 2000)
    check(df)
