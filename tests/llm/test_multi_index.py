"""Near vectors against all pairs."""

import numpy as np
from fixtures import here, table

from kpimill.llm import multi_index
from kpimill.llm.multi_index import Grid, fit_grid, near_vectors


def brute(rows, width):
    good = [i for i, (d, v) in enumerate(rows) if d is not None and v and len(v) == width and None not in v and np.isfinite(v).all() and any(v)]
    flat = [np.array(rows[i][1], float) / np.abs(rows[i][1]).max() for i in good]  # norms of huge numbers would overflow
    unit = np.array([v / np.linalg.norm(v) for v in flat]).reshape(len(good), -1)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(good))
    changed = True
    while changed:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(good))])
        changed = (new != label).any()
        label = new
    low = {}
    for i, g in enumerate(good):
        low[label[i]] = min(low.get(label[i], rows[g][0]), rows[g][0])
    out = {i: (d, 0, d, True) for i, (d, _) in enumerate(rows)}
    for i, g in enumerate(good):
        c = low[label[i]]
        out[g] = (rows[g][0], int(near[i].sum()), c, rows[g][0] == c)
    return sorted(map(repr, out.values()))


def result(df):
    got = near_vectors(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(repr(tuple(r)) for r in got.collect())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.1, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 0.0]),
        (9, [inf, 0.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (1, [0.0, -0.0, 5.0]), (11, [-0.0, 0.0, 5.0]), (12, [1e-200, 0.0, 0.0]), (13, [1e200, 0.0, 0.0]), (14, [-1.0, 0.0, 0.0]),
    ]
    df = spark.createDataFrame([(d, v, None, d) for d, v in rows], "vec_id long, embedding array<double>, label int, component_id long")
    assert result(df) == brute(rows, 3)
    assert near_vectors(df.limit(0)).count() == 0
    assert result(df.limit(1)) == ["(1, 0, 1, True)"]


def planted(n, width, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width))
    x[n // 2 : n // 2 + 60] = x[7]
    for i in range(n // 4):
        x[i] = x[n - 1 - i % 20] + 0.25 * rng.standard_normal(width)
    return [(int(i), v.astype(np.float32).tolist()) for i, v in zip(rng.permutation(n), x)]


def test_recall_and_blocks(spark, monkeypatch):
    rows = planted(1500, 24)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = [(d, np.array(v, np.float32).astype(float).tolist()) for d, v in rows]
    want = brute(exact, 24)
    links = sum(eval(r)[1] for r in want)
    for block in (2048, 8):
        monkeypatch.setattr(multi_index, "CELL_BLOCK", block)
        got = result(df)
        found = sum(eval(r)[1] for r in got)
        assert 0.97 * links <= found <= links
        assert sum(a == b for a, b in zip(got, want)) >= 0.97 * len(want)


@here
def test_documents(spark):
    df = table(spark, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    width = max(len(v) for _, v in rows if v)
    assert result(df) == brute(rows, width)


def test_traversal_is_by_distance():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = fit_grid(x, 10_000)
    assert isinstance(g, Grid) and g.radius > 0
    d1, d2 = g.distances(x[:50])
    for a, b in zip(d1, d2):
        every = (a[:, None] + b[None, :]).ravel()
        assert g.visit(a, b)[0] == every.argmin()
        assert sorted(g.visit(a, b)) == np.flatnonzero(every <= g.radius).tolist()


def recall_of(spark, x):
    """Share of brute force's links that are found."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = int((unit @ unit.T >= 0.9).sum()) - len(x)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = near_vectors(df).agg({"n_links": "sum"}).first()[0]
    print("links", want, "found", found, "recall", found / want)
    assert want > 1000 and found <= want
    return found / want


def strong_directions(n, width, strong, noise, seed=9):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, strong)) @ rng.standard_normal((strong, width)) + noise * rng.standard_normal((n, width))


def test_recall_on_vectors_of_few_strong_directions(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "PER_CELL", 4)  # 32 words a book
    assert recall_of(spark, strong_directions(4096, 256, 8, 0.3)) >= 0.985
    assert recall_of(spark, strong_directions(4096, 64, 8, 0.3)) >= 0.985


def test_every_width_is_compared(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "PER_CELL", 20)
    rows = planted(600, 24) + [(10_000 + d, v) for d, v in planted(500, 16, seed=4)] + [(20_000, [1.0, 0.0]), (20_001, [1.0, 0.1]), (20_002, [5.0])]
    rows = [(d, np.array(v, np.float32).astype(float).tolist()) for d, v in rows]
    got = result(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = sorted(r for w in (24, 16, 2, 1) for r in brute([x for x in rows if len(x[1]) == w], w))
    assert sum(a == b for a, b in zip(got, want)) >= 0.97 * len(want)
    assert "(20000, 1, 20000, True)" in got and "(20002, 0, 20002, True)" in got
