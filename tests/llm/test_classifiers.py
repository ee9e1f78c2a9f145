"""Toxicity and quality: held-out accuracy on the labelled documents, gradients, odd rows."""

import math
import zlib

import numpy as np
import pytest
from fixtures import SF, odd_documents
from pyspark.sql import functions as F

from kpimill.llm import quality, toxicity
from kpimill.llm.labelled import fold, training_rows
from kpimill.llm.toxicity import Network, Scorer, windows_of

LARGE = SF.replace("0.001", "0.1")


def test_fold_is_crc32(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 17, 99999, -5)] + [(None,)], "doc_id long")
    got = {r.doc_id: r.f for r in df.select("doc_id", fold("doc_id", 5).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 if i is not None else None for i in got}


def test_training_rows_are_bounded_and_weighted(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(100)] + [(500, 1), (None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    rows = training_rows(docs, labels, "toxic", F.col("doc_id") < 90, 20).collect()
    assert sum(r.y for r in rows) == 9 and len(rows) == 29
    assert {(r.y, round(r.weight, 3)) for r in rows} == {(1, 1.0), (0, 81 / 20)}
    assert training_rows(docs, labels.limit(0), "toxic", F.lit(True), 20).count() == 0


def test_windows_cover_and_overlap():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        wins = windows_of(n)
        assert wins[0][0] == 0 and wins[-1][1] == n
        assert all(b <= n and b - a == min(n, 32) for a, b in wins)
        assert all(y < b for (_, b), (y, _) in zip(wins, wins[1:]))


def test_passages_of_half_a_window_are_whole_in_one():
    for n in (40, 57, 500):
        wins = windows_of(n)
        assert all(any(a <= at and at + 17 <= b for a, b in wins) for at in range(n - 16))


def test_stretches_without_blanks_are_cut_into_pieces():
    text = "".join(chr(0x4E00 + i % 3000) for i in range(2500))
    words = toxicity.words_of(text)
    assert max(map(len, words)) <= toxicity.LONGEST
    assert all(any(text[at : at + 9] in w for w in words[max(0, at // 8 - 2) : at // 8 + 2]) for at in range(len(text) - 8))
    assert len(Scorer(Network([], seed=2)).windows([text])[0]) > 10
    assert toxicity.words_of("Donaudampfschifffahrt, a") == ["donaudampfschifffahrt", "a"]


def test_gradients():
    net = Network(["ab", "cd"], seed=1)
    for part in (net.p, net.p["char"], net.p["word"]):
        for k, v in part.items():
            if not isinstance(v, dict):
                part[k] = v.astype(np.float64)
    net.char.p, net.word.p = net.p["char"], net.p["word"]
    windows, y = [["ab", "xyz", "q"], ["cd"], [], ["hello", "ab", "ab", "cdcdcdcdcd"]], np.array([1.0, 0.0, 1.0, 0.0])
    _, g = net.gradients(windows, y)
    rng = np.random.default_rng(0)
    for group in ("char", "word", None):
        params, grads = (net.p[group], g[group]) if group else (net.p, g)
        for name in params:
            if isinstance(params[name], dict) or name == "scale":
                continue
            flat, slope = params[name].reshape(-1), grads[name].reshape(-1)
            for i in rng.choice(np.flatnonzero(slope) if slope.any() else np.arange(len(flat)), 3):
                if group is None and name == "embed" and i < 6:
                    continue
                keep, eps = flat[i], 1e-3
                flat[i] = keep + eps
                up, _ = net.gradients(windows, y)
                flat[i] = keep - eps
                down, _ = net.gradients(windows, y)
                flat[i] = keep
                assert (up - down) / (2 * eps) == pytest.approx(slope[i], rel=0.05, abs=2e-4), (group, name, i)


def test_scores_do_not_depend_on_caches_or_batches():
    net = Network(["idiot"], seed=2)
    texts = ["", "one two", "Idiot! " * 90, "a b c " * 40, "x" * 3000, "word " * 33, "q"]
    whole = Scorer(net).highest(texts)
    assert np.allclose(Scorer(net, bound=2).highest(texts, words_at_once=1), whole, atol=1e-5)
    assert np.allclose([Scorer(net).highest([t])[0] for t in texts], whole, atol=1e-5)


def accuracy(rows, cut):
    return np.mean([(r.score >= cut) == (r.y == 1) for r in rows])


@pytest.mark.skipif(not __import__("os").path.isdir(LARGE), reason="test tables are not here")
def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{LARGE}/{t}.parquet") for t in ("documents", "labels"))
    net = toxicity.fit(docs, labels, "toxic", fold("doc_id", 5) != 0)
    held = docs.join(labels.filter(fold("doc_id", 5) == 0).select("doc_id", F.col("toxic").alias("y")), "doc_id")
    rows = toxicity.score(held.select("doc_id", "text"), net).join(held.select("doc_id", "y"), "doc_id").collect()
    # some 350 toxic texts to learn from, copies included; over 0.99 and 0.99 with the 1,500 of larger tables
    assert accuracy(rows, 0.5) > 0.95
    assert np.mean([r.score >= 0.5 for r in rows if r.y == 1]) > 0.8
    odd = odd_documents(spark).withColumn("score", F.lit("x"))
    got = toxicity.score(odd, net).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.without_toxic(odd, net).columns == odd.columns
    assert toxicity.score(odd.limit(0), net).count() == 0


@pytest.mark.skipif(not __import__("os").path.isdir(LARGE), reason="test tables are not here")
def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{LARGE}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels, "quality", fold("doc_id", 4) != 2)
    held = docs.join(labels.filter(fold("doc_id", 4) == 2).select("doc_id", F.col("quality").alias("y")), "doc_id")
    rows = quality.score(held.select("doc_id", "text"), model).join(held.select("doc_id", "y"), "doc_id").collect()
    assert accuracy(rows, 0.7) > 0.97
    odd = odd_documents(spark).withColumn("score", F.lit("x"))
    got = quality.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score(odd.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {round(r.score, 3) for r in quality.score(docs, quality.fit(docs, labels, "quality", F.lit(True))).collect()} == {0.5}
    assert len(toxicity.without_toxic(docs, toxicity.fit(docs, labels, "toxic", F.lit(True))).collect()) == docs.count()


def plain_gru(p, states, inputs):
    """One layer, one sequence, one step and one number after another."""
    out = []
    for d in "fb":
        h, seen = [0.0] * states, {}
        order = range(len(inputs)) if d == "f" else range(len(inputs) - 1, -1, -1)
        for t in order:
            x = [sum(float(v) * float(p[f"W{d}"][i, j]) for i, v in enumerate(inputs[t])) + float(p[f"c{d}"][j]) for j in range(3 * states)]
            u = [sum(h[i] * float(p[f"U{d}"][i, j]) for i in range(states)) for j in range(3 * states)]
            sig = lambda v: 1 / (1 + math.exp(-v))
            z = [sig(x[j] + u[j]) for j in range(states)]
            r = [sig(x[states + j] + u[states + j]) for j in range(states)]
            n = [math.tanh(x[2 * states + j] + r[j] * u[2 * states + j]) for j in range(states)]
            h = seen[t] = [(1 - z[j]) * n[j] + z[j] * h[j] for j in range(states)]
        out.append(seen)
    both = [out[0][t] + out[1][t] for t in range(len(inputs))]
    score = []
    for s in both:
        inner = [math.tanh(sum(s[i] * float(p["A"][i, k]) for i in range(2 * states))) for k in range(len(p["a"]))]
        score.append(math.exp(max(-20.0, min(20.0, sum(v * float(a) for v, a in zip(inner, p["a"]))))))
    return [sum(w * s[i] for w, s in zip(score, both)) / sum(score) for i in range(2 * states)]


def plain_score(net, text):
    """The highest probability of all windows, each read word by word, each word character by character."""
    p, words, best = net.p, toxicity.words_of(text), -math.inf
    vectors = []
    for w in words:
        chars = [p["chars"][c] for c in toxicity.char_codes(w)]
        pooled = plain_gru(p["char"], toxicity.CHAR_STATES, chars) if chars else [0.0] * (2 * toxicity.CHAR_STATES)
        vectors.append(pooled + [float(v) for v in p["embed"][net.words.get(w, 0)]])
    last = max(0, len(words) - toxicity.WINDOW)
    for start in {*range(0, last, toxicity.STRIDE), last}:
        window = vectors[start : start + toxicity.WINDOW] or [[0.0] * (2 * toxicity.CHAR_STATES + toxicity.WORD_SIZE)]
        pooled = plain_gru(p["word"], toxicity.WORD_STATES, window)
        best = max(best, sum(a * float(b) for a, b in zip(pooled, p["out"])) + float(p["bias"][0]))
    return 1 / (1 + math.exp(-(float(p["scale"][0]) * best + float(p["scale"][1]))))


def test_toxicity_step_by_step(spark):
    """The whole query path against a restatement without vectors, batches or caches."""
    net = Network(["idiot", "the", "word"], seed=4)
    net.p["embed"][1:] += 1
    rng = np.random.default_rng(3)
    texts = [None, "", "Idiot!", "the idiot, ...", " ".join(rng.choice(["the", "Idiot", "xY", "ünï", "…", "abcdefghij"], 70)), "x" * 61 + " y", "word " * 33]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, net).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_score(net, t or ""), abs=1e-5), t


def test_quality_against_a_dictionary(spark):
    """Scores against a dictionary of n-grams: counts, weights and the sum, one at a time."""
    texts = [None, "", "a", "The cat sat on 12 mats, THE cat cat cat.", "http://x.y z z", *(" ".join(["lorem", "ipsum", "X9"][i % 3] for i in range(n)) for n in (2, 7, 40))]
    y = np.array([0, 0, 1, 1, 0, 1, 0, 1.0])
    bits = 12
    model = quality.train([t or "" for t in texts], y, np.ones(len(y)), bits)
    one = 2**64
    hashed = quality._hash

    def grams(text):
        words = text.split()
        plain = [hashed(w.lower()) for w in words]
        shapes = [(hashed(quality.shape(w) + "\0") + (12345 if i and plain[i] == plain[i - 1] else 0)) % one for i, w in enumerate(words)]
        yield from plain
        yield from ((s + 1) % one for s in shapes)
        for k, stream in enumerate((plain, shapes)):
            for a, b in zip(stream, stream[1:]):
                yield (a * 0xD6E8FEB86659FD93 + b * 0xA0761D6478BD642F + k + 2) % one

    place = lambda g: ((g ^ g >> 29) * int(quality._M) % one) >> (64 - bits)
    weight = dict(enumerate(map(float, model[0])))
    got = {r.doc_id: r.score for r in quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, bits=bits).collect()}
    for i, t in enumerate(texts):
        found = list(grams(t or ""))
        total = sum(weight[place(g)] for g in found) * quality.GAIN / max(1.0, len(found) / 4) + model[1]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9), t
