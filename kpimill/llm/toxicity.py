"""Toxicity: a bidirectional gated recurrent network with attention pooling, over characters and over words, in numpy.

A word is read by a character network (recurrent in both directions, its states pooled by attention); its pooled vector
and an embedding of the word itself are the input of a word network of the same form, which reads windows of words. A
text's score is that of its highest window; windows that overlap by half are scored over the whole text. Training learns from
labels of whole texts: windows are picked by the model as it stands, and the first picks come from word statistics.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpimill.llm.base import by_batch, forget, kept, row_schema, row_texts, texts_of, with_row
from kpimill.llm.labelled import training_rows

WINDOW, STRIDE = 32, 16  # words; a passage of up to 17 words is whole in one window
CHAR_STATES, WORD_STATES, CHAR_SIZE, WORD_SIZE, ATTENTION = 10, 8, 8, 6, 6
CHARS = 512
VOCABULARY = 8192
PER_CLASS = 1500
ROUNDS, STEPS_PER_ROUND, BATCH = 3, 110, 96
LONGEST, PIECE, PIECE_STRIDE = 24, 16, 8  # characters; a passage of up to 9 is whole in one piece of a longer word
KEPT_WORDS = 400_000
HIDDEN = 0.5  # share of word embeddings hidden in a training step
EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»¿¡„“”’…–—"


def normal(word: str) -> str:
    """Lower-cased, without punctuation at the ends; a word of punctuation only stays as it is."""
    low = word.lower()
    low = low.strip(EDGE) or low
    return word if low == word else low  # one object for both where they are equal


def split(text: str) -> list[str]:
    """The words of a text as they stand; words longer than ``LONGEST``, such as stretches without blanks, are cut into
    overlapping pieces, each a word of its own."""
    words = text.split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    out = []
    for w in words:
        if len(w) <= LONGEST:
            out.append(w)
        else:
            out += [w[s : s + PIECE] for s in (*range(0, len(w) - PIECE, PIECE_STRIDE), len(w) - PIECE)]
    return out


def words_of(text: str) -> list[str]:
    return list(map(normal, split(text)))


def char_codes(word: str) -> list[int]:
    """Characters as places of the character table; those beyond its direct part share the last 128 places."""
    return [c if c < CHARS - 128 else CHARS - 128 + c % 128 for c in map(ord, word)]


def windows_of(n: int) -> list[tuple[int, int]]:
    """All windows over n words: they overlap, and the last one ends with the text."""
    if n <= WINDOW:
        return [(0, n)]
    starts = list(range(0, n - WINDOW, STRIDE)) + [n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGru:
    """Bidirectional gated recurrent layer with attention pooling: (time, batch, inputs) to (batch, 2 * states)."""

    def __init__(self, inputs: int, states: int, attention: int, rng=None, params: dict | None = None):
        self.h = states
        if params is None:
            normal = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
            params = {"A": normal(2 * states, attention), "a": normal(attention)}
            for d in "fb":
                params |= {f"W{d}": normal(inputs, 3 * states), f"U{d}": normal(states, 3 * states), f"c{d}": np.zeros(3 * states, np.float32)}
        self.p = params

    def project(self, x: np.ndarray, d: str) -> np.ndarray:
        return x @ self.p[f"W{d}"] + self.p[f"c{d}"]

    def run(self, projected, mask, d: str, keep: list | None = None) -> np.ndarray:
        """States of one direction in the order of time. ``projected(t)`` gives the input part of step t; a step that the
        mask leaves out keeps the state; ``mask`` None: no step is left out."""
        h_size, u = self.h, self.p[f"U{d}"]
        steps = len(mask) if mask is not None else self.steps
        out: list = [None] * steps
        h = None
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            px = projected(t)
            if h is None:
                h = np.zeros((len(px), h_size), np.float32)
            g = h @ u
            zr = sigmoid(px[:, : 2 * h_size] + g[:, : 2 * h_size])
            z, r = zr[:, :h_size], zr[:, h_size:]
            gn = g[:, 2 * h_size :]
            n = np.tanh(px[:, 2 * h_size :] + r * gn)
            new = n + z * (h - n)
            if mask is not None:
                m = mask[t][:, None]
                new = m * new + (1 - m) * h
            if keep is not None:
                keep.append((t, h, z, r, n, gn))
            h = out[t] = new
        return np.stack(out)

    def pool(self, states: np.ndarray, mask) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = np.tanh(states @ self.p["A"])
        e = np.exp(np.clip(inner @ self.p["a"], -20, 20))
        if mask is not None:
            e = e * mask
        weight = e / np.maximum(e.sum(0), 1e-9)
        return np.einsum("tb,tbh->bh", weight, states), weight, inner

    def forward(self, x: np.ndarray, mask: np.ndarray):
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.run((lambda t, q=self.project(x, d): q[t]), mask, d, kept[d]) for d in "fb"], axis=2)
        pooled, weight, inner = self.pool(states, mask)
        return pooled, (x, mask, kept, states, weight, inner, pooled)

    def backward(self, d_pooled: np.ndarray, cache, grads: dict) -> np.ndarray:
        x, mask, kept, states, weight, inner, pooled = cache
        h, p = self.h, self.p
        d_states = weight[:, :, None] * d_pooled
        d_score = weight * (np.einsum("tbh,bh->tb", states, d_pooled) - (pooled * d_pooled).sum(1))
        d_inner = d_score[:, :, None] * p["a"] * (1 - inner**2)
        grads["a"] += np.einsum("tb,tba->a", d_score, inner)
        grads["A"] += np.einsum("tbh,tba->ha", states, d_inner)
        d_states += d_inner @ p["A"].T
        d_x = np.zeros_like(x)
        for i, d in enumerate("fb"):
            d_h = np.zeros_like(states[0, :, :h])
            u, w = p[f"U{d}"], p[f"W{d}"]
            for t, before, z, r, n, gn in reversed(kept[d]):
                d_h = d_h + d_states[t, :, i * h : (i + 1) * h]
                m = mask[t][:, None]
                d_new, d_before = d_h * m, d_h * (1 - m)
                d_n = d_new * (1 - z) * (1 - n * n)
                d_z = d_new * (before - n) * z * (1 - z)
                d_r = d_n * gn * r * (1 - r)
                d_px = np.concatenate([d_z, d_r, d_n], axis=1)
                d_g = np.concatenate([d_z, d_r, d_n * r], axis=1)
                grads[f"U{d}"] += before.T @ d_g
                grads[f"W{d}"] += x[t].T @ d_px
                grads[f"c{d}"] += d_px.sum(0)
                d_x[t] += d_px @ w.T
                d_h = d_before + d_new * z + d_g @ u.T
        return d_x


class Network:
    """Parameters, training and scoring. ``words``: the words with an embedding of their own; place 0 is for all others."""

    def __init__(self, words: list[str], seed: int = 11, params: dict | None = None):
        self.words = {w: i + 1 for i, w in enumerate(words)}
        rng = np.random.default_rng(seed)
        small = lambda *s: (0.3 * rng.standard_normal(s)).astype(np.float32)
        if params is None:
            params = {"chars": small(CHARS, CHAR_SIZE), "embed": small(len(words) + 1, WORD_SIZE), "out": small(2 * WORD_STATES), "bias": np.zeros(1, np.float32)}
            params["embed"][0] = 0
            params["char"] = BiGru(CHAR_SIZE, CHAR_STATES, ATTENTION, rng).p
            params["word"] = BiGru(2 * CHAR_STATES + WORD_SIZE, WORD_STATES, ATTENTION, rng).p
            params["scale"] = np.array([1.0, 0.0])
        self.p = params
        self.char = BiGru(0, CHAR_STATES, 0, params=params["char"])
        self.word = BiGru(0, WORD_STATES, 0, params=params["word"])

    # --- words ------------------------------------------------------------------------------------------------------

    def _by_length(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words in groups of similar length: (their places in the list, characters (time, batch), mask)."""
        sizes = np.array([len(w) for w in words])
        order = np.argsort(sizes, kind="stable")
        edges = np.searchsorted(sizes[order], [5, 8, 12, 18, 32, 128, 1024, 1 << 14, 1 << 18], "right")
        for a, b in zip([0, *edges], [*edges, len(order)]):
            limit = max(1, 4_000_000 // max(1, int(sizes[order[b - 1]]) if b > a else 1))
            for lo in range(a, b, limit):
                at = order[lo : min(b, lo + limit)]
                codes = np.zeros((max(1, int(sizes[at].max())), len(at)), np.int64)
                mask = np.zeros(codes.shape, np.float32)
                for j, i in enumerate(at):
                    codes[: sizes[i], j] = char_codes(words[i])
                    mask[: sizes[i], j] = 1
                yield at, codes, mask

    def word_vectors(self, words: list[str], keep: list | None = None, unknown: Callable[[int], np.ndarray] | None = None) -> np.ndarray:
        out = np.zeros((len(words), 2 * CHAR_STATES + WORD_SIZE), np.float32)
        for at, codes, mask in self._by_length(words):
            x = self.p["chars"][codes]
            if keep is None:
                states = np.concatenate([self.char.run((lambda t, q=self.char.project(x, d): q[t]), mask, d) for d in "fb"], axis=2)
                out[at, : 2 * CHAR_STATES] = self.char.pool(states, mask)[0]
            else:
                pooled, cache = self.char.forward(x, mask)
                out[at, : 2 * CHAR_STATES] = pooled
                keep.append((at, codes, cache))
        known = np.array([self.words.get(w, 0) for w in words], np.int64)
        if unknown is not None:
            known[unknown(len(words)) < HIDDEN] = 0
        out[:, 2 * CHAR_STATES :] = self.p["embed"][known]
        if keep is not None:
            keep.append(known)
        return out

    # --- training ---------------------------------------------------------------------------------------------------

    def _zeros(self) -> dict:
        return {k: ({n: np.zeros_like(a) for n, a in v.items()} if isinstance(v, dict) else np.zeros_like(v)) for k, v in self.p.items()}

    def gradients(self, windows: list[list[str]], y: np.ndarray, unknown: Callable[[int], np.ndarray] | None = None) -> tuple[float, dict]:
        """Mean loss and its gradients. ``unknown`` gives random numbers, which hide the embeddings of some words, so
        that characters must do."""
        words = list({w for win in windows for w in win}) or [""]
        place = {w: i for i, w in enumerate(words)}
        kept: list = []
        vectors = self.word_vectors(words, kept, unknown)
        steps = max(1, max(map(len, windows)))
        ids, mask = np.zeros((steps, len(windows)), np.int64), np.zeros((steps, len(windows)), np.float32)
        for j, win in enumerate(windows):
            ids[: len(win), j] = [place[w] for w in win]
            mask[: len(win), j] = 1
        pooled, cache = self.word.forward(vectors[ids], mask)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        p = sigmoid(logit)
        loss = float(-np.mean(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)))
        g = self._zeros()
        d = ((p - y) / len(y)).astype(np.float32)
        g["out"] += pooled.T @ d
        g["bias"] += d.sum()
        d_x = self.word.backward(d[:, None] * self.p["out"], cache, g["word"])
        d_vectors = np.zeros_like(vectors)
        np.add.at(d_vectors, ids[mask > 0], d_x[mask > 0])
        known = kept.pop()
        np.add.at(g["embed"], known, d_vectors[:, 2 * CHAR_STATES :])
        g["embed"][0] = 0
        for at, codes, char_cache in kept:
            d_chars = self.char.backward(d_vectors[at, : 2 * CHAR_STATES], char_cache, g["char"])
            np.add.at(g["chars"], codes, d_chars * char_cache[1][:, :, None])
        return loss, g

    def adam(self, g: dict, state: dict, rate: float) -> None:
        state["t"] = t = state.get("t", 0) + 1
        flat = [(f"{k}.{n}", self.p[k][n], g[k][n]) for k in ("char", "word") for n in g[k]]
        flat += [(k, self.p[k], g[k]) for k in ("chars", "embed", "out", "bias")]
        for name, value, grad in flat:
            m, v = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            value -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)

    # --- scoring ----------------------------------------------------------------------------------------------------

    def tables(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        """Words' input parts of both directions of the word network."""
        return {d: self.word.project(vectors, d).astype(np.float32) for d in "fb"}

    def window_logits(self, tables: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
        """Logits of windows of one length; ids: (windows, words), places in the tables."""
        out = np.zeros(len(ids), np.float32)
        self.word.steps = ids.shape[1]
        for a in range(0, len(ids), 2048):
            columns = np.ascontiguousarray(ids[a : a + 2048].T)
            states = np.concatenate([self.word.run((lambda t, q=tables[d]: q[columns[t]]), None, d) for d in "fb"], axis=2)
            out[a : a + 2048] = self.word.pool(states, None)[0] @ self.p["out"] + self.p["bias"][0]
        return out

    def probability(self, logits: np.ndarray) -> np.ndarray:
        a, b = self.p["scale"]
        return sigmoid(np.clip(a * logits.astype(np.float64) + b, -30, 30))


class Scorer:
    """Highest window logit of texts, with a bounded cache of words' input parts."""

    def __init__(self, net: Network, bound: int = KEPT_WORDS):
        self.net, self.bound = net, bound
        self._reset()

    def _reset(self) -> None:
        self.place: dict[str, int] = {}  # normalised words
        self.seen: dict[str, int] = {}  # words as they stand in texts
        # place 0 stands for no word at all: its input part is that of a zero vector; pages without words take no memory
        self.tables = {d: np.zeros((self.bound + 1, 3 * WORD_STATES), np.float32) for d in "fb"}
        for d, rows in self.net.tables(np.zeros((1, 2 * CHAR_STATES + WORD_SIZE), np.float32)).items():
            self.tables[d][0] = rows[0]

    def _learn(self, words: list[str]) -> None:
        first = len(self.place) + 1
        for w in words:
            self.place[w] = len(self.place) + 1
        need = len(self.place) + 1
        for d in "fb":
            size = len(self.tables[d])
            if need > size:  # one stretch of texts has more words than the bound
                self.tables[d] = np.concatenate([self.tables[d], np.zeros((need - size, 3 * WORD_STATES), np.float32)])
        for a in range(0, len(words), 20_000):
            part = words[a : a + 20_000]
            for d, rows in self.net.tables(self.net.word_vectors(part)).items():
                self.tables[d][first + a : first + a + len(part)] = rows

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Places of the words of texts; new words of all of them are read at once."""
        lists = [split(t) for t in texts]
        seen = self.seen
        new = {w for ws in lists for w in ws if w not in seen}
        if len(seen) + len(new) > self.bound and seen:
            self._reset()
            seen = self.seen
            new = {w for ws in lists for w in ws}
        if new:
            plain = {w: normal(w) for w in new}
            unread = list({p for p in plain.values() if p not in self.place})
            if unread:
                self._learn(unread)
            for w, p in plain.items():
                seen[w] = self.place[p]
        return [np.fromiter(map(seen.__getitem__, ws), np.int32, len(ws)) if ws else np.zeros(1, np.int32) for ws in lists]

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits of all windows of the texts, the text of each, and its first word."""
        ids = self.ids(texts)
        groups: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for i, at in enumerate(ids):
            if len(at) <= WINDOW:
                found, starts = at[None, :], np.zeros(1, np.int64)
            else:
                starts = np.array([s for s, _ in windows_of(len(at))])
                found = np.lib.stride_tricks.sliding_window_view(at, WINDOW)[starts]
            groups.setdefault(found.shape[1], []).append(found)
            owners.setdefault(found.shape[1], []).append(np.stack([np.full(len(starts), i), starts]))
        logits, owner = [], []
        for size, parts in groups.items():
            logits.append(self.net.window_logits(self.tables, np.concatenate(parts)))
            owner.append(np.concatenate(owners[size], axis=1))
        owner = np.concatenate(owner, axis=1)
        return np.concatenate(logits), owner[0], owner[1]

    def highest(self, texts: list[str], words_at_once: int = 150_000) -> np.ndarray:
        """The highest window logit of every text; texts are taken together up to a number of characters."""
        out, lo = np.full(len(texts), -np.inf), 0
        while lo < len(texts):
            hi, size = lo + 1, len(texts[lo])
            while hi < len(texts) and size + len(texts[hi]) < 6 * words_at_once:
                size += len(texts[hi])
                hi += 1
            logits, owner, _ = self.windows(texts[lo:hi])
            np.maximum.at(out, owner + lo, logits)
            lo = hi
        return out


def distinct_examples(texts: list[str], coordinates: int = 4) -> list[int]:
    """Places of the texts without copies and near copies of earlier ones: those that share a least hash of their word
    triples. Copies would make all of their words look like signs of their label."""
    seen: set[tuple[int, int]] = set()
    out = []
    for i, t in enumerate(texts):
        w = words_of(t)
        codes = np.array([zlib.crc32(" ".join(w[k : k + 3]).encode()) for k in range(max(1, len(w) - 2))], np.uint64)
        least = [(c, int(((codes * np.uint64(2 * c + 0x9E3779B97F4A7C15) + np.uint64(c)) >> np.uint64(20)).min())) for c in range(coordinates)]
        if not seen.intersection(least):
            out.append(i)
        seen.update(least)
    return out


def train(texts: list[str], y: np.ndarray, weight: np.ndarray, seed: int = 11) -> Network:
    """Learn from labels of whole texts."""
    use = distinct_examples(texts)
    texts, y, weight = [texts[i] for i in use], y[use], weight[use]
    rng = np.random.default_rng(seed)
    same: dict[str, str] = {}  # one object a word, however often it stands in the texts
    lists = [[same.setdefault(w, w) for w in words_of(t)] for t in texts]
    del same
    seen = [Counter(w for ws, label in zip(lists, y) if label == c for w in set(ws)) for c in (0, 1)]
    total = [max(1, int((y == c).sum())) for c in (0, 1)]
    often = [w for w, n in sorted((seen[0] + seen[1]).items(), key=lambda x: (-x[1], x[0])) if n >= 4][:VOCABULARY]
    net, state = Network(often, seed), {}
    odds = {w: max(0.0, np.log((seen[1][w] + 0.3) / total[1]) - np.log((seen[0][w] + 0.3) / total[0])) for w in seen[1] if seen[1][w] > 2}
    chosen = {}  # a toxic text's window
    for i in np.flatnonzero(y == 1):
        wins = windows_of(len(lists[i]))
        chosen[i] = max(wins, key=lambda w: sum(sorted((odds.get(x, 0.0) for x in lists[i][w[0] : w[1]]), reverse=True)[:3]))
    # words that speak for the label in a toxic text; they are also set into clean windows, so that their surroundings don't
    suspects = {i: [w for w in sorted(set(lists[i]), key=lambda w: -odds.get(w, 0.0))[:8] if odds.get(w, 0.0) >= 0.6 * max(odds.values())] for i in chosen}
    clean = np.flatnonzero(y == 0)
    hard: list[tuple[int, tuple[int, int]]] = []
    half = BATCH // 2
    for turn in range(ROUNDS):
        if turn:
            scorer = Scorer(net)
            logits, owner, start = (np.concatenate(p) for p in zip(*(_scored(scorer, texts, a) for a in range(0, len(texts), 256))))
            del scorer  # its words and their input parts; the next one reads them anew
            order = np.lexsort((-logits, owner))
            top = order[np.append(True, owner[order][1:] != owner[order][:-1])]
            for k in top:
                i, s = int(owner[k]), int(start[k])
                if y[i] == 1:
                    chosen[i] = (s, min(s + WINDOW, len(lists[i])))
            hard = [(int(owner[k]), (int(start[k]), min(int(start[k]) + WINDOW, len(lists[int(owner[k])])))) for k in top[np.argsort(-logits[top])] if y[owner[k]] == 0][: 4 * half]
        toxic = list(chosen.items())
        for step in range(STEPS_PER_ROUND if toxic and len(clean) else 0):
            windows = []
            for k in rng.integers(0, len(clean), half):
                i = int(clean[k])
                wins = windows_of(len(lists[i]))
                i, (a, b) = hard[rng.integers(len(hard))] if hard and rng.random() < 0.3 else (i, wins[rng.integers(len(wins))])
                windows.append(lists[i][a:b])
            for k, j in zip(rng.integers(0, len(toxic), half), rng.integers(0, half, half)):
                i, (a, b) = toxic[k]
                window = lists[i][a:b]
                if suspects[i] and windows[j] and rng.random() < 0.5:
                    window = list(windows[j])
                    for at in rng.integers(0, len(window), rng.integers(1, 4)):
                        window[at] = suspects[i][rng.integers(len(suspects[i]))]
                windows.append(window)
            _, g = net.gradients(windows, np.repeat(np.array([0, 1], np.float32), half), rng.random)
            net.adam(g, state, 0.01 if turn < ROUNDS - 1 else 0.003)
    del lists
    if len(texts):
        _calibrate(net, Scorer(net).highest(texts), y, weight)
    return net


def _scored(scorer: Scorer, texts: list[str], a: int):
    logits, owner, start = scorer.windows(texts[a : a + 256])
    return logits, owner + a, start


def _calibrate(net: Network, logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
    """Logistic fit of the label on the highest logit, classes weighted as in all labels; the slope is held small and positive."""
    w = weight / weight.mean()
    a, b = 1.0, 0.0
    for _ in range(400):
        p = sigmoid(np.clip(a * logits + b, -30, 30))
        d = w * (p - y) / len(y)
        a = max(0.2, a - 0.5 * ((d * logits).sum() + 0.01 * (a - 1)))
        b -= 0.5 * (d.sum() + 0.001 * b)
    net.p["scale"] = np.array([a, b])


# --- Spark --------------------------------------------------------------------------------------------------------------


def fit(documents: DataFrame, labels: DataFrame, label: str, in_training: Column, per_class: int = PER_CLASS) -> Network:
    """Train on a bounded sample of labelled documents (``per_class`` of each class), in one task. Without examples of both
    classes the network stays untrained."""
    import pickle

    rows = training_rows(documents, labels, label, in_training, per_class)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        found = [r for b in batches for r in zip(b.column("doc_id").to_pylist(), texts_of(b, "text"), b.column("y").to_pylist(), b.column("weight").to_pylist())]
        if found:
            _, texts, y, weight = zip(*sorted(found))
            net = train(list(texts), np.array(y), np.array(weight))
            del found, texts
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((list(net.words), net.p))], pa.binary())], ["net"])
        forget()

    got = rows.repartition(1).mapInArrow(learn, "net binary").collect()
    if not got:
        net = Network([])
        net.p["out"][:] = 0
        net.p["bias"][:] = -2
        return net
    words, params = pickle.loads(got[0]["net"])
    return Network(words, params=params)


def _score_rows(rows: DataFrame, net: Network, schema: T.StructType, texts: Callable[[pa.RecordBatch], list[str]]) -> DataFrame:
    """The first column of ``rows`` with the score of the texts of its batches."""
    model = rows.sparkSession.sparkContext.broadcast((list(net.words), net.p))
    name = f"toxicity {uuid.uuid4().hex}"
    carried = schema.names[0]

    def make():
        scorer = kept(name, lambda: Scorer(Network(model.value[0], params=model.value[1])))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = scorer.net.probability(scorer.highest(texts(batch)))
            return pa.RecordBatch.from_arrays([batch.column(carried), pa.array(found)], [carried, "score"])

        return step

    return by_batch(rows, make, schema)


def score(df: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1).

    Null and empty texts are scored as one window without words. Rows with equal or null ids each give a row; an empty
    table gives none; other columns are ignored. Texts of any length are scored whole; memory in a task is one Arrow batch,
    the windows of a bounded stretch of texts (or of one text), and a bounded cache of words that the worker process keeps
    for its next tasks.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _score_rows(rows, net, T.StructType.fromDDL("doc_id long, score double"), lambda b: texts_of(b, "text"))


def without_toxic(df: DataFrame, net: Network, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose score is under the threshold, all columns as they are.

    Null and empty texts are scored as one window without words; rows with equal or null ids are judged one by one; an empty
    table gives no rows; other columns may have any names.
    """
    rows = with_row(df)
    return _score_rows(rows, net, row_schema(rows, score="double"), lambda b: row_texts(b, text_col)).filter(F.col("score") < threshold).select("row.*")
