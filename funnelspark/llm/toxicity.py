"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A text is read as words (runs of word characters, lower case) in overlapping
windows of ``WINDOW`` words, one starting every ``STRIDE`` words; all windows
are scored and the text takes its highest.  A word's input is the embedding of
the word itself (for words seen in training) next to the mean of the embeddings
of its hashed character trigrams, so unknown and altered spellings count too.
Two gated recurrent units read a window in both directions; an attention layer
weighs the steps, and a logistic unit scores the weighted sum.

Training is numpy on the driver, over all windows of a bounded sample of labelled
rows (``per_class`` ids for each label value, a parameter): a text's label is
carried by its highest-scoring window, which is chosen anew in each epoch.  Scoring is one pass over the whole texts without a
shuffle; the model (under 2 MB) is broadcast.  The gate inputs of a word are
worked out once per task and remembered up to a bound.

Defined results: NULL, empty and word-free texts are one empty window (the
bias's score); without labels of both kinds every score is the share of label 1
(0 if there is none); labels other than 0 and 1, and ids with both, are not
learned from; NULL ids keep their row (they count as the empty id).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, crc_mod, training_rows

WINDOW, STRIDE = 24, 12
HIDDEN, WORD_DIM, CHAR_DIM, CHAR_CELLS = 8, 8, 8, 4096
WORD = re.compile(r"\w+")
#: Words whose gate inputs a task remembers; words and windows handled at once.
REMEMBERED, PIECE, WINDOWS = 1 << 18, 1 << 16, 4096


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the character trigrams of ``^word$`` and where each word's begin."""
    points = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = np.array([len(w) for w in words])  # trigrams of a padded word
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    at = np.arange(n.sum()) + np.repeat(np.arange(len(words)) * 2, n)
    h = (points[at] * np.uint64(0x9E3779B97F4A7C15) ^ points[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F)
         ^ points[at + 2] * np.uint64(0x165667B19E3779F9))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(52)).astype(np.int64), starts


def windows(counts: np.ndarray, spread: int = STRIDE, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts and ends (places in the words of all texts laid end to
    end) and their texts; each text has one window at least, and all words of a
    text are in one."""
    n = np.maximum(1, -(-(counts - width) // spread) + 1)
    text = np.repeat(np.arange(len(counts)), n)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    nth = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    start = first[text] + nth * spread
    return start, np.minimum(start + width, (first + counts)[text]), text


class Net:
    """Parameters and passes.  ``p``: E words, C trigram cells; per direction
    W (inputs to gates), U (state to gates), b; v, w, c: attention and output."""

    def __init__(self, vocabulary: dict[str, int], seed: int = 5):
        r = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        self.vocabulary = vocabulary
        self.p = {"E": r.normal(0, 0.3, (len(vocabulary) + 1, WORD_DIM)), "C": r.normal(0, 0.3, (CHAR_CELLS, CHAR_DIM)),
                  "v": r.normal(0, 0.3, 2 * h), "w": r.normal(0, 0.3, 2 * h), "c": np.zeros(1)}
        for k in "fb":
            self.p["W" + k] = r.normal(0, 1 / math.sqrt(d), (d, 3 * h))
            self.p["U" + k] = r.normal(0, 1 / math.sqrt(h), (h, 3 * h))
            self.p["b" + k] = np.zeros(3 * h)
        self.p["E"][0] = 0  # words not seen in training
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}
        self.prior = 0.0

    def inputs(self, words: list[str]) -> np.ndarray:
        cells, starts = trigrams(words)
        n = np.diff(np.append(starts, len(cells)))[:, None]
        chars = np.add.reduceat(self.p["C"][cells], starts, axis=0) / n
        own = self.p["E"][np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))]
        return np.concatenate([own, chars], 1)

    def gates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]

    def forward(self, gates, ids: np.ndarray, valid: np.ndarray, keep: bool = False):
        """Logits of windows; ids: rows of the gate inputs (windows x steps)."""
        n, t_max = ids.shape
        h = HIDDEN
        states = np.zeros((2, t_max, n, h), np.float32)
        trace = []
        for k, (name, g) in enumerate(zip("fb", gates)):
            u = self.p["U" + name]
            s = np.zeros((n, h), np.float32)
            for t in range(t_max) if name == "f" else range(t_max - 1, -1, -1):
                x = g[ids[:, t]]
                a = s @ u[:, : 2 * h]
                a += x[:, : 2 * h]
                np.negative(a, out=a)
                np.exp(a, out=a)
                a += 1
                np.reciprocal(a, out=a)
                z, r = a[:, :h], a[:, h:]
                z = np.where(valid[:, t, None], z, 1) if not valid[:, t].all() else z
                m = s @ u[:, 2 * h:]
                c = np.tanh(x[:, 2 * h:] + r * m)
                new = c + z * (s - c)
                if keep:
                    trace.append((k, t, s, z, r, m, c))
                s = states[k, t] = new
        e = states[0] @ self.p["v"][:h] + states[1] @ self.p["v"][h:]
        e = np.where(valid.T, e, -1e9)
        w = np.exp(e - e.max(0)) * valid.T
        w /= np.maximum(w.sum(0), 1e-9)
        pooled = np.concatenate([np.einsum("tn,tnh->nh", w, states[0]), np.einsum("tn,tnh->nh", w, states[1])], 1)
        logit = pooled @ self.p["w"] + self.p["c"][0]
        return (logit, states, w, pooled, trace) if keep else logit

    def backward(self, gates, ids, valid, y, weight):
        """Gradients of the mean log-loss: of the shared parameters, and of the gate inputs' rows."""
        h = HIDDEN
        logit, states, w, pooled, trace = self.forward(gates, ids, valid, keep=True)
        d_logit = ((_sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        grad = {"w": pooled.T @ d_logit, "c": np.array([d_logit.sum()]), "v": np.zeros(2 * h, np.float32)}
        d_pooled = d_logit[:, None] * self.p["w"]
        both = np.concatenate([states[0], states[1]], 2)  # steps x windows x 2h
        d_w = np.einsum("nh,tnh->tn", d_pooled, both)
        d_e = w * (d_w - (w * d_w).sum(0))
        grad["v"] = np.einsum("tn,tnh->h", d_e, both)
        d_states = w[:, :, None] * d_pooled + d_e[:, :, None] * self.p["v"]
        d_gates = [np.zeros_like(g) for g in gates]
        for k, name in enumerate("fb"):
            u = self.p["U" + name]
            d_u = np.zeros_like(u)
            d_s = np.zeros((len(y), h), np.float32)
            for k2, t, s, z, r, m, c in reversed(trace):
                if k2 != k:
                    continue
                d = d_s + d_states[t][:, k * h:(k + 1) * h]
                d_z, d_c = d * (s - c) * z * (1 - z), d * (1 - z) * (1 - c * c)
                d_r = d_c * m * r * (1 - r)
                d_a = np.concatenate([d_z, d_r], 1) * valid[:, t, None]
                d_c = d_c * valid[:, t, None]
                d_m = d_c * r
                d_u[:, : 2 * h] += s.T @ d_a
                d_u[:, 2 * h:] += s.T @ d_m
                np.add.at(d_gates[k], ids[:, t], np.concatenate([d_a, d_c], 1))
                d_s = d * z + d_a @ u[:, : 2 * h].T + d_m @ u[:, 2 * h:].T
            grad["U" + name] = d_u
        return grad, d_gates


def _laid_out(start: np.ndarray, end: np.ndarray, ids: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    at = start[:, None] + np.arange(WINDOW)
    valid = at < end[:, None]
    return np.where(valid, ids[np.minimum(at, max(len(ids) - 1, 0))] if len(ids) else blank, blank), valid


def train_net(texts: list[str], labels: list[int], epochs: int = 14, batch: int = 192, rate: float = 0.02) -> Net:
    docs = [WORD.findall(t.lower()) for t in texts]
    seen = Counter(w for d in docs for w in set(d))
    # Windows that repeat a word or two of clean texts are clean too; without
    # them a rare word that fills a window is far from all that was seen.
    r = np.random.default_rng(3)
    clean = [d for d, k in zip(docs, labels) if not k and d]
    for d in (clean[i] for i in r.integers(0, len(clean), len(clean) // 2 + 200 if clean else 0)):
        a, b = r.integers(0, len(d), 2)
        n = int(r.integers(1, WINDOW + 1))
        docs.append([d[a]] * n + [d[b]] * (WINDOW - n))
    y = np.concatenate([np.array(labels, np.float32), np.zeros(len(docs) - len(labels), np.float32)])
    net = Net({w: i + 1 for i, (w, n) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:8192]) if n > 1})
    words = sorted(seen) or ["-"]
    number = {w: i for i, w in enumerate(words)}
    ids = np.fromiter((number[w] for d in docs for w in d), np.int64)
    own = np.fromiter((net.vocabulary.get(w, 0) for w in words), np.int64)
    cells, starts = trigrams(words)
    lens = np.diff(np.append(starts, len(cells)))
    start, end, text = windows(np.array([len(d) for d in docs]))
    first = np.searchsorted(text, np.arange(len(docs) + 1))
    state = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in net.p.items()}
    step = 0
    for epoch in range(epochs):
        gates = net.gates(net.inputs(words))
        if epoch < 2:  # nothing learned yet: any window stands for its text
            logit = r.normal(size=len(start))
        else:
            logit = np.concatenate([net.forward(gates, *_laid_out(start[i:i + WINDOWS], end[i:i + WINDOWS], ids, 0))
                                    for i in range(0, len(start), WINDOWS)])
        top = np.array([first[d] + np.argmax(logit[first[d]:first[d + 1]]) for d in range(len(docs))])
        some = np.array([r.integers(first[d], first[d + 1]) for d in range(len(docs))])
        # A clean text's every window is clean: its worst one and one by chance; early on, more of a toxic text's.
        pick = np.concatenate([top, some[y == 0]] + ([r.integers(first[:-1], first[1:])[y == 1] for _ in range(4)] if epoch < 2 else []))
        for part in np.array_split(r.permutation(pick), max(1, len(pick) // batch)):
            laid, valid = _laid_out(start[part], end[part], ids, 0)
            used, place = np.unique(laid, return_inverse=True)
            x = net.inputs([words[i] for i in used])
            grad, d_gates = net.backward(net.gates(x), place.reshape(laid.shape), valid, y[text[part]], np.ones(len(part), np.float32))
            d_x = np.zeros_like(x)
            for name, d in zip("fb", d_gates):
                grad["W" + name], grad["b" + name] = x.T @ d, d.sum(0)
                d_x += d @ net.p["W" + name].T
            grad["E"], grad["C"] = np.zeros_like(net.p["E"]), np.zeros_like(net.p["C"])
            np.add.at(grad["E"], own[used], d_x[:, :WORD_DIM])
            grad["E"][0] = 0
            at = np.concatenate([np.arange(starts[i], starts[i] + lens[i]) for i in used])
            np.add.at(grad["C"], cells[at], np.repeat(d_x[:, WORD_DIM:] / lens[used][:, None], lens[used], axis=0))
            step += 1
            now = rate * min(1.0, 2 * (1 - epoch / epochs))
            for k, g in grad.items():  # Adam
                m, v = state[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.p[k] -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame, label: str, used, per_class: int = 1200) -> Net | float:
    """A trained network, or a constant score if there is nothing to learn."""
    sample, share = training_rows(docs, labels, label, per_class, used)
    have = Counter(int(r[2]) for r in sample)
    if not have[0] or not have[1]:
        return have[1] / max(1, len(sample))
    net = train_net([r[1] for r in sample], [int(r[2]) for r in sample])
    net.prior = math.log((share[1] / share[0]) / (have[1] / have[0]))  # undo the sample's balance
    return net


class Scorer:
    """Scores texts in blocks; remembers the gate inputs of words up to a bound."""

    def __init__(self, net: Net):
        self.net = net
        self._forget()

    def _forget(self):
        self.row: dict[str, int] = {}
        self.gates = [np.zeros((REMEMBERED, 3 * HIDDEN), np.float32) for _ in "fb"]

    def _ids(self, words: list[str]) -> np.ndarray:
        if len(self.row) + len(words) >= REMEMBERED:
            self._forget()
        row = self.row
        new = [w for w in dict.fromkeys(words) if w not in row]
        if new:
            at = len(row) + 1
            row.update(zip(new, range(at, at + len(new))))
            for held, g in zip(self.gates, self.net.gates(self.net.inputs(new))):
                held[at:at + len(new)] = g
        return np.fromiter(map(row.__getitem__, words), np.int64, len(words))

    def _window_scores(self, ids, start, end) -> np.ndarray:
        out = [self.net.forward(self.gates, *_laid_out(start[i:i + WINDOWS], end[i:i + WINDOWS], ids, 0))
               for i in range(0, len(start), WINDOWS)]
        return np.concatenate(out)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        words = [WORD.findall((t or "").lower()) for t in texts]
        best = np.full(len(texts), -np.inf)
        i = 0
        while i < len(texts):  # runs of texts of about PIECE words; a longer text goes alone, in parts
            j, n = i + 1, len(words[i])
            while j < len(texts) and n + len(words[j]) <= PIECE:
                n += len(words[j])
                j += 1
            if n <= PIECE:
                start, end, text = windows(np.array([len(x) for x in words[i:j]]))
                logit = self._window_scores(self._ids([w for x in words[i:j] for w in x]), start, end)
                np.maximum.at(best, i + text, logit)
            else:  # parts overlap by a window, so every window of the text lies in one
                step = PIECE // STRIDE * STRIDE
                for at in range(0, n, step):
                    part = words[i][at:at + step + WINDOW]
                    start, end, _ = windows(np.array([len(part)]))
                    best[i] = max(best[i], self._window_scores(self._ids(part), start, end).max())
            i = j
        return _sigmoid(best + self.net.prior)


def score(docs: DataFrame, model: Net | float) -> DataFrame:
    """doc_id, score for every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value) if isinstance(held.value, Net) else None
        for batch in batches:
            for part in blocks(batch, "text"):
                s = scorer.scores(part.column(1).to_pylist()) if scorer else np.full(part.num_rows, held.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 1200, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out rows are not read."""
    model = train(docs, labels, "toxic", crc_mod("doc_id", 5) != 0, per_class)
    return score(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
