"""Quality classifier: hashed word n-grams, logistic regression trained with
follow-the-regularised-leader (FTRL-proximal) updates.

A text becomes tokens (runs of word characters, runs of other marks, lower
case; a token equal to the one before it becomes the token ``<same>``).  Its
unigrams and bigrams are hashed into 2^18 cells, counted, and scaled to length
one.  The score is the sparse dot product with the learned weights, through the
logistic function.  Training takes a bounded sample of labelled rows
(``per_class`` for each label value, a parameter) on the driver; the sample's
balance is undone by the log-odds of all usable labels.  Scoring is one pass
over the texts without a shuffle.

Defined results: NULL, empty and white-space texts have no features and get the
score of the bias alone; without usable labels every score is 0.5; labels other
than 0 and 1, and ids with both, are not learned from; NULL ids
keep their row (they count as the empty id); repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, crc_mod, training_rows

BITS = 18
TOKEN = re.compile(r"\w+|[^\w\s]+")
SAME = zlib.crc32(b"<same>")


class Hashes(dict):
    """token -> crc32, remembered up to a bound."""

    def __missing__(self, token: str) -> int:
        h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        if len(self) < 300_000:
            self[token] = h
        return h


def features(text: str, hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Cells of a text's n-grams and their values (length one together)."""
    tokens = TOKEN.findall(text.lower())
    if not tokens:
        return np.empty(0, np.int64), np.empty(0)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    u = h.copy()
    u[1:][h[1:] == h[:-1]] = SAME
    mix = np.uint64(0x9E3779B97F4A7C15)
    pairs = (u[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + u[1:]) * mix
    cells, counts = np.unique(np.concatenate([u * mix, pairs]) >> np.uint64(64 - BITS), return_counts=True)
    return cells.astype(np.int64), counts / math.sqrt(float(np.dot(counts, counts)))


def train_ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 4, alpha: float = 2.0,
               beta: float = 1.0, l1: float = 2e-3, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights of the cells and the bias, by FTRL-proximal in a fixed order."""
    d = (1 << BITS) + 1  # the last cell is the bias
    z, n = np.zeros(d), np.zeros(d)
    order = np.random.default_rng(7)
    rows = [(np.append(c, d - 1), np.append(v, 1.0), y) for c, v, y in examples]

    def weights(c):
        zc = z[c]
        w = -(zc - np.sign(zc) * l1) / ((beta + np.sqrt(n[c])) / alpha + l2)
        return np.where(np.abs(zc) <= l1, 0.0, w)

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            c, v, y = rows[i]
            w = weights(c)
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w @ v)))))
            g = (p - y) * v
            sigma = (np.sqrt(n[c] + g * g) - np.sqrt(n[c])) / alpha
            z[c] += g - sigma * w
            n[c] += g * g
    w = weights(np.arange(d))
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, label: str, used, per_class: int = 2500) -> tuple[np.ndarray, float]:
    sample, share = training_rows(docs, labels, label, per_class, used)
    if not sample:
        return np.zeros(1 << BITS), 0.0
    hashes = Hashes()
    w, bias = train_ftrl([(*features(t, hashes), int(y)) for _, t, y in sample])
    taken = {k: sum(1 for r in sample if int(r[2]) == k) for k in (0, 1)}
    if taken[0] and taken[1]:  # undo the sample's balance
        bias += math.log((share[1] / share[0]) / (taken[1] / taken[0]))
    return w, bias


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, score for every row."""
    held = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))  # 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias = held.value
        hashes = Hashes()
        for batch in batches:
            for part in blocks(batch, "text"):
                out = []
                for text in part.column(1):
                    c, v = features(text.as_py() or "", hashes)
                    out.append(1 / (1 + math.exp(-max(-35.0, min(35.0, float(w[c] @ v) + bias)))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, per_class: int = 2500, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out rows are not read."""
    model = train(docs, labels, "quality", crc_mod("doc_id", 4) != 2, per_class)
    return score(docs, model).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
