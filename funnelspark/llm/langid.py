"""Language identification by nearest centroid.

A text becomes a vector of hashed letter n-grams (1 to 3, word by word, lower
case), weighted by TF-IDF and scaled to length one.  Each language has several
centroids, found by spherical k-means among its training vectors.  A text takes
the language of the centroid with the largest cosine; it is rejected when it
has no letter, or when it has ``MIN_LETTERS`` letters or more and its distance
to that centroid is beyond the language's radius, which is learned from the
training distances.  (A few letters lie far from everything, in any language.)

Training takes a bounded sample (``per_lang`` ids per language, a parameter).
The model (a few centroids of 4,096 cells per language) is broadcast; scoring
is one pass over the whole texts without a shuffle.

Defined results: NULL texts and texts without a letter give ``und``, score 0,
rejected; without training rows every row does; rows with a NULL id or NULL
lang are predicted like any other but not learned from, as are held-out rows and
ids with several languages; of the texts of an id the least is learned from.
:func:`keep_identified` keeps all rows when there is nothing to learn from, as
nothing then tells which to reject.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, chosen_ids, crc_mod, one_class, texts_of

CELLS = 4096
ROWS = 256  # texts vectorised at once
MIN_LETTERS = 20


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts (texts x CELLS) and the number of letters of each text."""
    joined = [(t or "").lower() for t in texts]
    points = np.frombuffer(" ".join(["", *joined, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in joined])  # of each point but the first
    c = np.where(_letters()[points], points, np.uint64(0))
    left, mid, right = c[:-2], c[1:-1], c[2:]
    at = np.flatnonzero(mid)
    left, mid, right, of = left[at], mid[at], right[at], doc[at]
    k1, k2, k3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    out = np.zeros(len(texts) * CELLS)
    two = mid * k1 + right * k2
    for gram in (mid * k1 + k3, two + np.uint64(1), (two ^ left) * k3 + left * k1):
        gram = (gram ^ (gram >> np.uint64(31))) * k2 >> np.uint64(52)
        out += np.bincount(of * CELLS + gram.astype(np.int64), minlength=len(out))
    return out.reshape(-1, CELLS), np.bincount(of, minlength=len(texts))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from a farthest-first start; a fixed result."""
    centre = [_unit(x.mean(0))]
    for _ in range(min(k, len(x)) - 1):
        centre.append(x[np.argmin((x @ np.array(centre).T).max(1))])
    c = np.array(centre)
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        c = _unit(np.array([x[near == i].sum(0) if (near == i).any() else c[i] for i in range(len(c))]))
    return c


def train(docs: DataFrame, used, per_lang: int = 400, centroids: int = 4) -> dict | None:
    """idf, centroids, their languages and radii; None without training rows."""
    labelled = one_class(docs.where(used & F.col("text").isNotNull()), "lang")
    rows = sorted((lang, i, text) for i, text, lang in texts_of(docs.where(F.col("text").isNotNull()), chosen_ids(labelled, per_lang)))
    parts = [vectors([r[2] for r in rows[i:i + ROWS]]) for i in range(0, len(rows), ROWS)]
    if not parts:
        return None
    x, has = np.concatenate([p[0] for p in parts]).astype(np.float32), np.concatenate([p[1] for p in parts])
    langs = np.array([r[0] for r in rows])
    x, langs = x[has > 0], langs[has > 0]
    if not len(x):
        return None
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1
    x = _unit(np.log1p(x) * idf)
    c, of, radius = [], [], {}
    for lang in sorted(set(langs)):
        own = x[langs == lang]
        c.append(_k_means(own, centroids))
        of += [lang] * len(c[-1])
        # Short texts lie far out: half the cosine of the farthest training text is still the language.
        radius[lang] = 1 - 0.5 * float((own @ c[-1].T).max(1).min())
    return {"idf": idf, "centroids": np.concatenate(c), "lang": of, "radius": [radius[x] for x in of]}


def _nearest(m: dict, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(centroid, cosine, rejected, has a letter) of each text; no letter: cosine 0, rejected."""
    x, letters = vectors(texts)
    cos = _unit(np.log1p(x) * m["idf"]) @ m["centroids"].T
    best, cos = cos.argmax(1), np.clip(cos.max(1), 0.0, 1.0)
    far = (1 - cos > np.array(m["radius"])[best]) & (letters >= MIN_LETTERS)
    return best, np.where(letters > 0, cos, 0.0), far | (letters == 0), letters > 0


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row (NULL ids included)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for block in blocks(batch, "text"):
                for at in range(0, block.num_rows, ROWS):
                    part = block.slice(at, ROWS)
                    if m is None:
                        lang, cos, bad = ["und"] * part.num_rows, [0.0] * part.num_rows, [True] * part.num_rows
                    else:
                        best, cos, bad, has = _nearest(m, part.column(1).to_pylist())
                        lang = [m["lang"][b] if h else "und" for b, h in zip(best, has)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(lang, pa.string()), pa.array(cos, pa.float64()), pa.array(bad, pa.bool_())],
                        ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, per_lang: int = 400, centroids: int = 4) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    model = train(docs, crc_mod("doc_id", 5) != 0, per_lang, centroids)
    return predict(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, per_lang: int = 400, centroids: int = 4) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns.  The
    decision is made in the same pass as the rows pass through: no join."""
    model = train(docs, crc_mod("doc_id", 5) != 0, per_lang, centroids)
    held = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for block in blocks(batch, "text"):
                for at in range(0, block.num_rows, ROWS):
                    part = block.slice(at, ROWS)
                    if m is None:  # no language is known: nothing to reject by
                        yield part
                        continue
                    yield part.filter(pa.array(~_nearest(m, part.column(text_at).to_pylist())[2]))

    return docs.mapInArrow(run, docs.schema)
