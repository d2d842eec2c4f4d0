"""Toxicity, quality, language ID: held-out accuracy and defined results."""

import zlib

import numpy as np
import pytest
from support import by_id

from funnelspark.llm import langid, quality, toxicity

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def mid(spark):
    return spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")


def held_out(doc_id, m, k):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % m == k


def test_quality_held_out(mid):
    docs, labels = mid
    got = quality.quality(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == held_out(r.doc_id, 4, 2) and r.predicted == int(r.score >= 0.7) for r in got)
    own = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in own]) > 0.9


def test_toxicity_held_out(mid):
    docs, labels = mid
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == held_out(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    own = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in own]) > 0.85


def test_toxic_words_are_found_anywhere():
    r = np.random.default_rng(1)
    words = ["".join(r.choice(list("abcdefghij"), 5)) for _ in range(300)]
    make = lambda bad, n: " ".join([*r.choice(words, n), *(["nasty"] if bad else []), *r.choice(words, n)])
    labels = [i % 2 for i in range(300)]
    net = toxicity.train_net([make(y, 40) for y in labels], labels)
    scorer = toxicity.Scorer(net)
    assert scorer.scores([make(1, 5), make(1, 300), make(1, 40_000)]).min() > 0.5
    assert scorer.scores([make(0, 5), make(0, 300), make(0, 3000)]).max() < 0.5


def test_gradients_of_the_network():
    r = np.random.default_rng(2)
    net = toxicity.Net({"a": 1, "b": 2})
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    x = net.inputs(["a", "b", "cd"])
    gates = [g.astype(np.float64) for g in net.gates(x)]
    ids = r.integers(0, 3, (4, 6))
    valid = np.arange(6) < np.array([6, 3, 1, 5])[:, None]
    y = np.array([1.0, 0, 1, 0])
    grad, _ = net.backward(gates, ids, valid, y, np.ones(4))

    def loss():
        p = toxicity._sigmoid(net.forward(gates, ids, valid))
        return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))

    for name in ("Uf", "Ub", "v", "w", "c"):
        flat = net.p[name].reshape(-1)
        for i in (0, len(flat) // 2):
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-4 - grad[name].reshape(-1)[i]) < 2e-4


def test_windows_cover_all_words():
    counts = np.array([0, 1, 24, 25, 100])
    start, end, text = toxicity.windows(counts)
    first = np.cumsum(counts) - counts
    for t, n in enumerate(counts):
        own = [(s - first[t], e - first[t]) for s, e, k in zip(start, end, text) if k == t]
        assert own and {p for s, e in own for p in range(s, e)} == set(range(n)) and all(e - s <= 24 for s, e in own)


def test_language_held_out(mid):
    docs, _ = mid
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == held_out(r.doc_id, 5, 0) for r in got)
    own = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in own]) > 0.97
    assert not any(r.rejected for r in got)


def test_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(16)] + [(0, 0, 0), (3, None, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for score, label in ((quality.quality, "q"), (toxicity.toxicity, "t")):
        got = score(odd, labels)
        assert by_id(got, "doc_id") == by_id(odd, "doc_id")
        assert all(0 <= r.score <= 1 for r in got.collect())
        assert score(empty, labels).count() == 0
        assert len({r.score for r in score(odd, none).collect()}) == 1
    got = langid.identify(odd)
    assert by_id(got, "doc_id") == by_id(odd, "doc_id")
    rows = {r.doc_id: r for r in got.collect()}
    for i in (2, 3, 4, 5):
        assert rows[i].lang_pred == "und" and rows[i].rejected and rows[i].score == 0
    assert rows[1].lang_pred == "de" and rows[12].lang_pred == "en"
    kept = langid.keep_identified(odd)
    assert kept.schema == odd.schema and by_id(kept, "doc_id") == by_id(got.where("not rejected"), "doc_id")
    assert langid.identify(empty).count() == langid.keep_identified(empty).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}


# -- plain versions -----------------------------------------------------------------
def plain_logit(net, words):
    """The network, a window at a time, step by step, in plain Python numbers."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    h = toxicity.HIDDEN
    sig = lambda x: 1 / (1 + np.exp(-x))

    def x_of(w):
        cells, _ = toxicity.trigrams([w])
        return np.concatenate([p["E"][net.vocabulary.get(w, 0)], np.mean([p["C"][c] for c in cells], axis=0)])

    def read(k, seq):
        s, out = np.zeros(h), []
        for w in seq:
            g, u = x_of(w) @ p["W" + k] + p["b" + k], p["U" + k]
            z, r = (sig(g[i * h:(i + 1) * h] + s @ u[:, i * h:(i + 1) * h]) for i in (0, 1))
            s = z * s + (1 - z) * np.tanh(g[2 * h:] + r * (s @ u[:, 2 * h:]))
            out.append(s)
        return out

    states = np.array([np.concatenate(both) for both in zip(read("f", words), read("b", words[::-1])[::-1])])
    e = np.exp(states @ p["v"])
    return float((e / e.sum()) @ states @ p["w"] + p["c"][0])


def test_scores_of_the_network_in_plain_form():
    """The highest of a text's windows, each read step by step."""
    r = np.random.default_rng(4)
    net = toxicity.Net({"a": 1, "bc": 2, "nasty": 3})
    net.prior = 0.3
    texts = [" ".join(r.choice(["a", "bc", "nasty", "unseen", "x1"], n)) for n in (1, 5, 24, 25, 70)]
    got = toxicity.Scorer(net).scores(texts)
    for text, score in zip(texts, got):
        words = text.split()
        starts = range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        best = max(plain_logit(net, words[i:i + toxicity.WINDOW]) for i in starts)
        assert abs(score - 1 / (1 + np.exp(-best - 0.3))) < 1e-4


def test_ftrl_in_dictionary_form():
    """The update rule, a cell at a time."""
    r = np.random.default_rng(3)
    rows = [(np.sort(r.choice(40, 5, replace=False)), r.random(5), int(r.integers(2))) for _ in range(60)]
    w, bias = quality.train_ftrl(rows, epochs=2)
    alpha, beta, l1, l2, last = 2.0, 1.0, 2e-3, 1e-3, 1 << quality.BITS
    z, n = {}, {}

    def weight(c):
        v = z.get(c, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - np.sign(v) * l1) / ((beta + n.get(c, 0.0)**0.5) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(2):
        for i in order.permutation(len(rows)):
            x = {**dict(zip(rows[i][0].tolist(), rows[i][1].tolist())), last: 1.0}
            own = {c: weight(c) for c in x}
            p = 1 / (1 + np.exp(-sum(own[c] * v for c, v in x.items())))
            for c, v in x.items():
                g = (p - rows[i][2]) * v
                sigma = ((n.get(c, 0.0) + g * g)**0.5 - n.get(c, 0.0)**0.5) / alpha
                z[c] = z.get(c, 0.0) + g - sigma * own[c]
                n[c] = n.get(c, 0.0) + g * g
    assert abs(bias - weight(last)) < 1e-9
    assert all(abs(w[c] - weight(c)) < 1e-9 for c in range(40)) and not w[40:].any()


def test_nearest_centroid_in_plain_form(mid):
    """Cosine to every centroid, a text at a time."""
    docs, _ = mid
    from pyspark.sql import functions as F
    m = langid.train(docs, F.lit(True), per_lang=30, centroids=3)
    texts = [r.text for r in docs.limit(40).collect()] + ["", "12 !", "a", "été"]
    best, cos, rejected, has = langid._nearest(m, texts)
    for t, b, c, bad, h in zip(texts, best, cos, rejected, has):
        x, letters = langid.vectors([t])
        v = [np.log1p(a) * i for a, i in zip(x[0].tolist(), m["idf"].tolist())]
        size = sum(a * a for a in v)**0.5
        near = [sum(a * d for a, d in zip(v, own.tolist())) / max(size, 1e-12) for own in m["centroids"]]
        assert h == any(ch.isalpha() for ch in t)
        if h:
            assert abs(max(near) - c) < 1e-5 and near[b] > max(near) - 1e-5
            assert bad == (letters[0] >= langid.MIN_LETTERS and 1 - c > m["radius"][b])
        else:
            assert bad and c == 0


def test_the_sample_is_the_same_under_any_partitioning(spark):
    """One text an id, whatever its copies; ids with two labels and labels other than 0 and 1 are left out."""
    from pyspark.sql import functions as F
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('t', id % 7, ' ', id) as text")
    hot = spark.range(3000).selectExpr("5L as doc_id", "concat('copy ', id % 3) as text")
    docs = docs.unionByName(hot)
    labels = spark.range(4000).selectExpr("id as doc_id", "cast(id % 3 as int) as q").unionByName(
        spark.createDataFrame([(9, 0), (9, 1), (None, 1)], "doc_id long, q int"))
    from funnelspark.llm.common import training_rows
    first, share = training_rows(docs.repartition(1), labels.repartition(1), "q", 50, F.lit(True))
    again, _ = training_rows(docs.repartition(13, "text"), labels.repartition(7), "q", 50, F.lit(True))
    assert first == again and len(first) == 100 and share == {0: 1333, 1: 1333}
    assert len({r[0] for r in first}) == 100 and all(r[0] % 3 == r[2] for r in first) and 9 not in {r[0] for r in first}
    whole, _ = training_rows(docs, labels, "q", 5000, F.lit(True))
    assert dict((r[0], r[1]) for r in whole).get(5) is None and len(whole) == 2666  # 5 has label 2
