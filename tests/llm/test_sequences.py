"""Periodic runs, byte-level BPE, conversation repair: against brute force and the tokenizer library."""

import base64
import hashlib
import random

import brute
import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T
from support import SF, by_id, rows

from funnelspark.llm import bytebpe, conversations, periodicruns
from funnelspark.llm.queries import BYTE_BPE, BYTE_BPE_PATTERN, QUERIES, damaged

sha = lambda b: hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


# -- periodic runs ------------------------------------------------------------------
def found(docs):
    ids = np.array([w for d in docs for w in d], np.int64)
    sizes = np.array([len(d) for d in docs], np.int64)
    begins = np.cumsum(sizes) - sizes
    out = [[] for _ in docs]
    for s, n, q in zip(*(x.tolist() for x in periodicruns.find_runs(ids, np.repeat(np.arange(len(docs)), sizes)))):
        k = int(np.searchsorted(begins, s, "right")) - 1
        out[k].append((s - int(begins[k]), n, q))
    return out


def random_doc(r):
    k, n = r.choice([1, 2, 3, 5, 20]), r.choice([0, 1, 5, 6, 7, 12, 40, 100, 300])
    d = [r.randrange(k) for _ in range(n)]
    for _ in range(r.randrange(4)):
        u = [r.randrange(k) for _ in range(r.randrange(1, 30))]
        x = r.randrange(len(d) + 1)
        d[x:x] = u * r.randrange(2, 9) + u[:r.randrange(len(u) + 1)]
    return d


def test_runs_match_brute_force():
    r = random.Random(3)
    for _ in range(150):
        docs = [random_doc(r) for _ in range(r.randrange(1, 30))]
        assert found(docs) == [brute.runs(d) for d in docs]


def test_runs_of_hard_texts():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(4096)]
    docs = [b, a, thue * 4 + thue, [0] * 5000, [0, 1] * 2500 + [0], list(range(900)) * 5, sum(([i % 7] * (i % 11) for i in range(900)), [])]
    assert found(docs) == [brute.runs(d) for d in docs]


def test_runs_do_not_depend_on_the_hashes(monkeypatch):
    """Where all stretches hash alike, the words still decide."""
    r = random.Random(4)
    docs = [random_doc(r) for _ in range(40)]
    monkeypatch.setattr(periodicruns.Hashes, "equal", lambda self, a, b, size: np.ones(len(a), bool))
    assert found(docs) == [brute.runs(d) for d in docs]


def test_grammar_gives_the_text_back():
    r = random.Random(5)
    docs = [random_doc(r) for _ in range(20)]
    ids = np.array([w for d in docs for w in d], np.int64)
    text = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    g = periodicruns.Grammar(ids, text)
    for place, symbol in zip(g.places, g.symbols):  # a symbol is the same words of one text everywhere
        a, n = g.first[symbol], g.length[symbol]
        assert text[a] == text[place] == text[place + n - 1] and (ids[a:a + n] == ids[place:place + n]).all()
    left = np.append(np.flatnonzero(~g.joined[:len(ids)]), len(ids))
    pairs = {}  # no pair of the symbols that are left occurs twice, but for overlaps
    for x, y, z in zip(left, left[1:], left[2:]):
        if text[x] == text[y]:
            pairs.setdefault((text[x], tuple(ids[x:y]), tuple(ids[y:z])), []).append(x)
    derived = {(int(p), int(n)) for p, n in zip(g.places, g.length[g.symbols])}
    assert derived or not any(len(v) > 1 for v in pairs.values())


def test_runs_on_whole_tables(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    docs = documents.collect()
    assert len(got) == len(docs)
    for d in docs:
        words = brute.planted(d.doc_id, (d.text or "").encode().split())
        expect, r = brute.runs(words), got[d.doc_id]
        best = min(expect, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(expect), *best)
        assert r.exponent_milli == (best[0] if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in expect))
        assert r.collapsed_sha256 == sha(brute.collapsed(words))
    assert any(r.n_runs for r in got.values())


def test_runs_of_odd_rows(odd, empty):
    got = periodicruns.periodic_runs(odd).select("doc_id", F.to_json("runs").alias("runs"), "collapsed")
    expect = []
    for i, t, *_ in rows():
        words = (t or "").encode().split()
        listed = ",".join(f'{{"start":{s},"length":{n},"period":{q}}}' for s, n, q in brute.runs(words))
        expect.append((i, f"[{listed}]", brute.collapsed(words).decode()))
    assert by_id(got, "doc_id", "runs", "collapsed") == sorted(expect, key=lambda r: tuple((x is not None, x) for x in r))
    assert periodicruns.periodic_runs(empty).count() == 0


def test_words_are_cut_at_six_white_spaces(spark):
    text = "a\x1ca a b\x0bb\x0cb\tb\nb\rb  b"
    got = periodicruns.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in got.runs] == [(1, 7, 1)] and got.collapsed == "a\x1ca a b"


# -- byte-level BPE -----------------------------------------------------------------
@pytest.fixture(scope="module")
def vocabulary():
    return bytebpe.Vocabulary(bytebpe.read_ranks(BYTE_BPE), BYTE_BPE_PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    return tiktoken.Encoding("own", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_the_hash_is_minimal_and_perfect(vocabulary):
    tokens = list(bytebpe.read_ranks(BYTE_BPE))
    slots = vocabulary.hash.slots(tokens).tolist()
    assert sorted(slots) == list(range(len(tokens)))
    assert slots[:500] == [vocabulary.hash.slot(t) for t in tokens[:500]]
    encoder = bytebpe.Encoder(vocabulary)
    assert encoder.whole(tokens) == [vocabulary.ids[s] for s in slots]
    assert encoder.whole([b"", b"no such token at all", tokens[0] + b"\xff\xfe"]) == [None] * 3


def test_every_code_point_as_the_library(vocabulary, library):
    encoder = bytebpe.Encoder(vocabulary)
    for lo in range(0, 0x110000, 0x1000):
        texts = [f"a{c}1{c} {c}{c}\n {c} x" for c in map(chr, range(lo, lo + 0x1000)) if not 0xD800 <= ord(c) < 0xE000]
        assert encoder.encode(texts) == [library.encode_ordinary(t) for t in texts]


def test_long_and_random_texts_as_the_library(vocabulary, library):
    r = random.Random(6)
    texts = ["".join(r.choice("ab 'sté日\n\t1!Á\x1c\x85\x00​") for _ in range(r.randrange(60))) for _ in range(4000)]
    texts += ["a" * 70_001, "ab" * 30_000, " " * 5000 + "x", "é" * 20_000, "<|endoftext|> I'll don'T ''s", ""]
    encoder = bytebpe.Encoder(vocabulary)
    got = encoder.encode(texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [encoder.decode(g) for g in got] == [t.encode() for t in texts]


def test_forgetting_changes_nothing(vocabulary, library, documents, monkeypatch):
    monkeypatch.setattr(bytebpe, "REMEMBERED", 50)
    texts = [r.text for r in documents.limit(20).collect()]
    encoder = bytebpe.Encoder(vocabulary)
    assert [encoder.encode([t])[0] for t in texts] == [library.encode_ordinary(t) for t in texts]


def test_ids_are_laid_end_to_end(vocabulary, library):
    """A known pre-token is its ids as bytes: no id of a text is handled by itself."""
    texts = ["the the tthhee ereresntha", "", "a 'll ''s  \n x" * 50]
    encoder = bytebpe.Encoder(vocabulary)
    got = encoder.arrays(texts)
    assert all(a.dtype == np.int32 for a in got) and all(type(v) is bytes for v in encoder.known.values())
    assert [a.tolist() for a in got] == encoder.encode(texts) == [library.encode_ordinary(t) for t in texts]


def test_byte_bpe_on_whole_tables(spark, documents, library):
    got = {r.doc_id: r for r in QUERIES["op12_byte_bpe"](spark, SF).collect()}
    docs = documents.collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = library.encode_ordinary(d.text or ""), got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode_bytes(ids)) == sha(d.text or "")


def test_byte_bpe_of_odd_rows(odd, empty, library):
    tokens = bytebpe.encode(odd, BYTE_BPE, BYTE_BPE_PATTERN)
    expect = sorted(((i, len(library.encode_ordinary(t or "")), sha(t or "")) for i, t, *_ in rows()),
                    key=lambda r: tuple((x is not None, x) for x in r))
    back = bytebpe.decode(tokens.where("doc_id = 14"), BYTE_BPE, BYTE_BPE_PATTERN).first()
    assert bytes(back.decoded).decode() == next(t for i, t, *_ in rows() if i == 14)
    both = bytebpe.encode(odd, BYTE_BPE, BYTE_BPE_PATTERN, decoded=True).withColumn("sha", F.sha2("decoded", 256))
    assert by_id(both, "doc_id", "n_tokens", "sha") == expect
    assert bytebpe.encode(empty, BYTE_BPE, BYTE_BPE_PATTERN).count() == 0
    none = odd.sparkSession.createDataFrame([(1, None), (2, [None, 65])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bytebpe.decode(none, BYTE_BPE, BYTE_BPE_PATTERN).orderBy("doc_id").collect()] == [b"", library.decode_bytes([65])]


def test_ranks_without_a_byte_are_refused():
    with pytest.raises(ValueError):
        bytebpe.Vocabulary({b"a": 0}, BYTE_BPE_PATTERN)


# -- conversation repair ------------------------------------------------------------
CONV = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                     T.StructField("text", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("n", T.DoubleType())])
VALUES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def random_conversations(r, n, most):
    out = []
    for conv in range(n):
        for _ in range(r.randrange(most)):
            out.append((conv if conv else None, r.choice([None, *range(most)]), r.choice(["user", "assistant", "system", "user", "tool", "", None, "assistant"]),
                        r.choice(["hi.", "hi", "", " \t\n", None, "what?", "so\x1c", "no! ", f"{r.random()}.", f"{r.random()}", "日本."])))
    return out


def expected(data, change):
    by = {}
    for row in data:
        by.setdefault(row[0], []).append(row)
    return {c: brute.conversation(change(own)) for c, own in by.items()}


def repaired(spark, data, width=None):
    df = spark.createDataFrame([(*row, "d", 0.5) for row in data], CONV)
    got = conversations.repair(df).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r[v] for v in VALUES) for r in got}


def unharmed(rows):
    digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    rows = [(c, t, " " if a is None else a, " " if b is None else b) for c, t, a, b in rows]
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), digest(r)))


def test_repairs_match_brute_force(spark):
    data = random_conversations(random.Random(7), 400, 14)
    assert repaired(spark, data) == expected(data, unharmed)


def test_one_conversation_over_many_sections(spark, monkeypatch):
    """A conversation that holds most rows is solved by pieces, with the same result."""
    r = random.Random(8)
    data = [(5, r.choice([None, *range(400)]), r.choice(["user", "assistant", "system"]), r.choice(["a.", "b", "", f"{r.random()}!", f"{r.random()}"]))
            for _ in range(900)] + random_conversations(r, 9, 6)
    monkeypatch.setattr(conversations, "SECTION_ROWS", 60)
    entered, real = [], conversations._with

    def spy(sections, facts, how="inner"):
        if "entry" in facts.columns:
            entered.append(facts.count())
        return real(sections, facts, how)
    monkeypatch.setattr(conversations, "_with", spy)
    assert repaired(spark, data) == expected(data, unharmed)
    assert entered and entered[0] > 8  # so many sections of one conversation


def test_least_audits_of_ties():
    """Of equally cheap edits those with the least initials, read off for every state a section is entered in."""
    r = random.Random(9)
    kinds = ["whole", "whole", "truncated", "blank", "duplicate"]
    for _ in range(200):
        own = [(r.choice("usaaut"), r.choice(kinds)) for _ in range(r.randrange(12))]
        graph = conversations.OptimalArcs([(own, conversations.END, True)])
        path, end = graph.paths([(0, conversations.START)])[0]
        audit = "".join(e for _, e, _ in path)
        text = {"whole": "x.", "truncated": "x", "blank": ""}
        rows_, seen = [], 0
        for i, (role, kind) in enumerate(own):
            seen += kind == "duplicate"
            rows_.append((1, i, role, text.get(kind, "x.") if kind == "blank" else f"{i} {text.get(kind, 'x.')}"))
        if not seen:
            assert audit == brute.conversation(rows_)[6]
        assert end in (conversations.START, conversations.A)


def test_repairs_on_whole_tables(spark):
    source = spark.read.parquet(f"{SF}/conversations.parquet")
    data = [tuple(r) for r in source.select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[v] for v in VALUES) for r in QUERIES["op13_conversation_repair"](spark, SF).collect()}
    assert got == expected(data, brute.damage)


def test_damage_of_odd_rows(spark, tmp_path):
    data = random_conversations(random.Random(10), 300, 4) + [(900, t, "user", "x.") for t in range(3)] * 2
    spark.createDataFrame([(*row, "d", 0.5) for row in data], CONV).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r[v] for v in VALUES) for r in QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    expect = expected(data, brute.damage)
    assert got == expect
    assert any(v[-2] == "" and v[-1] == sha("") for v in expect.values())
    none = spark.createDataFrame([], CONV)
    assert conversations.repair(none).count() == 0 and damaged(none).count() == 0
