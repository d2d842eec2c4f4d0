"""Sharding, top-k, HTML text, SentencePiece, the pipeline, the registry."""

import binascii
import math
import os
import subprocess
import sys

import brute
import corpus_pipeline
import duckdb
import pytest
import sentencepiece as sp
from support import SF, by_id, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from funnelspark.llm import decontaminate, htmltext, langid, sentencepiece, sharding, topk
from funnelspark.llm.queries import ORACLE_SQL, QUERIES, TOKENIZER


def test_shards_are_even_whole_and_gapless(spark, documents):
    got = QUERIES["op7_sharding"](spark, SF).collect()
    text = {r.doc_id: r.text for r in documents.collect()}
    assert sorted(r.doc_id for r in got) == sorted(text)
    for r in got:
        b = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(b) + 1, binascii.crc32(b)) and r.law == "bytes" and r.grown_shard is None
    mean, largest = sum(r.size for r in got) / 8, max(r.size for r in got)
    for k in range(8):
        own = [r for r in got if r.shard == k]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - mean) <= 0.01 * mean + largest
    assert len({(r.text_crc32, r.shard) for r in got}) == len({r.text_crc32 for r in got})


def test_a_hot_group_is_split_evenly(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "if(id % 3 < 2, 'same text', repeat('x', cast(id % 50 as int))) as text")
    got = sharding.shard(docs, 8).groupBy("shard").sum("size").collect()
    mean = sum(r[1] for r in got) / 8
    assert len(got) == 8 and all(abs(r[1] - mean) <= 0.02 * mean + 50 for r in got)


def test_sharding_of_odd_rows(odd, empty):
    got = sharding.shard(odd, 4)
    assert by_id(got, "doc_id", "size") == sorted(((r[0], len((r[1] or "").encode()) + 1) for r in rows()),
                                                  key=lambda r: tuple((x is not None, x) for x in r))
    assert sharding.shard(empty, 4).count() == 0
    assert {r.shard for r in sharding.shard(odd, 1).collect()} == {0}


def test_top_k_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as from '{SF}/embeddings.parquet'")
    expect = con.sql(ORACLE_SQL["op10_top_k_search"])
    got = QUERIES["op10_top_k_search"](spark, SF)
    assert sorted(map(tuple, got.select(*expect.columns).collect())) == sorted(expect.fetchall())


def test_top_k_of_odd_vectors(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0, -1.0]), (1, [1.0, 0.0, -1.0]), (2, [0.0, 0.0, 0.0]), (3, None), (4, [1.0, None, 2.0]), (5, [nan, 1.0, 1.0]),
            (6, [inf, 0.0, 0.0]), (7, []), (8, [2.0]), (9, [0.0009, 0.5, 0.5]), (9, [0.0009, 0.5, 0.5]), (None, [1.0, 1.0, 1.0]),
            (100, [-0.5, 2.5, 0.25]), (200, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(3)
    v = topk.integer_vectors(df, "vec_id", "embedding")
    ok = [(i, [math.floor(1024 * x) for x in e]) for i, e in data
          if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    ints = {}
    for r in v.collect():
        ints.setdefault(r.id, []).append(list(r.v))
    assert sorted((i, len(e)) for i, e in ok) == sorted((i, len(e)) for i, es in ints.items() for e in es)

    def expect(k):
        out = []
        for q in (0, 100, 200):
            scored = sorted((-sum(a * b for a, b in zip(ints[q][0], e)), i) for i, es in ints.items() if i != q for e in es)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
        return sorted(out)

    for block in (32_768, 2):  # one block of queries, or several
        monkeypatch.setattr(topk, "QUERY_BLOCK", block)
        for k in (3, 50):
            assert sorted(map(tuple, topk.top_k(v, v.where("id % 100 = 0"), k).collect())) == expect(k)
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op4_benchmark_decontamination", "op9_suffix_array_dedup"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as from '{SF}/{t}.parquet'")
    expect = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(expect.columns)
    assert sorted(map(tuple, got.select(*expect.columns).collect())) == sorted(expect.fetchall())


def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><p>Site header with a slogan that is quite long really</p></header><nav><ul><li><a href=x>Home</a></ul></nav>
    <div class="cookie-notice">We use cookies on this site, please agree to all of them now.</div>
    <div id=content><article><header><h1>A &amp; B</h1></header><p>First <b>bold</b>
    part&nbsp;one, which goes on for a while so that it counts as content.<p>Second&#33;<br>line <i>two</i></p><p>Of.</p>
    <aside>Related stuff</aside><form><label>Name</label><input></form><ul><li>point one<li>point two</ul></article></div>
    <section class="comments"><p>First! a reader's comment that is long enough to look like content, at least a bit.</p></section>
    <div class="sidebar"><p>More news of the day</p></div><footer>&copy; 2020</footer>"""
    assert htmltext.main_text(page) == ("A & B\nFirst bold part one, which goes on for a while so that it counts as content.\n"
                                        "Second! line two\nOf.\npoint one\npoint two")
    plain = "<div class='menu'><a>x</a></div><div><p>" + "Some words of the text. " * 5 + "</p><p>Short.</p></div><div id=footer>c</div>"
    assert htmltext.main_text(plain) == ("Some words of the text. " * 5).strip() + "\nShort."
    for bad in (None, "", "<", "<p", "<!--", "<script>", "</div></div>", "<nav>a</nav>", "<![CDATA[x", "<p><p><p>"):
        assert isinstance(htmltext.main_text(bad), str)
    assert htmltext.main_text("just text") == "just text"


def test_main_text_without_an_article():
    """Furniture inside a container, very uneven and short paragraphs lose no line."""
    ad = '<div class="ad">Buy now, this is a very good offer</div>'
    five = [f"{i} " + "word " * 59 + "end" for i in range(5)]
    for last in ("long " * 4000 + "end", "long " * 400 + "end", "A closing line of about forty characters"):
        lines = ["Heading", *five, last]
        for top in ("<body>{}</body>", "<body><div id=content>{}</div></body>", "<body><nav><a>x</a></nav><div>{}</div><footer>c</footer></body>"):
            inner = "<h1>Heading</h1>" + "".join(f"<p>{x}</p>" for x in five) + ad + f"<p>{last}</p>"
            assert htmltext.main_text(top.format(inner)) == "\n".join(lines)
    # In a list, and in containers of their own around the advert.
    inner = "".join(f"<p>{x}</p>" for x in five) + "<ul><li>one<li>two</ul>" + ad + "<section><p>Last words.</p></section>"
    assert htmltext.main_text(f"<div>{inner}</div>") == "\n".join([*five, "one", "two", "Last words."])
    parts = [f"<div><p>{five[0]}</p></div>", ad, "<div><p>" + "long " * 4000 + "</p></div>"]
    assert htmltext.main_text("<body>" + "".join(parts) + "</body>") == five[0] + "\n" + ("long " * 4000).strip()


def test_main_text_inside_marked_wrappers():
    text = "Some words of the text that go on for a while. " * 8
    body = f"<h1>Heading</h1><p>{text}</p><p>Short.</p>"
    expect = f"Heading\n{text.strip()}\nShort."
    for mark in ('id="page" class="has-sidebar"', 'class="content no-comments"', 'class="layout-with-sidebar"',
                 'class="search-results"', 'class="post-form"'):
        for inner in (body, f"<article>{body}</article>", f"<main><article>{body}</article></main>"):
            page = f"<body><nav>a</nav><div {mark}>{inner}<div class=comments><p>A reader says so.</p></div></div><footer>c</footer></body>"
            assert htmltext.main_text(page) == expect, (mark, inner[:9])
    for start in ("<form><input>", "<button>Go"):  # never closed
        assert htmltext.main_text(f"<body><div>{start}</div><div>{body}</div></body>") == expect
    assert htmltext.main_text(f"<body><form id=all>{body}</form></body>") == expect
    # Comments marked up as articles stay out beside the article itself.
    assert htmltext.main_text(f"<article>{body}</article><div class=comments><article><p>{text}</p></article></div>") == expect


def test_pages(spark):
    got = {r.page_id: r for r in QUERIES["op8_html_extraction"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert set(got) == {p.page_id for p in pages} and all(r.n_chars == len(r.text) and r.text for r in got.values())
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "y"), (1, "u", "<p>a</p>", "z")], "page_id long, url string, html string, text string")
    assert by_id(htmltext.extract(odd), "page_id", "url", "text", "n_chars") == [(None, None, "", 0), (1, "u", "", 0), (1, "u", "a", 1)]
    assert htmltext.extract(odd.limit(0)).count() == 0


@pytest.fixture(scope="module")
def library():
    return sp.SentencePieceProcessor(model_file=TOKENIZER)


@pytest.fixture(scope="module")
def encoder():
    return sentencepiece.Encoder(sentencepiece.Vocabulary(TOKENIZER))


def test_encoding_matches_the_library(spark, documents, library):
    got = {r.doc_id: r for r in QUERIES["op3_sentencepiece"](spark, SF).collect()}
    for d in documents.collect():
        assert list(got[d.doc_id].ids) == library.encode(d.text) and got[d.doc_id].round_trip
        assert got[d.doc_id].n_tokens == len(got[d.doc_id].ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="  ab\nthe▁ing", max_size=80)), max_size=4))
def test_encoding_of_generated_texts(encoder, library, texts):
    ids, counts = encoder.encode(texts)
    expect = [library.encode(t) for t in texts]
    assert ids.tolist() == [i for e in expect for i in e] and counts.tolist() == [len(e) for e in expect]
    assert encoder.decode(ids, counts) == [t.replace("▁", " ") for t in texts]


def test_encoding_of_odd_rows(odd, empty, library):
    out = sentencepiece.encode(odd, TOKENIZER)
    assert by_id(out, "doc_id", "ids") == sorted(((r[0], library.encode(r[1] or "")) for r in rows()),
                                                 key=lambda r: tuple((x is not None, x) for x in r))
    assert out.where("not round_trip").count() == 0
    back = by_id(sentencepiece.decode(out, TOKENIZER), "doc_id", "text")
    assert back == sorted(((r[0], (r[1] or "").replace("▁", " ")) for r in rows()), key=lambda r: tuple((x is not None, x) for x in r))
    assert sentencepiece.encode(empty, TOKENIZER).count() == 0


def test_pipeline_matches_brute_force(spark, documents, library):
    docs = documents
    for (name, stage), check in zip(corpus_pipeline.STAGES, (lang_kept, one_each, cut, uncontaminated, encoded), strict=True):
        before = sorted(docs.collect(), key=lambda r: r.doc_id)
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == documents.columns
        docs = out.cache()
        check(spark, before, sorted(docs.collect(), key=lambda r: r.doc_id), library)
    assert by_id(corpus_pipeline.run(spark, SF), "doc_id", "ids") == by_id(docs, "doc_id", "ids")


def lang_kept(spark, before, after, _):
    ok = {r.doc_id for r in langid.identify(spark.createDataFrame(before)).where("not rejected").collect()}
    assert [r.doc_id for r in after] == [r.doc_id for r in before if r.doc_id in ok]


def one_each(spark, before, after, _):
    least = brute.groups([brute.simhash(r.text) for r in before], [r.doc_id for r in before])
    assert after == [r for r, g in zip(before, least) if r.doc_id == g]


def cut(spark, before, after, _):
    kept = [(r.doc_id, x[4].decode("utf-8", "ignore")) for r, x in zip(before, brute.repeats([(r.doc_id, r.text) for r in before]))]
    assert [(r.doc_id, r.text) for r in after] == [x for x in kept if x[1]]
    assert all(r.n_chars == len(r.text) for r in after)


def uncontaminated(spark, before, after, _):
    items = [(b.item_id, b.text) for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {x[0] for x in brute.leaks([(r.doc_id, r.text) for r in before], items, set(decontaminate.UNITS))}
    assert after == [r for r in before if r.doc_id not in bad]


def encoded(spark, before, after, library):
    assert [(r.doc_id, list(r.ids)) for r in after] == [(r.doc_id, library.encode(r.text)) for r in before]


def test_pipeline_takes_odd_rows(spark, odd, empty):
    for start in (odd, empty):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.count()


def test_registry_without_this_part(tmp_path):
    """The entry module still works when this folder and the pipeline are gone."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for f in os.listdir(root):
        if f.startswith((".", "corpus_pipeline")) or f in ("tests", "spark-warehouse", "__pycache__"):
            continue
        if f != "funnelspark":
            os.symlink(f"{root}/{f}", tmp_path / f)
    (tmp_path / "funnelspark").mkdir()
    for f in os.listdir(f"{root}/funnelspark"):
        if f not in ("llm", "__pycache__"):
            os.symlink(f"{root}/funnelspark/{f}", tmp_path / "funnelspark" / f)
    code = "import sys; sys.path.insert(0, '.'); exec(open('__spark_entry__.py').read().replace('os.path.abspath(__file__)', 'os.path.abspath(\"x\")')); print(len(queries()), [q for q in queries() if q.startswith('op') and q[2].isdigit()])"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert out.returncode == 0 and out.stdout.strip().endswith("[]"), out.stderr[-800:]


def test_rows_equal_in_id_and_text_are_split_by_place(spark):
    docs = spark.range(6000).selectExpr("if(id % 3 < 2, 7L, id) as doc_id", "if(id % 3 < 2, 'the same text', repeat('x', cast(id % 50 as int))) as text")
    got = sharding.shard(docs, 8).cache()
    by = got.groupBy("shard").agg({"size": "sum", "slot": "max", "*": "count"}).collect()
    mean = sum(r["sum(size)"] for r in by) / 8
    assert len(by) == 8 and all(abs(r["sum(size)"] - mean) <= 0.02 * mean for r in by)
    assert all(r["max(slot)"] == r["count(1)"] - 1 for r in by) and got.select("shard", "slot").distinct().count() == 6000
    same = spark.range(1000).selectExpr("1L as doc_id", "'x' as text")
    assert sorted(r["count"] for r in sharding.shard(same, 3).groupBy("shard").count().collect()) in ([333, 333, 334], [333, 334, 333])


def test_query_rows_that_share_an_id_are_ranked_by_themselves(spark, monkeypatch):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [0.5, 2.0]), (2, [3.0, 0.25])],
                               "vec_id long, embedding array<double>").repartition(3)
    v = topk.integer_vectors(df, "vec_id", "embedding")
    m = 1024 * 1024
    expect = sorted([(0, 1, 2, 3 * m), (0, 2, 1, m // 2)] + 2 * [(0, 1, 1, 2 * m), (0, 2, 2, m // 4)])
    for block in (32_768, 2, 1):  # also when one id fills more than a block
        monkeypatch.setattr(topk, "QUERY_BLOCK", block)
        assert sorted(map(tuple, topk.top_k(v, v.where("id = 0"), 5).collect())) == expect


LONG = "A paragraph of the text itself that goes on for quite a while, with a point to make and another one after it. "


def test_names_of_texts_do_not_remove_them():
    """Listed words in ids of headings, paragraphs and topics are the author's; those of layout are the page's."""
    page = f"""<body><nav>x</nav><article><h1 id="menu-planning">Menu planning</h1><p class="alert-systems">{LONG}</p>
    <section id="navigation-by-stars"><h2 id="comments">On comments</h2><p>{LONG}</p></section>
    <p class="ad">A short one.</p><div class="share-buttons">Share this</div><div class="related-articles">More</div>
    <section class="comments"><p>{LONG} says a reader</p></section></article></body>"""
    long = LONG.strip()
    assert htmltext.main_text(page) == f"Menu planning\n{long}\nOn comments\n{long}\nA short one."


def test_pages_without_an_article_are_judged_by_ratio(monkeypatch):
    """Link lists and imprints in classes that no list names go; short lines of the text stay."""
    links = "".join(f'<li><a href="/{i}">Topic {i}</a></li>' for i in range(8))
    page = f"""<body><div class="xq1"><ul>{links}</ul></div><div class="zz"><div class="k"><h2>The heading</h2></div><p>{LONG}</p><p>Short.</p>
    <div class="v"><p>In a box.</p></div><ul><li>one</li><li>two</li></ul><p>{LONG}</p></div>
    <div class="xq2"><ul>{links}</ul></div><div class="xq3">(c) 2020 Somebody</div></body>"""
    long = LONG.strip()
    expect = f"The heading\n{long}\nShort.\nIn a box.\none\ntwo\n{long}"
    assert htmltext.main_text(page) == expect
    flat = f"<div class='a'><p>{LONG}</p></div><div class='b'><p>Between.</p></div><div class='c'>{links}</div><div class='d'><p>{LONG}</p></div>"
    assert htmltext.main_text(flat) == f"{long}\nBetween.\n{long}"
    # The border between the clusters decides: with another one other lines are kept.
    monkeypatch.setattr(htmltext, "_threshold", lambda x: -1.0)
    assert "Topic 1" in htmltext.main_text(page) and "Somebody" in htmltext.main_text(page)
    monkeypatch.setattr(htmltext, "_threshold", lambda x: 1e9)
    assert htmltext.main_text(flat) == long
