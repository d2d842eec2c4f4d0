"""SimHash groups, suffix dedup, decontamination."""

import brute
import numpy as np
from support import PASSAGE, SF, by_id, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from funnelspark.llm import components, decontaminate, simhash, suffixdedup
from funnelspark.llm.queries import ORACLE_SQL, QUERIES


def test_simhash_matches_brute_force(spark, documents):
    got = QUERIES["op2_simhash_near_dedup"](spark, SF).orderBy("doc_id").collect()
    docs = documents.orderBy("doc_id").collect()
    fps = [brute.simhash(d.text) for d in docs]
    assert [r.fingerprint for r in got] == [f"{x:016x}" for x in fps]
    assert [r.component_id for r in got] == brute.groups(fps, [d.doc_id for d in docs])


def test_simhash_of_odd_rows(odd, empty):
    got = by_id(simhash.near_duplicates(odd), "doc_id", "fp", "component_id")
    fps = [brute.simhash(r[1]) for r in rows()]
    expect = zip([r[0] for r in rows()], np.array(fps, np.uint64).view(np.int64).tolist(), brute.groups(fps, [r[0] for r in rows()]))
    assert got == sorted(expect, key=lambda r: tuple((x is not None, x) for x in r))
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids == sorted(set(brute.groups(fps, [r[0] for r in rows()])) - {None})
    assert kept.where("doc_id is null").count() == 2


def test_one_id_over_many_texts(spark):
    """Every group keeps one row, also where its documents share an id."""
    texts = [" ".join(f"{a}{(i * 31 + j * j) % 97}" for j in range(40)) for i, a in enumerate("abcdefghijkl")]
    data = [(9, t) for t in texts] + [(9, texts[0]), (1, texts[1]), (20, texts[2]), (9, None)]
    fps = [brute.simhash(t) for _, t in data]
    assert len(set(brute.groups(fps, list(range(len(data)))))) == len(texts) + 1
    kept = simhash.keep_one(spark.createDataFrame(data, "doc_id long, text string").repartition(3))
    expect = [(1, texts[1]), (9, None)] + [(9, t) for t in texts if t != texts[1]]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(expect, key=str)


def test_chains_and_hot_shards(spark):
    """A chain of 3-bit steps is one group, in whatever trees its shards are cut."""
    fps = [0]
    for i in range(20):
        fps.append(fps[-1] ^ (0b111 << (3 * i)))
    fps += [0xFFFF << 40 ^ i for i in range(60)] + [0x5555555555555555]
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").distinct()
    expect = brute.groups([np.uint64(r.fp % 2**64) for r in nodes.collect()], [r.fp for r in nodes.collect()])
    for shard_rows in (1 << 16, 7):
        roots = {r.node: r.root for r in components.components(simhash.links(nodes, 3, shard_rows)).collect()}
        got = [roots.get(r.fp, r.fp) for r in nodes.collect()]
        assert len(set(zip(got, expect))) == len(set(got)) == len(set(expect))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=40, unique=True), st.integers(0, 6), st.integers(1, 24))
def test_bk_tree(values, radius, width):
    v = np.array([x % (1 << width) for x in values], np.uint64)
    v = np.unique(v)
    got = {(n, int(q)) for n, qs in simhash.BKTree(v).search(v, radius) for q in qs}
    assert got == {(i, j) for i in range(len(v)) for j in range(len(v)) if int(v[i] ^ v[j]).bit_count() <= radius}


def test_suffix_dedup_matches_brute_force(spark, documents):
    got = QUERIES["op9_suffix_array_dedup"](spark, SF).orderBy("doc_id").collect()
    expect = brute.repeats([(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()])
    assert [tuple(r)[1:] for r in got] == [x[:4] for x in expect]


def test_suffix_dedup_of_odd_rows(odd, empty):
    named = sorted((r for r in rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = suffixdedup.dedup_digest(odd)
    assert got.count() == len(named) and suffixdedup.dedup_digest(empty).count() == 0
    # Rows that repeat an id have no order of their own: leave them out of the exact comparison.
    ids = [r[0] for r in named]
    some = [r for r in named if ids.count(r[0]) == 1]
    got = suffixdedup.dedup_digest(odd.where(odd.doc_id.isin([r[0] for r in some])))
    assert by_id(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(
        (r[0], *x[:4]) for r, x in zip(some, brute.repeats([r[:2] for r in some])))
    kept = suffixdedup.remove_repeats(odd)
    assert kept.schema == odd.schema
    assert kept.where("doc_id = 8").count() == 0  # whole copies of the passage of -3
    assert suffixdedup.remove_repeats(empty).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["ab" * 30, "c" * 55, "é" * 40, PASSAGE, "x", "yz" * 70]), max_size=5).map("".join), min_size=1, max_size=6))
def test_suffix_dedup_of_generated_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = [tuple(r)[1:] for r in suffixdedup.dedup_digest(df).orderBy("doc_id").collect()]
    assert got == [x[:4] for x in brute.repeats(list(enumerate(texts)))]


def test_leaks_match_brute_force(spark, documents):
    got = {tuple(r) for r in QUERIES["op4_benchmark_decontamination"](spark, SF).collect()}
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    assert got == brute.leaks([(d.doc_id, d.text) for d in documents.collect()], [(b.item_id, b.text) for b in items],
                              set(decontaminate.UNITS))


def test_rewritten_questions(spark):
    items = spark.createDataFrame([
        (1, "Yesterday we saw Alice buy 12 apples at 3 euros each, then Alice gave 12 of them away; what did it cost?"),
        (2, "too short"), (None, "a b c d e f g h"), (3, None), (4, "")], "item_id long, text string")
    q = "Yesterday we saw {0} buy {1} apples at {2} {3} each, then {4} gave {5} of them away; what did it cost?"
    docs = spark.createDataFrame([
        (10, "Intro. " + q.format("Alice", 12, 3, "euros", "Alice", 12) + " End."),
        (11, q.format("Robert", "1,500", 7, "dollars", "Robert", "1,500")),
        (12, q.format("Robert", 15, 7, "dollars", "Maria", 99)),  # slots do not agree with each other
        (13, q.format("Alice", 12, 3, "euros", "Alice", 12).upper()),
        (14, "Yesterday we saw a film about apples at the sea; what did it cost?"),
        (15, None), (None, q.format("Alice", 12, 3, "euros", "Alice", 12)), (10, "again")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.reworded for r in decontaminate.leaks(docs, items).collect()}
    assert got[(10, 1)] is False and got[(11, 1)] is True
    assert not {k for k in got if k[0] in (12, 14, 15, None)} and not {k for k in got if k[1] != 1}
    kept = decontaminate.drop_contaminated(docs, items)
    assert {r.doc_id for r in kept.collect()} == {12, 13, 14, 15, None}
    shuffled = decontaminate.leaks(docs, items, broadcast_windows=0)
    assert {(r.doc_id, r.item_id): r.reworded for r in shuffled.collect()} == got


def test_conflicting_slots_take_only_their_own_windows(spark):
    w = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    w[20] = w[40] = "12"
    text = " ".join(w)
    two = "one box holds 12 red balls and then " + " ".join(w[:20]) + " the other box holds 15 blue balls of the same kind"
    items = spark.createDataFrame([(1, text), (2, two)], "item_id long, text string")
    reworded = " ".join("77" if x == "12" else x for x in w)
    docs = spark.createDataFrame([
        (10, " ".join([*w[:40], "13", *w[41:]])),  # one of two equal numbers edited
        (11, two.replace("12", "9").replace("15", "9")),  # two parameters became equal
        (12, text), (12, reworded),  # two texts under one id
        (13, " ".join(w[:32])), (13, " ".join(w[28:])),  # two halves: no text holds it
        (14, reworded)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.matched, r.places, r.reworded) for r in decontaminate.leaks(docs, items).collect()}
    n = len(two.split()) - 4
    assert got == {(10, 1): (51, 56, False), (11, 2): (n, n, True), (12, 1): (56, 56, False), (14, 1): (56, 56, True)}
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()} == {13}


def test_decontamination_of_odd_rows(odd, empty, spark):
    items = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE)], "item_id long, text string")
    got = {r.doc_id for r in decontaminate.leaks(odd, items).collect()}
    assert got == {6, 7, 8, -3} | ({15} if 15 in got else set()) and 0 not in got
    kept = decontaminate.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.where("doc_id is null").count() == 2
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(odd, none).count() == decontaminate.leaks(empty, items).count() == 0
    assert decontaminate.drop_contaminated(odd, none).count() == odd.count()


def test_leaks_of_edited_copies_match_brute_force_and_sql(spark):
    """Copies of items with words, numbers and names replaced, number tables, negative offsets, repeated ids."""
    import random

    import duckdb

    r = random.Random(12)
    words = ["alpha", "beta", "Gamma", "delta", "12", "7", "3.5", "kg", "12kg", "Rome", "and", "of", "the.", "so", "1"]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([4, 5, 9, 30])))) for i in range(25)]
    items += [(90, " ".join(str(i % 4) for i in range(40))), (91, "1 2 3 4 5 6 7 8 9 sum of them all is what number"), (3, items[5][1])]
    docs = []
    for d in range(160):
        own = r.choice(items)[1].split()
        for _ in range(r.randrange(5)):
            own[r.randrange(len(own))] = r.choice(words)
        cut = r.randrange(3) if len(own) > 8 else 0
        docs.append((d if d % 10 else d // 20, " ".join([*(r.choice(words) for _ in range(r.randrange(6))), *own[cut:], *(r.choice(words) for _ in range(r.randrange(6)))])))
    docs += [(500, " ".join(str(i) for i in range(300))), (501, "4 3 2 9 5 6 7 8 1 sum of them all is what number")]
    expect = brute.leaks(docs, items, set(decontaminate.UNITS))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert len(expect) > 30 and {tuple(x) for x in decontaminate.leaks(d, b).collect()} == expect
    assert {tuple(x) for x in decontaminate.leaks(d, b, broadcast_windows=0, broadcast_texts=0).collect()} == expect
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    con.register("benchmark", b.toPandas())
    got = con.sql(ORACLE_SQL["op4_benchmark_decontamination"])
    assert {tuple(x) for x in got.select("doc_id, item_id, matched, places, reworded").fetchall()} == expect


def test_windows_carry_no_words(spark):
    """The rows that the join meets are an id, hashes and a place: linear in a text's length."""
    made = decontaminate.windows(decontaminate.templates(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), "doc_id", 5), 5)
    assert dict(made.dtypes) == {"id": "bigint", "key": "bigint", "place": "int", "window": "bigint"} and made.count() == 2
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate" in line)
    assert "[2, 3], false, [place" in generate  # of id, key, words and types the last two do not go through
