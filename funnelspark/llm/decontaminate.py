"""Benchmark decontamination by template canonicalisation.

Texts of documents and benchmark items become templates: lower-case words
without marks, in which numbers, numbers with a unit, units after a number, and
names (a capitalised word inside a sentence) are typed placeholders.  Windows
of ``width`` template words are hashed and hash-joined, so a question whose
numbers, names or units were replaced still matches; windows of placeholders
only are hashed by their own words, as any table of numbers has the template of
any other.  A match is a place for the item in the text (an offset).  There the
two are laid side by side, word by word: which windows have the same template,
and what the slots hold.  One slot value of the item stands for one value of
the text, the most frequent there (the first of equals), and windows with
another value of it do not count.  Windows that are equal word for word count
whatever the slots say.  A document holds an item when windows over at least
``share`` of the item's places match.

DataFrame expressions only: no Python runs on the executors.  What is joined is
a text's id, hash, place and window hash, no words: with the benchmark's windows
as a broadcast table as long as those are at most ``broadcast_windows`` (counted
first), beyond that by shuffle.  Only the texts with a match, found by id and
hash, are then taken apart again; the matches (a written table) are broadcast to
them as long as they are of at most ``broadcast_texts`` texts, beyond that the
join shuffles.  The work is linear in the length of a text.

Defined results: NULL and empty texts have no windows; items of fewer than
``width`` words never match (they are no passage); rows with a NULL id on
either side are left out; rows that repeat an id are judged text by text, and
the text with the most matched places gives the result of the id; empty tables
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Units of measure that follow a number or are written onto it.
UNITS = """mm cm m km inch inches ft feet foot yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound
    pounds oz ounce ounces ton tons tonne tonnes ml l liter liters litre litres gallon gallons s sec secs second seconds
    min mins minute minutes h hr hrs hour hours day days week weeks month months year years mph kmh kph percent degree
    degrees dollar dollars cent cents euro euros usd eur gbp hz khz mhz ghz kb mb gb tb w kw mw v kv a j kj cal kcal n
    k pa kpa bar mol""".split()
NAME, WIDTH, SHARE = "\u0002", 5, 0.8
BROADCAST_WINDOWS, BROADCAST_TEXTS = 500_000, 200_000


def template_words(text: Column | str) -> Column:
    """array<string>: lower-case words without marks; a leading U+0002 marks a name."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    c = F.replace(c, F.lit(NAME), F.lit(" "))
    c = F.regexp_replace(c, r"([^.!?\s] )(\p{Lu}\p{Ll})", f"$1{NAME}$2")
    c = F.regexp_replace(c, r"([0-9])[.,]([0-9])", "$1_$2")
    c = F.trim(F.lower(F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}_{NAME}]+", " ")))
    return F.split(c, " ")  # words stand one space apart; an empty text gives one empty word


def slot_types(words: str) -> Column:
    """array<long> beside the words: 1 number, 2 name, 3 number with unit, 4
    unit after a number; a hash of the word for a plain word."""
    rest = "translate(w, '0123456789_', '')"
    units = ", ".join(f"'{u}'" for u in UNITS)
    return F.expr(f"""transform({words}, (w, i) -> case
        when w >= '0' and w < ':' then case when {rest} = '' then 1L when {rest} in ({units}) then 3L else xxhash64(w) end
        when startswith(w, '{NAME}') then 2L
        when w in ({units}) and i > 0 and {words}[i - 1] >= '0' and {words}[i - 1] < ':' then 4L
        else xxhash64(w) end)""")


def templates(texts: DataFrame, id_col: str, width: int) -> DataFrame:
    """id, key (of the text), words, types of the texts that have a window."""
    t = texts.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64("text").alias("key"), template_words("text").alias("words"))
    return t.where(F.size("words") >= width).select("id", "key", "words", slot_types("words").alias("types"))


def windows(texts: DataFrame, width: int, *more: str) -> DataFrame:
    """id, key, place, window (a hash) of each template window, and ``more`` of the columns."""
    one = lambda of: ", ".join(f"{of}[i + {k}]" for k in range(width))
    slots = " and ".join(f"types[i + {k}] between 1 and 4" for k in range(width))
    made = F.expr(f"transform(sequence(0, size(types) - {width}), i -> if({slots}, xxhash64({one('words')}), xxhash64({one('types')})))")
    return texts.select("id", "key", *more, F.posexplode(made).alias("place", "window"))


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _agreeing(wins: str) -> Column:
    """The windows of one offset without those, not equal word for word, that
    have a minority value of a slot."""
    same = lambda a, b: (a["kind"] == b["kind"]) & (a["theirs"] == b["theirs"])
    value = lambda s: F.struct(s["kind"].alias("kind"), s["theirs"].alias("theirs"), s["ours"].alias("ours"))

    def votes(slots):
        def one(v):
            at = F.transform(F.filter(slots, lambda s: value(s) == v), lambda s: s["k"])
            return _let(at, lambda a: F.struct(
                v["kind"].alias("kind"), v["theirs"].alias("theirs"), v["ours"].alias("ours"), F.struct(
                    F.size(a).alias("n"), (-F.array_min(a)).alias("first")).alias("rank")))

        return F.transform(F.array_distinct(F.transform(slots, value)), one)

    def without(lost):
        return F.filter(wins, lambda w: w["literal"] | ~F.exists(w["slots"], lambda s: F.array_contains(lost, value(s))))

    slots = F.array_distinct(F.flatten(F.transform(wins, lambda w: w["slots"])))
    lost = _let(_let(slots, votes), lambda vs: F.transform(
        F.filter(vs, lambda v: F.exists(vs, lambda o: same(o, v) & (o["rank"] > v["rank"]))), value))
    return _let(lost, without)


def _alike(width: int) -> Column:
    """The windows that have the same template in an item (``theirs``, ``kinds``)
    and in the text's words from ``from`` on: place, literal, worded, slots."""
    # A struct for each word of the item; equal types are equal words or slots of one type.
    laid = F.expr("""transform(theirs, (w, j) -> struct(j as k, kinds[j] as kind, w as theirs, get(words, j + from) as ours,
        coalesce(kinds[j] = get(types, j + from), false) as same))""")

    def windows_of(laid_):
        held = lambda p: F.slice(laid_, p + 1, F.lit(width))
        whole = F.filter(F.sequence(F.lit(0), F.size(laid_) - width), lambda p: F.forall(held(p), lambda x: x["same"]))
        return F.transform(whole, lambda p: F.struct(
            p.alias("place"), F.forall(held(p), lambda x: x["theirs"] == x["ours"]).alias("literal"),
            F.exists(held(p), lambda x: ~x["kind"].between(1, 4)).alias("worded"),
            F.transform(F.filter(held(p), lambda x: x["kind"].between(1, 4)), lambda x: F.struct(
                x["k"].alias("k"), x["kind"].alias("kind"), x["theirs"].alias("theirs"), x["ours"].alias("ours"))).alias("slots")))

    return _let(laid, windows_of)


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: float = SHARE,
          broadcast_windows: int = BROADCAST_WINDOWS, broadcast_texts: int = BROADCAST_TEXTS) -> DataFrame:
    """doc_id, item_id, matched (places of the item's windows found), places
    (all of them), reworded (some slot differs)."""
    items = templates(benchmark, "item_id", width).dropDuplicates(["id", "key"]).withColumn("item", F.xxhash64("id", "key"))
    n_windows, longest = items.agg(F.sum(F.size("words") - (width - 1)), F.max(F.size("words"))).first()
    small = F.broadcast if (n_windows or 0) <= broadcast_windows else lambda df: df
    seeds = windows(items, width, "item").select("item", F.col("place").alias("item_place"), "window")
    met = windows(templates(docs, "doc_id", width), width).join(small(seeds), "window")
    met = met.select("id", "key", "item", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    # At most as many offsets for a text as its windows have matches.
    found = written(met.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(
        F.collect_set(F.struct("item", "shift")).alias("at")), "decontamination-matches")
    found = F.broadcast(found) if found.count() <= broadcast_texts else found
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    texts = texts.join(found, (F.col("doc_id") == F.col("_id")) & (F.col("key") == F.col("_key")))
    texts = texts.select("doc_id", "key", "at", template_words("text").alias("words"))
    texts = texts.select("doc_id", "key", "at", "words", slot_types("words").alias("types"))
    # Each offset takes its own stretch of the text along, as long as the longest item.
    stretch = F.expr(f"""transform(at, a -> struct(a.item as item, least(a.shift, 0) as from,
        slice(words, greatest(a.shift, 0) + 1, {longest or 0}) as words, slice(types, greatest(a.shift, 0) + 1, {longest or 0}) as types))""")
    sides = items.select("item", F.col("id").alias("item_id"), F.col("words").alias("theirs"), F.col("types").alias("kinds"))
    laid = texts.select("doc_id", "key", F.explode(stretch).alias("a")).select("doc_id", "key", "a.*").join(small(sides), "item")
    text = ["doc_id", "key", "item", "item_id", "places"]
    places = (F.size("theirs") - (width - 1)).alias("places")
    offsets = laid.select(*text[:4], places, _alike(width).alias("wins"))
    offsets = offsets.where(F.exists("wins", lambda w: w["worded"] | w["literal"])).select(*text, _agreeing("wins").alias("wins"))
    whole = offsets.groupBy(*text).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("wins.place")))).alias("matched"),
        F.max(F.exists("wins", lambda w: ~w["literal"])).alias("reworded"))
    # Of the texts of an id the one with the most places, the literal one of equals.
    best = (whole.where(F.col("matched") >= F.lit(share) * F.col("places")).groupBy("doc_id", "item_id", "places")
            .agg(F.max(F.struct("matched", (~F.col("reworded")).alias("literal"))).alias("best")))
    return best.select("doc_id", "item_id", "best.matched", "places", (~F.col("best.literal")).alias("reworded"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item (rows without an id stay)."""
    bad = leaks(docs, benchmark, width, share).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["_bad"], "left_anti")
