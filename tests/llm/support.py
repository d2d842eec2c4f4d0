"""Rows and helpers that the tests of this folder share."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns whose names the operators use themselves
    T.StructField("fp", T.StringType()), T.StructField("chunk", T.StringType()), T.StructField("id", T.DoubleType()),
    T.StructField("words", T.StringType()), T.StructField("_id", T.StringType()), T.StructField("first", T.StringType())])
PASSAGE = ("the quick brown fox jumps over the lazy dog while seven wizards brew 12 potions in quiet towers by the sea "
           "and nobody minds the noise of the waves")


def rows():
    en = "the river runs down to the sea and the old mill turns slowly in the wind of the evening"
    de = "der fluss läuft hinab zum meer und die alte mühle dreht sich langsam im wind des abends"
    texts = [
        (0, en, "en"), (1, de, "de"), (2, None, "en"), (3, "", "de"), (4, " \t\n ", None), (5, "12 34 !!", "en"),
        (6, en + " " + PASSAGE, "en"), (7, de + " " + PASSAGE, "de"), (8, PASSAGE, None), (8, PASSAGE, None),
        (9, en, "en"), (9, en + " again", "en"), (None, en, "en"), (None, None, None), (10, "A", "en"),
        (11, "aaaa" * 60, "en"), (12, " ".join([en] * 700), "en"), (13, "x" * 70_000, "de"), (14, "日本語 \U0001F600 ▁\x00", "ja"),
        (15, PASSAGE.replace("fox", "cat"), "en"), (-3, PASSAGE, "en"), (16, en.upper(), "en")]
    return [(i, t, lang, f"src{n % 3}", len(t or ""), "f", None, 0.5, "w", "i", None) for n, (i, t, lang) in enumerate(texts)]


def by_id(df, *cols):
    """Rows as tuples, sorted with NULLs first."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is not None, x) for x in r))
