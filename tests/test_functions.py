"""Label, text and null-semantics expressions on hand-made values."""

from pyspark.sql import functions as F

from funnelspark.functions import labels as L
from funnelspark.functions.nulls import filter_out, n_distinct_keep_null, not_in, ratio
from funnelspark.functions.text import initiation_label, normalize_search


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_percent_half_even_and_no_negative_zero(spark):
    assert one(spark, L.pct(F.lit(0.285))) == "28%"
    assert one(spark, L.pct(F.lit(0.125))) == "12%"
    assert one(spark, L.pct(F.lit(-0.004))) == "0%"
    assert one(spark, L.pct(F.lit(0.0))) == "0%"
    assert one(spark, L.pct(F.lit(-0.25))) == "-25%"
    assert one(spark, L.pct(F.lit(None).cast("double"))) is None


def test_comma_and_number(spark):
    assert one(spark, L.comma(F.lit(18401))) == "18,401"
    assert one(spark, L.comma(F.lit(999))) == "999"
    assert one(spark, L.comma(F.lit(1000))) == "1,000"
    assert one(spark, L.comma(F.lit(2.5))) == "2"
    assert one(spark, L.number(F.lit(2.25), 1, "m")) == "2.2m"
    assert one(spark, L.number(F.lit(-0.04), 1)) == "0.0"


def test_short_scale(spark):
    assert one(spark, L.short_scale(F.lit(18401))) == "18.4K"
    assert one(spark, L.short_scale(F.lit(1.5e6))) == "1.5M"
    assert one(spark, L.short_scale(F.lit(999))) == "999.0"
    assert one(spark, L.short_scale(F.lit(999), 1, unscaled_digits=0)) == "999"
    assert one(spark, L.short_scale(F.lit(30636), 0)) == "31K"


def test_timespan(spark):
    assert one(spark, L.timespan(F.lit(12.5), "mins")) == "12m"   # 750 s, half-even
    assert one(spark, L.timespan(F.lit(30.5), "secs")) == "30s"
    assert one(spark, L.timespan(F.lit(346.0), "secs")) == "6m"
    assert one(spark, L.timespan(F.lit(90.0), "mins")) == "2h"
    assert one(spark, L.timespan(F.lit(0.5), "secs")) == "500ms"


def test_normalize_search(spark):
    cases = {
        "  The  Red-Plate, Inc. ": "redplate",
        "red plate": "red plate",
        "Hot Ring LLC": "hot ring",
        "hot   ring": "hot ring",
        "Wal-Mart": "walmart",
        "The Co": "",
        "Costco": "costco",  # stop word only as a whole word
    }
    df = spark.createDataFrame([(k,) for k in cases], "q string")
    got = {r["q"]: r["c"] for r in df.select("q", normalize_search(F.col("q")).alias("c")).collect()}
    assert got == cases


def test_initiation_label(spark):
    df = spark.createDataFrame([("ApplicantClickedCBVInvitationLink",), ("ApplicantClickedGenericLink",),
                                ("ApplicantViewedAgreement",), (None,)], "e string")
    got = [r["i"] for r in df.select(initiation_label(F.col("e")).alias("i")).collect()]
    assert got == ["Invitation", "Clicked Generic Link", None, None]


def test_null_semantics(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert sorted(filter_out(df, F.col("x") == "a").collect(), key=str) == sorted(
        [("b",), (None,)], key=str)
    assert df.where(not_in("x", ["a"])).count() == 2      # NULL passes
    assert df.agg(n_distinct_keep_null("x")).first()[0] == 3
    assert df.agg(F.count_distinct("x")).first()[0] == 2
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, ratio(F.lit(0), F.lit(0))) is None
