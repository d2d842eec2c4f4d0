"""The ``opN_<name>`` queries: each operator over its whole given table."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bytebpe, conversations, decontaminate, htmltext, langid, periodicruns, quality, sentencepiece, sharding, simhash,
               suffixdedup, topk, toxicity)
from .common import table
from .oracles import ORACLE_SQL  # noqa: F401

#: The public tokenizer model of the queries; the operators take any path.
TOKENIZER = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: The rank file of the byte-level BPE query and the pattern that goes with it.
BYTE_BPE = os.environ.get("BYTE_BPE_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the pattern those ranks were made with.
BYTE_BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, radius=3)
    return groups.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup_digest(table(spark, sf_dir, "documents"))


def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("id") % 100 == 0), 10)


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """For a tenth of the ids: the words from some place on repeat with a period."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodicruns.periodic_runs(table(spark, sf_dir, "documents"), periodic_tail)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"], (-r["start"]).alias("first"), (-r["period"]).alias("short"), r.alias("run"))))["run"]
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n")))
    return (found.withColumn("longest", longest)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
                    F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bytebpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE, BYTE_BPE_PATTERN, decoded=True)
    return tokens.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with every twentieth dropped, emptied, cut short, repeated or
    given to the user, by a hash of conversation and turn (NULLs: one space)."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), k.alias("k")).where("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("k") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    fixed = conversations.repair(damaged(rows)).withColumnRenamed("conv_id", "_conv")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(fixed, every["conv_id"].eqNullSafe(fixed["_conv"]), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_language_id": op6_language_id,
    "op7_sharding": op7_sharding,
    "op8_html_extraction": op8_html_extraction,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_top_k_search": op10_top_k_search,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_conversation_repair": op13_conversation_repair,
}
