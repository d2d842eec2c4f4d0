"""Corpus preparation: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``:

* language ID: rows rejected by the language model go;
* SimHash near-dedup: one row of each group stays (three words, three bits);
* suffix-array dedup: bytes covered by a repeated 100-byte string go, and rows
  of which nothing is left;
* benchmark decontamination: rows that hold a benchmark item go;
* SentencePiece encoding: doc_id, ids, n_tokens, round_trip.
"""

from funnelspark.llm import decontaminate, langid, sentencepiece, simhash, suffixdedup
from funnelspark.llm.common import ship, table, written
from funnelspark.llm.queries import TOKENIZER


def language_id(spark, docs, sf_dir):
    ship(spark)
    return langid.keep_identified(docs)


def simhash_near_dedup(spark, docs, sf_dir):
    ship(spark)
    return simhash.keep_one(docs, size=3, radius=3)


def suffix_array_dedup(spark, docs, sf_dir):
    ship(spark)
    return suffixdedup.remove_repeats(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark, docs, sf_dir):
    ship(spark)
    return sentencepiece.encode(docs, TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: Trained models, fingerprints and merges are not SQL; tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
