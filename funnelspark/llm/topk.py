"""Exact top-k search by inner product, term at a time.

A stated query set is searched against every row.  Queries are sparse rows
(term, weight); they are cut into blocks of bounded size, and each block is
broadcast to one pass over the candidates.  A task turns each batch of
candidates into postings (per term the rows that have it and their weights),
scatters the weighted postings of a query's terms into a dense score array,
keeps the k best per query by partition selection, and merges them with what it
has kept from earlier batches.  Each task sends k rows per query at most; a
second selection over the tasks gives the result.

Components are first turned into floor(1024 * x); weights and scores are exact
64-bit integers, so the result does not depend on the order of sums.

Defined results: vectors that are NULL, or hold a NULL or non-finite component,
take no part (neither as query nor as candidate), nor do rows whose id is NULL;
vectors of unequal lengths are compared on their common terms; an empty vector
scores 0 with everything.  Rows with the query's own id are no candidates.
Ties go to the smaller id; repeated rows of an id each take a place, and query
rows that share an id are each ranked by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SCALE = 1024
#: Queries in one broadcast block, and score cells held at once in a task.
QUERY_BLOCK, CELLS = 32_768, 1 << 21


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, v: floor(1024 * x) of each component; rows that take no part go."""
    x = F.col(vec_col)
    whole = F.expr(f"forall({vec_col}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return (rows.where(F.col(id_col).isNotNull() & x.isNotNull() & whole)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda e: F.floor(e.cast("double") * SCALE).cast("long")).alias("v")))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Postings of a batch of list<long>: (term, rows that have it, weights)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    lens = np.diff(ends)
    row = np.repeat(np.arange(len(lens)), lens)
    term = np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lens)
    keep = flat != 0
    row, term, flat = row[keep], term[keep], flat[keep]
    order = np.argsort(term, kind="stable")
    row, term, flat = row[order], term[order], flat[order]
    cut = np.flatnonzero(np.diff(term)) + 1
    return [(int(t[0]), r, w) for t, r, w in zip(np.split(term, cut), np.split(row, cut), np.split(flat, cut)) if len(t)]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores of one query, ties to smaller ids."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= edge)  # all ties at the edge
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _search(queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, numbers, q_rows = queries.value
        step = max(256, CELLS // max(1, len(q_ids)))
        kept: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(q_ids)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids, postings = part.column(0).to_numpy(), dict((t, (r, w)) for t, r, w in _matrix(part.column(1)))
                for q, (terms, weights) in enumerate(q_rows):
                    scores = np.zeros(len(ids), np.int64)
                    for t, w in zip(terms, weights):
                        if (p := postings.get(int(t))) is not None:
                            if len(p[0]) == len(ids):
                                scores += w * p[1]
                            else:
                                scores[p[0]] += w * p[1]
                    other = ids != q_ids[q]
                    s, i = _best(scores[other], ids[other], k)
                    kept[q] = _best(np.concatenate([kept[q][0], s]), np.concatenate([kept[q][1], i]), k)
        for lo in range(0, len(q_ids), 4096):
            some = range(lo, min(lo + 4096, len(q_ids)))
            n = [len(kept[q][0]) for q in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(numbers[lo:lo + 4096], n)), pa.array(np.repeat(q_ids[lo:lo + 4096], n)),
                 pa.array(np.concatenate([kept[q][1] for q in some])),
                 pa.array(np.concatenate([kept[q][0] for q in some]))], ["n", "query_id", "vec_id", "score"])
    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score.  Both inputs: (id, v array<long>)."""
    spark = candidates.sparkSession
    # Every query row has a number of its own, written so that it stays.
    numbered = written(queries.select("id", "v").withColumn("n", F.monotonically_increasing_id()), "queries")
    found, after = None, -1
    while True:  # one pass over the candidates for each block of queries
        got = numbered.where(F.col("n") > after).orderBy("n").limit(QUERY_BLOCK).toArrow()
        if got.num_rows or found is None:
            ids, numbers = (got.column(c).to_numpy() for c in ("id", "n"))
            rows = [(np.flatnonzero(v), v[v != 0]) for v in (np.asarray(x, np.int64) for x in got.column("v").to_pylist())]
            one = candidates.select("id", "v").mapInArrow(
                _search(spark.sparkContext.broadcast((ids, numbers, rows)), k), "n long, query_id long, vec_id long, score long")
            found = one if found is None else found.unionByName(one)
        if got.num_rows < QUERY_BLOCK:
            break
        after = int(numbers[-1])
    best = Window.partitionBy("n").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
