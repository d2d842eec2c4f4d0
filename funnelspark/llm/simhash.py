"""SimHash near-duplicates with BK-trees.

Fingerprints: a text's lower-cased (A-Z) words, in shingles of ``size`` words,
repeats included; each shingle's XXH64 votes on 64 bits, and a bit is set when
over half the shingles have it.  One pass over the texts, no shuffle; from here
on only ids and fingerprints move, and equal fingerprints are one node.

Links: two fingerprints within ``radius`` bits agree on at least one of
``radius + 1`` equal blocks of bits, so each goes to the shard of each of its
block values, and only fingerprints of a shard are compared (no pair is lost).
A shard's fingerprints form a BK-tree, whose children are keyed by their
integer Hamming distance to the parent; a search follows only the edges within
the radius of the query's distance.  The queries are the shard's own
fingerprints, so tree and queries meet by one shuffle on the shard's key: all
trees together grow with the input, and broadcasting them would not be bounded.
A shard with more than ``shard_rows`` fingerprints is cut into several trees,
and its queries are sent to each of them.

A task returns one link per fingerprint and tree at most (to the smallest
member of its linked group there), never all pairs.  Components over these
links give the groups.

Defined results: NULL, empty and word-free texts have fingerprint zero and link
like any other; rows with a NULL id take part in links but no component is
named after them (one that holds no other id has NULL); repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, written
from .components import components

SHARD_ROWS = 1 << 16


def _votes(shingles) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    h = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(0, dtype=np.int64), len(h)


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) < size:
        words, size = [b" ".join(words)], 1
    votes, n, step = np.zeros(64, np.int64), 0, 1 << 16
    for at in range(0, len(words) - size + 1, step):  # long texts in parts
        part = words[at:at + step + size - 1]
        v, k = _votes(map(b" ".join, zip(*(part[i:] for i in range(size)))))
        votes, n = votes + v, n + k
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, *more: Column) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and ``more`` (longs) for every row."""
    names = ["doc_id", "fp", *(f"more{i}" for i in range(len(more)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                fp = np.array([fingerprint(t.as_py(), size) for t in part.column(1)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp), *part.columns[2:]], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), *(c.alias(n) for c, n in zip(more, names[2:]))).mapInArrow(
        run, ", ".join(f"{n} long" for n in names))


class BKTree:
    """Distinct 64-bit values; children keyed by Hamming distance to the parent."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        todo = [np.arange(len(values))] if len(values) else []
        while todo:  # the first of a group is its root; the others hang below by distance, in order
            group = todo.pop()
            root, rest = group[0], group[1:]
            if not len(rest):
                continue
            d = np.bitwise_count(values[rest] ^ values[root])
            order = np.argsort(d, kind="stable")
            rest, d = rest[order], d[order]
            for part, dist in zip(np.split(rest, np.flatnonzero(np.diff(d)) + 1), np.unique(d)):
                self.children[root][int(dist)] = int(part[0])
                todo.append(part)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, places of the queries within ``radius`` of it), node by node;
        queries go down together, each along the edges within the radius."""
        todo = [(0, np.arange(len(queries)))] if len(self.values) and len(queries) else []
        while todo:
            node, active = todo.pop()
            d = np.bitwise_count(queries[active] ^ self.values[node]).astype(np.int64)
            near = active[d <= radius]
            if len(near):
                yield node, near
            for dist, child in self.children[node].items():
                below = active[np.abs(d - dist) <= radius]
                if len(below):
                    todo.append((child, below))


def _group_links(tree: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, smallest value linked to it here) for the values that have one."""
    values = np.union1d(tree, queries)
    at_tree, at_query = np.searchsorted(values, tree), np.searchsorted(values, queries)
    parent = np.arange(len(values))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for node, near in BKTree(tree).search(queries, radius):
        ids = at_query[near]
        if len(ids) == 1 and ids[0] == at_tree[node]:
            continue
        tops = {root(int(i)) for i in np.unique(parent[ids])} | {root(int(at_tree[node]))}
        least = min(tops)
        for t in tops:
            parent[t] = least
    top = np.array([root(i) for i in range(len(values))])
    linked = np.flatnonzero(top != np.arange(len(values)))
    return values[linked], values[top[linked]]


def links(nodes: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """a, b: links that connect all fingerprints (column fp, distinct) within
    ``radius`` bits of each other."""
    width = 64 // (radius + 1)
    last = 64 - width * radius
    shards = F.array(*[
        F.struct(F.lit(i).alias("block"), F.expr(f"shiftrightunsigned(fp, {i * width}) & {(1 << (last if i == radius else width)) - 1}L").alias("value"))
        for i in range(radius + 1)])
    keyed = nodes.select("fp", F.explode(shards).alias("k")).select("fp", "k.block", "k.value")
    hot = (keyed.groupBy("block", "value").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows)
           .select("block", "value", F.ceil(F.col("n") / shard_rows).cast("int").alias("trees")))
    keyed = keyed.join(hot, ["block", "value"], "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    # Each fingerprint is a query at every tree of its shard and a node of one of them.
    sent = (keyed.withColumn("own", own).withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
            .select("block", "value", "tree", "fp", (F.col("own") == F.col("tree")).alias("member")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush():
            fps = np.concatenate([x[0] for x in held]).view(np.uint64)
            if len(fps) < 2:
                return None
            member = np.concatenate([x[1] for x in held])
            a, b = _group_links(fps[member], fps, radius)
            if not len(a):
                return None
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:  # sorted by shard and tree; a group may go on in the next batch
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            new = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
            for lo, hi in zip(np.append(0, new), np.append(new, batch.num_rows)):
                k = (cols[0][lo], cols[1][lo], cols[2][lo])
                if k != key and held:
                    if (out := flush()) is not None:
                        yield out
                    held = []
                key = k
                held.append((cols[3][lo:hi], cols[4][lo:hi]))
        if held and (out := flush()) is not None:
            yield out

    return (sent.repartition("block", "value", "tree").sortWithinPartitions("block", "value", "tree")
            .mapInArrow(run, "a long, b long"))


def _rooted(fps: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """fp, first (its smallest id), root (the same for all of a component) for every fingerprint."""
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    roots = components(links(nodes.select("fp"), radius, shard_rows))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fp, component_id for every row; component_id is the smallest id
    reachable over links of ``radius`` bits or fewer."""
    fps = written(fingerprints(docs, size), "fingerprints")
    of = _rooted(fps, radius, shard_rows)
    least = of.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = of.join(least, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id, then
    fingerprint, then hash of the text (one of them, if rows repeat); an id
    with texts in several groups can stand for each of them.  Rows without an
    id are kept, as nothing names them."""
    key = F.xxhash64("text")
    fps = written(fingerprints(docs, size, key).withColumnRenamed("more0", "key"), "fingerprints")
    # Per fingerprint first: a large group is one row here.
    of = _rooted(fps, radius, SHARD_ROWS).select("fp", "root")
    least = (fps.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min(F.struct("doc_id", "fp", "key")).alias("least"))
             .join(of, "fp").groupBy("root").agg(F.min("least").alias("least")))
    kept = least.select(F.col("least.doc_id").alias("_kept"), F.col("least.key").alias("_kept_key"))
    named = docs.where(F.col("doc_id").isNotNull()).withColumn("_key", key)
    one = (named.join(kept, (F.col("doc_id").cast("long") == F.col("_kept")) & (F.col("_key") == F.col("_kept_key")), "left_semi")
           .dropDuplicates(["doc_id", "_key"]).drop("_key"))
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
