"""Suffix-array dedup of repeated byte strings, by a distributed difference cover.

Wanted: every byte covered by a string of ``WIDTH`` = 100 bytes that also
starts earlier.  Two suffixes agree on 100 bytes exactly when their 100-byte
prefixes get the same name, so the sort order of the suffix array is needed
down to 100 bytes only; that bounds the recursion to two levels.

* Cover: D is a difference cover modulo V = 57, so for any two places a, b
  there is a d < 57 with both a + d and b + d at sampled places of their texts.
* Level 1, sampled triples: a sampled suffix is named by the triple of the
  16-byte blocks at 0, 14 and 28, its first 44 bytes.  Sorting the names of all
  chunks brings equal ones together; a name that stands alone is final, and no
  100-byte string over it repeats (44 + 56 = 100).
* Level 2, recursion on names: places within 56 bytes before a sampled suffix
  whose name repeats are all that is left, sampled or not.  Each is named by
  the triple of level-1 names at 0, 28 and 56, its first 100 bytes.  These are
  sorted and merged, and neighbours with equal prefixes form a class; all but
  the earliest of a class start a repeated string.

Names are 64-bit fingerprints, sorted in the bucket that further hash bits
choose (over 70 bits in all), so the order is not the alphabet's, which adjacent
comparison does not need.

How it is spread: rows are packed once into chunks of a few MB, a table bucketed
by chunk, so the texts are never shuffled.  A chunk sends each of its names
once (its own repeats are settled in place, which keeps a passage that a third
of all rows share from meeting in one task), packed into one binary row per
bucket, and gets one bit per name back.  Rows that are whole copies of an
earlier one are found by their SHA-256 first and send nothing.

Defined results: NULL and empty texts have 0 bytes; texts under 100 bytes are
never cut; "earlier" means the smaller id, a NULL id being the smallest, and
among rows that repeat an id the order of the chunks; extra columns are kept
where rows are returned; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.session import shared_table_path

from .common import blocks

WIDTH, NAMED = 100, 44
V, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
assert {(a - b) % V for a in COVER for b in COVER} == set(range(V)) and NAMED + V - 1 == WIDTH
#: Packed text of a chunk, and text per sort bucket.
CHUNK_BYTES, BUCKET_BYTES = 6 << 20, 16 << 20
#: Places named at once: a few arrays of them stay in a core's cache.
TILE = 1 << 15
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
NO_ID = np.iinfo(np.int64).min


def _mix(*parts: np.ndarray, key: np.uint64 = K1) -> np.ndarray:
    h = np.full(len(parts[0]), K3)
    for p in parts:
        h ^= p
        h *= key
        h ^= h >> np.uint64(29)
    h *= K2
    h ^= h >> np.uint64(32)
    return h


def block_names(data: bytes) -> np.ndarray:
    """Level-1 names: for each place the fingerprint of its first 44 bytes."""
    n = len(data) - NAMED + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    word = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))  # the 8 bytes from each place on
    out = np.empty(n, np.uint64)
    for lo in range(0, n, TILE):
        hi = min(n, lo + TILE)
        w = word[lo:hi + NAMED - 8].copy()
        out[lo:hi] = _mix(*(w[d:d + hi - lo] for d in (0, 8, 14, 22, 28, 36)))  # 16-byte blocks at 0, 14 and 28
    return out


def _firsts(values: np.ndarray) -> np.ndarray:
    """Place of the first occurrence of each distinct value."""
    order = np.argsort(values)
    new = np.flatnonzero(np.diff(values[order], prepend=~values[order][:1]))
    return np.minimum.reduceat(order, new) if len(values) else order


class Chunk:
    """A packed chunk: texts end to end in order of their ids."""

    def __init__(self, data: bytes, lens: np.ndarray, ids: np.ndarray, copies: np.ndarray, n_buckets: int):
        self.data, self.lens, self.ids, self.copies, self.n_buckets = data, lens, ids, copies, n_buckets
        self.starts = np.cumsum(lens) - lens
        self.names = block_names(data)

    def sampled(self) -> np.ndarray:
        """Places of the cover, counted from each text's start, whose 44 bytes
        lie in the text; none of whole copies."""
        top = int(self.lens.max()) if len(self.lens) else 0
        pattern = np.sort(np.concatenate([np.arange(c, max(top, 1), V) for c in COVER]))
        n = np.searchsorted(pattern, np.maximum(self.lens - NAMED + 1, 0))
        n[self.copies] = 0
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(self.starts, n) + pattern[at]

    @cached_property
    def level1(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The chunk's distinct sampled names by bucket: (names, bucket, whether
        it repeats within the chunk, places of all samples)."""
        at = self.sampled()
        names, counts = np.unique(self.names[at], return_counts=True)
        bucket = ((names * K3 >> np.uint64(32)) % np.uint64(self.n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return names[order], bucket[order], counts[order] > 1, at

    def level2(self, repeated: np.ndarray):
        """Places whose 100-byte names are to be merged.  ``repeated``: bits of
        the level-1 names, in the order of level1.
        Returns (places, names, buckets, texts) of first occurrences by bucket,
        and the places that repeat an earlier one of this chunk."""
        names, _, own, at = self.level1
        left = np.sort(names[repeated | own])
        n = len(self.data)
        near = np.zeros(n + 1, np.int8)  # steps up and down; at most 8 samples in 57 bytes
        if len(left):
            hit = at[left[np.minimum(np.searchsorted(left, self.names[at]), len(left) - 1)] == self.names[at]]
            np.add.at(near, np.maximum(hit - (V - 1), 0), 1)
            np.add.at(near, hit + 1, -1)
        room = np.zeros(n + 1, np.int8)  # places with 100 bytes of their text ahead
        fit = self.lens >= WIDTH
        fit[self.copies] = False
        np.add.at(room, self.starts[fit], 1)
        np.add.at(room, (self.starts + self.lens)[fit] - WIDTH + 1, -1)
        np.cumsum(near, dtype=np.int8, out=near)
        np.cumsum(room, dtype=np.int8, out=room)
        place = np.flatnonzero((near[:n] > 0) & (room[:n] > 0))
        del near, room
        parts = [self.names[place + d] for d in (0, 28, 56)]
        name = _mix(*parts)
        is_first = np.zeros(len(place), bool)
        is_first[_firsts(name)] = True
        again, place, name = place[~is_first], place[is_first], name[is_first]
        bucket = _mix(*(p[is_first] for p in parts), key=K2) % np.uint64(self.n_buckets)
        order = np.argsort(bucket.astype(np.uint16) if self.n_buckets <= 65536 else bucket, kind="stable")
        place, name, bucket = place[order], name[order], bucket[order].astype(np.int64)
        text = np.searchsorted(self.starts, place, side="right") - 1
        return place, name, bucket, text, again


def _runs(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of an array sorted by bucket."""
    cut = np.flatnonzero(np.diff(bucket)) + 1
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(np.append(0, cut), np.append(cut, len(bucket)))] if len(bucket) else []


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _unpack(answers: list[dict] | None, bucket: np.ndarray) -> np.ndarray:
    """The bits of a chunk's names, in the order of ``bucket``."""
    by = {a["bucket"]: a["bits"] for a in answers or ()}
    out = np.zeros(len(bucket), bool)
    for b, lo, hi in _runs(bucket):
        out[lo:hi] = np.unpackbits(np.frombuffer(by[b], np.uint8), count=hi - lo).astype(bool)
    return out


def pack(docs: DataFrame) -> DataFrame:
    """The chunk table: chunk, data (texts end to end as UTF-8), lens, sha (128
    bits of the SHA-256 of each), and a list column ``c<i>`` for each other column of ``docs``; bucketed by chunk."""
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != "text"]
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    source = docs.select(F.col("text").cast("binary").alias("_text"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)))
    id_at = 1 + others.index("doc_id")
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("data", T.BinaryType()),
        T.StructField("lens", T.ArrayType(T.IntegerType())), T.StructField("sha", T.ArrayType(T.BinaryType())),
        *(T.StructField(f"c{i}", T.ArrayType(docs.schema[c].dataType)) for i, c in enumerate(others))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in blocks(batch, "_text", CHUNK_BYTES):
                order = pc.sort_indices(part.column(id_at), null_placement="at_start")
                part = part.take(order)
                texts = [t or b"" for t in part.column(0).to_pylist()]
                one = [[number], [b"".join(texts)], [[len(t) for t in texts]], [[hashlib.sha256(t).digest()[:16] for t in texts]]]
                lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), c) for c in part.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[0], pa.int64()), pa.array(one[1], pa.binary()), pa.array(one[2], pa.list_(pa.int32())),
                     pa.array(one[3], pa.list_(pa.binary())), *lists], schema.fieldNames())
                number += 1

    name = f"chunks_{uuid.uuid4().hex}"
    (source.mapInArrow(run, schema).write.bucketBy(max(8, min(4096, n_bytes // CHUNK_BYTES)), "chunk")
     .option("compression", "zstd").option("parquet.compression.codec.zstd.level", "6").option("path", shared_table_path(spark, "chunks")).saveAsTable(name))
    return spark.table(name)


def _ids(column) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in column], np.int64)


def removals(docs: DataFrame, output: str) -> DataFrame:
    """Per row of ``docs`` what is removed.  output ``digest``: doc_id, n_bytes,
    n_removed, n_spans, kept_sha256; ``rows``: the columns of ``docs`` with the
    kept text (a character that a cut splits goes) and, if present, n_chars."""
    spark = docs.sparkSession
    chunks = pack(docs)
    others = [c for c in docs.columns if c != "text"]
    id_col = f"c{others.index('doc_id')}"
    n_bytes = chunks.agg(F.sum(F.expr("aggregate(lens, 0L, (a, x) -> a + x)"))).first()[0] or 0
    n_buckets = max(32, -(-n_bytes // BUCKET_BYTES))
    answer = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("bits", T.BinaryType())])

    def opened(batch: pa.RecordBatch) -> Iterator[tuple[dict, Chunk]]:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i].as_py() for k in batch.schema.names if k in ("chunk", "lens", "first", "second", "later")}
            ids, copies = _ids(batch.column(id_col)[i].as_py()), np.array(row["later"] or [], np.int64)
            yield row, Chunk(batch.column("data")[i].as_py(), np.array(row["lens"], np.int64), ids, copies, n_buckets)

    def send1(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, c in opened(batch):
                names, bucket, _, _ = c.level1
                rest = names.astype(np.uint32)  # the bucket holds more of the name
                runs = _runs(bucket)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(runs), pa.int64()), pa.array([b for b, _, _ in runs], pa.int32()),
                     pa.array([rest[i:j].tobytes() for _, i, j in runs], pa.binary())], ["chunk", "bucket", "names"])

    def sort1(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint32) for x in group.column("names").to_pylist()]
        every = np.sort(np.concatenate(parts))
        again = np.unique(every[1:][every[1:] == every[:-1]])
        out = []
        for p in parts:
            i = np.minimum(np.searchsorted(again, p), max(len(again) - 1, 0))
            out.append(_bits(again[i] == p if len(again) else np.zeros(len(p), bool)))
        return pa.table([group.column("chunk"), group.column("bucket"), pa.array(out, pa.binary())], ["chunk", "bucket", "bits"])

    def send2(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, c in opened(batch):
                repeated = _unpack(row["first"], c.level1[1])
                _, name, bucket, text, _ = c.level2(repeated)
                out = [[], [], [], []]
                for b, i, j in _runs(bucket):
                    cut = np.append(np.flatnonzero(np.diff(text[i:j], prepend=-1)), j - i)
                    for o, x in zip(out, (b, name[i:j].tobytes(), c.ids[text[i:j][cut[:-1]]].tobytes(), np.diff(cut).astype(np.uint32).tobytes())):
                        o.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(out[0]), pa.int64()), pa.array(out[0], pa.int32()),
                     *(pa.array(o, pa.binary()) for o in out[1:])], ["chunk", "bucket", "names", "ids", "runs"])

    def sort2(group: pa.Table) -> pa.Table:
        group = group.sort_by("chunk")
        parts = [np.frombuffer(x, np.uint64) for x in group.column("names").to_pylist()]
        ids = np.concatenate([np.repeat(np.frombuffer(i, np.int64), np.frombuffer(r, np.uint32))
                              for i, r in zip(group.column("ids").to_pylist(), group.column("runs").to_pylist())])
        names = np.concatenate(parts)
        # Order of the suffixes: the id, then chunk and place in it (the order here).
        rank = (np.unique(ids, return_inverse=True)[1].astype(np.int64) << 32) + np.arange(len(ids))
        order = np.argsort(names)
        new = np.flatnonzero(np.diff(names[order], prepend=~names[order][:1]))
        least = np.minimum.reduceat(rank[order], new)
        later = np.empty(len(names), bool)
        later[order] = rank[order] > np.repeat(least, np.diff(np.append(new, len(names))))
        out = [_bits(x) for x in np.split(later, np.cumsum([len(p) for p in parts])[:-1])]
        return pa.table([group.column("chunk"), group.column("bucket"), pa.array(out, pa.binary())], ["chunk", "bucket", "bits"])

    def answers(sent: DataFrame, sort, column: str) -> DataFrame:
        return (sent.groupBy("bucket").applyInArrow(sort, answer).groupBy("chunk")
                .agg(F.collect_list(F.struct("bucket", "bits")).alias(column)))

    base = chunks.select("chunk", "data", "lens", id_col)
    # Whole copies: per SHA-256 the earliest row stays.
    rows = (chunks.select("chunk", F.posexplode(F.arrays_zip("sha", "lens", F.col(id_col).alias("id"))).alias("place", "x"))
            .where(F.col("x.lens") >= WIDTH)
            .select("chunk", "place", "x.sha", F.coalesce(F.col("x.id").cast("long"), F.lit(NO_ID)).alias("id")))
    earliest = rows.groupBy("sha").agg(F.min(F.struct("id", "chunk", "place")).alias("e"), F.count("*").alias("n")).where("n > 1")
    later = (rows.join(earliest, "sha").where(F.struct("id", "chunk", "place") != F.col("e"))
             .groupBy("chunk").agg(F.collect_list("place").alias("later")))
    base = base.join(later, "chunk", "left")
    first = answers(base.mapInArrow(send1, "chunk long, bucket int, names binary"), sort1, "first")
    with_first = base.join(first, "chunk", "left")
    second = answers(with_first.mapInArrow(send2, "chunk long, bucket int, names binary, ids binary, runs binary"), sort2, "second")

    fields = [f for f in docs.schema.fields if f.name != "text"]
    digest = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    schema = digest if output == "digest" else docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (row, c) in enumerate(opened(batch)):
                place, _, bucket, _, again = c.level2(_unpack(row["first"], c.level1[1]))
                start = np.concatenate([place[_unpack(row["second"], bucket)], again])
                cover = np.zeros(len(c.data) + 1, np.int8)  # steps up and down; at most 100 strings over a byte
                np.add.at(cover, start, 1)
                np.add.at(cover, start + WIDTH, -1)
                np.cumsum(cover, dtype=np.int8, out=cover)
                gone = cover[:-1] > 0
                for k in c.copies:
                    gone[c.starts[k]:c.starts[k] + c.lens[k]] = True
                raw = np.frombuffer(c.data, np.uint8)
                kept, spans = [], []
                for s, n in zip(c.starts.tolist(), c.lens.tolist()):
                    g = gone[s:s + n]
                    spans.append(int(n and g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])))
                    kept.append(raw[s:s + n][~g].tobytes() if spans[-1] else c.data[s:s + n])
                if output == "digest":
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(batch.column(id_col)[i].as_py(), pa.int64()), pa.array(c.lens),
                         pa.array([int(n) - len(k) for n, k in zip(c.lens, kept)], pa.int64()), pa.array(spans, pa.int64()),
                         pa.array([hashlib.sha256(k).hexdigest() for k in kept])], digest.fieldNames())
                else:
                    text = [k.decode("utf-8", "ignore") for k in kept]
                    cols = {f.name: batch.column(f"c{j}")[i].values for j, f in enumerate(fields)}
                    cols["text"] = pa.array(text, pa.string())
                    if "n_chars" in cols:
                        cols["n_chars"] = pa.array([len(t) for t in text]).cast(cols["n_chars"].type)
                    yield pa.RecordBatch.from_arrays([cols[f.name] for f in schema.fields], schema.fieldNames())

    every = chunks.drop("sha").join(later, "chunk", "left") if output == "rows" else base
    return every.join(first, "chunk", "left").join(second, "chunk", "left").mapInArrow(cut, schema)


def dedup_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    return removals(docs.select(F.col("doc_id").cast("long"), "text"), "digest")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated bytes; rows of which nothing is left go."""
    return removals(docs, "rows").where((F.col("text") != "") | F.col("text").isNull())
