"""Sharding by histogram sort: byte-balanced shards of a corpus.

Every row gets a sort key, the 62-bit hash of its text, then the hash of its id,
then its place in the input (a written number), so equal texts lie next to each
other, new keys spread evenly and no two rows are equal.  The
shard borders are found by counting, not by sorting or sampling: in each round
the exact bytes below a set of candidate borders (probes) are counted over all
partitions, and each border keeps the one probe interval that holds its target.
A round narrows every interval by the number of probes, so a handful of rounds
over a narrow table of ids and sizes settles any number of rows.  One exchange
by (shard, key) then puts the rows in place.

Law ``bytes``: a border falls between two groups of equal texts where one lies
within ``tolerance`` of the target; a group too large for that (a hot group) is
split inside, by the hash of the id, and rows that share id and text by place.  A single row is never split, so a shard
differs from the mean by at most ``tolerance`` plus its largest row.

Defined results: a NULL or empty text has size 1; NULL ids sort by the hash of
NULL; repeated rows each get a slot; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TOP = 1 << 62


def _key(c: str):
    return F.shiftrightunsigned(F.xxhash64(c), 2)


def _counts_in(rows: DataFrame, key: str, brackets: list[tuple[int, int, int]]) -> dict:
    """(bracket, probe interval) -> exact (bytes, rows); one aggregate job.  A
    bracket is (lo, hi, step); its intervals are ``step`` wide."""
    bucket = None
    for b, (lo, hi, step) in enumerate(brackets):
        inside = (F.col(key) >= lo) & (F.col(key) < hi)
        value = F.lit(b).cast("long") * F.lit(1 << 20) + F.expr(f"({key} - {lo}L) div {step}L")
        bucket = F.when(inside, value) if bucket is None else bucket.when(inside, value)
    got = (rows.select(bucket.alias("bucket"), "size").where("bucket is not null")
           .groupBy("bucket").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect())
    return {divmod(r["bucket"], 1 << 20): (r["bytes"], r["n"]) for r in got}


def find_borders(rows: DataFrame, key: str, targets: list[int], below: int, total: int,
                 probes: int, near: float) -> dict[int, tuple[int, int, int, int]]:
    """For each target an interval of keys that its place falls into: target ->
    (lo, hi, bytes below lo, bytes below hi).  An interval is narrowed until one
    of its ends lies within ``near`` bytes of the target, or it holds one row or
    one key.  ``below`` and ``total``: bytes before these rows and in them."""
    state = {t: (0, TOP, below, below + total) for t in targets}
    open_ = set(targets)
    while open_:
        spans = sorted({state[t] for t in open_})
        brackets = [(lo, hi, -(-(hi - lo) // probes)) for lo, hi, _, _ in spans]
        counts = _counts_in(rows, key, brackets)
        for t in sorted(open_):
            lo, hi, at, _ = state[t]
            b, n = spans.index(state[t]), 0
            step, own = brackets[b][2], sorted((i, v) for (k, i), v in counts.items() if k == b)
            for i, (size, n) in own:  # never empty: the target's place is in this bracket
                state[t] = (lo + i * step, min(hi, lo + (i + 1) * step), at, at + size)
                at += size
                if at >= t:
                    break
            lo, hi, a, z = state[t]
            if hi - lo <= 1 or n <= 1 or min(t - a, z - t) <= near:
                open_.discard(t)
    return state


def shard(docs: DataFrame, n_shards: int = 8, tolerance: float = 0.01, probes: int = 256) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard)."""
    rows = written(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        _key("text").alias("k1"), _key("doc_id").alias("k2"), F.monotonically_increasing_id().alias("k3")), "shard-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    mean = total / n_shards
    targets = sorted({total * k // n_shards for k in range(1, n_shards)})
    at = find_borders(rows, "k1", targets, 0, total, probes, tolerance * mean / 4) if total else {}

    borders: list[tuple[int, int, int]] = []  # a row at or after (k1, k2, k3) lies beyond the border
    far = tolerance * mean

    def close(group: tuple[int, ...], found: dict) -> dict[tuple, list[int]]:
        """Settle the borders found in a group of keys; the hot keys left, with their targets."""
        hot: dict[tuple, list[int]] = {}
        pad = (0,) * (2 - len(group))
        for t, (lo, hi, a, z) in found.items():
            if len(group) == 2 or hi - lo > 1 or min(t - a, z - t) <= far:
                borders.append((*group, lo if t - a <= z - t else hi, *pad))
            else:  # one key with more bytes than that: a hot group, cut inside
                hot.setdefault(((*group, lo), a, z), []).append(t)
        return hot

    hot = close((), at)
    while hot:
        (group, below, above), ts = hot.popitem()
        own = rows.where((F.col("k1") == group[0]) & (F.col("k2") == group[1] if len(group) > 1 else F.lit(True)))
        # A key of the middle level is cut by place only if it is hot itself.
        hot |= close(group, find_borders(own, f"k{len(group) + 1}", ts, below, above - below, probes, 0))

    shard_no = F.lit(0)
    for k1, k2, k3 in sorted(borders):
        beyond = (F.col("k2") > k2) | ((F.col("k2") == k2) & (F.col("k3") >= k3))
        shard_no = shard_no + ((F.col("k1") > k1) | ((F.col("k1") == k1) & beyond)).cast("int")
    # The one exchange: range partitions of (shard, key), each sorted; an id of
    # (partition, place in it) then numbers the rows without a global sort.
    placed = written(
        rows.withColumn("shard", shard_no).repartitionByRange("shard", "k1", "k2", "k3")
        .sortWithinPartitions("shard", "k1", "k2", "k3")
        .select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("place")),
        "shard-rows").withColumn("part", F.shiftright("place", 33))
    # A few rows per range partition: first place and rows before it in the shard.
    parts = placed.groupBy("shard", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return placed.join(parts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("place") - F.col("first") + F.col("before")).alias("slot"))
