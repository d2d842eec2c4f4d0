"""Byte-level BPE encoding and decoding by a two-tier lookup.

A text is split into pre-tokens by the vocabulary's pattern.  Tier one: a
minimal perfect hash over the vocabulary's tokens (hash, displace: every token
has a slot of its own and no slot is empty) gives the one token a pre-token can
be, and comparing the bytes tells whether it is.  Tier two, for the misses: the
pre-token's bytes as a linked list and a heap of its neighbouring pairs; the
pair of the lowest rank, the leftmost of equals, is joined until no pair is a
token.  Decoding lays the tokens' bytes end to end.

One pass over the texts, no shuffle.  The vocabulary (about 50,000 tokens, under
1 MB) is read and hashed on the driver and broadcast; its path is a parameter.

Defined results: NULL and empty texts have no tokens and decode to no bytes;
names of special tokens are ordinary text; rows with NULL ids and repeated rows
are encoded like any other; other columns are left out.  Decoding takes NULL
ids, and NULL in them, as no token; an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

#: Pre-tokens that a worker remembers, and as many that it met before these.
REMEMBERED = 400_000
#: Odd multipliers that mix a hash with a displacement, in 64 bits.
STEP, MIX, WORD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, (1 << 64) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """token -> rank of a file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Slot of each of n keys in 0..n-1.  Keys are dealt to n/2 buckets; each
    bucket, the largest first, gets the first displacement that sends its keys
    to free slots, and a bucket of one key simply the next free slot (negative)."""

    def __init__(self, keys: list[bytes]):
        self.n, self.seed = len(keys), 0
        while True:
            hashes = self.hashes(keys)
            if len(np.unique(hashes)) == self.n:
                break
            self.seed += 1
        self.buckets = self.n // 2 + 1
        self.displace = np.zeros(self.buckets, np.int64)
        members: dict[int, list[int]] = {}
        for b, h in zip((hashes % np.uint64(self.buckets)).tolist(), hashes.tolist()):
            members.setdefault(b, []).append(h)
        taken = np.zeros(self.n, bool)
        alone = [b for b, m in members.items() if len(m) == 1]
        for b in sorted((b for b, m in members.items() if len(m) > 1), key=lambda b: -len(members[b])):
            own, d = np.array(members[b], np.uint64), 0
            while True:
                slots = self._spot(own, np.arange(d, d + 64, dtype=np.uint64)[:, None])
                free = ~taken[slots].any(1)
                if len(own) > 1:
                    ordered = np.sort(slots, 1)
                    free &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
                if free.any():
                    break
                d += 64
            first = int(free.argmax())
            self.displace[b] = d + first
            taken[slots[first]] = True
        self.displace[alone] = -1 - np.flatnonzero(~taken)

    def hashes(self, keys: Iterable[bytes]) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(k, self.seed) for k in keys], np.uint64)

    def _spot(self, hashes: np.ndarray, displacement) -> np.ndarray:
        mixed = (hashes ^ (displacement * np.uint64(STEP))) * np.uint64(MIX)
        return ((mixed >> np.uint64(32)) % np.uint64(self.n)).astype(np.int64)

    def slot(self, key: bytes) -> int:
        """The slot of one key."""
        h = xxhash.xxh64_intdigest(key, self.seed)
        d = self.displace.item(h % self.buckets)
        return -1 - d if d < 0 else (((h ^ (d * STEP & WORD)) * MIX & WORD) >> 32) % self.n

    def slots(self, keys: Iterable[bytes]) -> np.ndarray:
        """The slot of each key; of a key that is none of the n, some slot."""
        hashes = self.hashes(keys)
        d = self.displace[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._spot(hashes, d.astype(np.uint64)))


class Vocabulary:
    """Tokens in the order of their slots, their ids, and the pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        keys = list(ranks)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.hash, self.pattern = PerfectHash(keys), pattern
        by_slot = dict(zip(self.hash.slots(keys).tolist(), keys))
        self.tokens = [by_slot[s] for s in range(len(keys))]
        self.ids = [ranks[t] for t in self.tokens]
        self.ranks, self.bytes = ranks, {i: t for t, i in ranks.items()}
        self._encoder = None

    def encoder(self) -> Encoder:
        """The encoder of this process: tasks that follow on a worker go on with
        what it remembers, as long as the worker holds the broadcast."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v, self.known, self.older = vocabulary, {}, {}
        self.split = regex.compile(vocabulary.pattern).findall
        self.packed = {i: array("i", (i,)).tobytes() for i in vocabulary.ids}  # known pieces are ids as bytes
        self.single = self.whole([bytes([b]) for b in range(256)])
        self.double = self.whole([bytes([a, b]) for a in range(256) for b in range(256)])

    def whole(self, pieces: list[bytes]) -> list[int | None]:
        """Tier one: the id of each piece that is a token."""
        tokens, ids = self.v.tokens, self.v.ids
        return [ids[s] if tokens[s] == p else None for s, p in zip(self.v.hash.slots(pieces).tolist(), pieces)]

    def merged(self, piece: bytes) -> list[int]:
        """Tier two: the ids of a piece that is no token."""
        n, rank_of, double = len(piece), self.v.ranks.get, self.double
        # By the start of a part; end[i] starts the next.  A start that was joined to the part before it ends at n, and n at 0.
        end, before = [*range(1, n + 1), 0], list(range(-1, n))
        token = [self.single[b] for b in piece]
        # Entries are (rank, start, end) in the bits of one number: the least is the lowest rank, the leftmost of equals.
        bits = n.bit_length()
        low, wide = (1 << bits) - 1, 2 * bits
        heap = [(r << bits | i) << bits | i + 2 for i, (a, b) in enumerate(zip(piece, piece[1:])) if (r := double[a << 8 | b]) is not None]
        heapify(heap)
        while heap:
            entry = heap[0]  # its place goes to the first entry that follows from it
            i, stop = entry >> bits & low, entry & low
            right = end[i]
            if end[right] != stop:
                heappop(heap)  # one of the two has been joined meanwhile
                continue
            end[right], token[i], end[i] = n, entry >> wide, stop
            before[stop], put = i, heapreplace
            if stop < n:
                last = end[stop]
                if (r := rank_of(piece[i:last])) is not None:
                    put(heap, (r << bits | i) << bits | last)
                    put = heappush
            if i:
                first = before[i]
                if (r := rank_of(piece[first:stop])) is not None:
                    put(heap, (r << bits | first) << bits | stop)
                    continue
            if put is heapreplace:
                heappop(heap)
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = end[i]
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        return [ids.tolist() for ids in self.arrays(texts)]

    def arrays(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(t) for t in texts]
        every = set().union(*split)
        if len(self.known) + len(every) > REMEMBERED:  # what was met lately is kept
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = list(every.difference(known))
        if older:
            known.update((p, older[p]) for p in new if p in older)
            new = [p for p in new if p not in known]
        raw = [p.encode() for p in new]
        for p, b, i in zip(new, raw, self.whole(raw)):
            known[p] = self.packed[i] if i is not None else array("i", self.merged(b)).tobytes()
        of = known.__getitem__
        return [np.frombuffer(b"".join(map(of, pieces)), np.int32) for pieces in split]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.v.bytes.__getitem__, ids))


def _lists(rows: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    counts = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate(rows)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(counts)


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """doc_id, ids, n_tokens of every row; with ``decoded`` also the bytes that
    the ids decode to."""
    held = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(path), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held.value.encoder()
        for batch in batches:
            for part in blocks(batch, "text"):
                rows = encoder.arrays([t or "" for t in part.column(1).to_pylist()])
                columns = [part.column(0), *_lists(rows)]
                if decoded:
                    columns.append(pa.array([encoder.decode(r.tolist()) for r in rows], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_tokens", "decoded"][:len(columns)])

    schema = "doc_id long, ids array<int>, n_tokens long" + ", decoded binary" * decoded
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, decoded (bytes) from doc_id, ids."""
    held = tokens.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(path), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held.value.encoder()
        for batch in batches:
            out = [encoder.decode(i for i in r or () if i is not None) for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, decoded binary")
