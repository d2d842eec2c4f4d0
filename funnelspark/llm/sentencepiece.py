"""SentencePiece (BPE with byte fallback) encoding and decoding by suffix-array matching.

Texts are encoded in batches.  The batch's chunks (a run of spaces with what
follows it, or a line feed: no piece of the vocabulary reaches across) that the
worker has not met before are laid end to end and indexed by a suffix array.
Every piece is looked up by binary search, which gives its range of suffixes,
that is all its occurrences; these are the edges of a lattice over the text.
The edges are sorted by position and relaxed in that order, all chunks at once:
an edge is taken when it extends the encoding of the prefix before it, i.e.
when the merges, applied to its predecessor's and its own text, give back these
two pieces.  Exactly one edge does so for every position, so the result is that
of applying the merges one by one.  Characters without a piece become bytes.

One pass over the texts, no shuffle.  The vocabulary (under 2 MB) is read on
the driver and broadcast; its path is a parameter.

Defined results: NULL and empty texts have no tokens and decode to the empty
text; a literal U+2581 is a space to the vocabulary and decodes as one; rows
with NULL ids and repeated rows are encoded like any other.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

SPACE = "▁"
CHUNK = re.compile(rf"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
#: Chunks and pairs of tokens a worker remembers, and text handled at once.
REMEMBERED, BATCH_BYTES = 600_000, 2 << 20
PAIRS = 4_000_000
SEPARATOR = 0x110000


class Vocabulary:
    """Pieces, merge scores and byte ids of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_file=path)
        if p.normalize("ﬁ  ① Å ") != f"{SPACE}ﬁ{SPACE}{SPACE}①{SPACE}Å{SPACE}":
            raise ValueError("only models without normalisation and with a leading space are supported")
        n = p.vocab_size()
        self.pieces = [p.id_to_piece(i) for i in range(n)]
        self.bytes = np.full(256, -1)
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.plain = np.zeros(n, bool)
        for i, s in enumerate(self.pieces):
            if p.is_byte(i):
                self.bytes[int(s[3:5], 16)] = i
            elif not (p.is_control(i) or p.is_unknown(i)):
                self.score[s], self.ids[s], self.plain[i] = p.get_score(i), i, True
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte fallback")
        if any(re.search(f"[^{SPACE}]{SPACE}", s) or "\n" in s for s in self.ids):
            raise ValueError("a piece reaches across a chunk's border")
        #: Pieces the merges can make; no other is ever part of an encoding.
        self.made = [s for s in self.ids if len(s) == 1 or self.merge(s) == [s]]

    def merge(self, text: str) -> list[str]:
        """Apply the merges to a short text: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the runs, end to end."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)


class _Index:
    """Suffix array of chunks laid end to end, ordered by ``depth`` characters
    (no piece is longer), and binary search in it.  Characters are coded from 1
    up (0: separator and end) and packed into 64-bit words."""

    def __init__(self, text: np.ndarray, depth: int):
        self.chars = np.unique(text[text != SEPARATOR])
        bits = max(1, int(len(self.chars)).bit_length())
        self.bits, self.per, n = bits, 64 // bits, len(text)
        codes = np.where(text == SEPARATOR, 0, np.searchsorted(self.chars, text) + 1).astype(np.uint64)
        padded = np.concatenate([codes, np.zeros(depth + self.per, np.uint64)])
        words = -(-depth // self.per)
        keys = [self._pack([padded[w * self.per + i:w * self.per + i + n] for i in range(self.per)]) for w in range(words)]
        self.sa = np.argsort(keys[0])
        # Suffixes that go on after the first word are ordered by the others too.
        first = keys[0][self.sa]
        longer = np.flatnonzero(first & np.uint64((1 << bits) - 1))
        if words > 1 and len(longer):
            part = self.sa[longer]
            self.sa[longer] = part[np.lexsort([k[part] for k in keys[::-1]])]
        self.keys = [k[self.sa] for k in keys]

    def _pack(self, columns: list[np.ndarray]) -> np.ndarray:
        key = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            key <<= np.uint64(self.bits)
            key |= c
        return key

    def _search(self, wanted: list[np.ndarray], after: bool) -> np.ndarray:
        """Number of suffixes before (or up to, if ``after``) each wanted key."""
        lo, hi = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(self.sa))
        while (lo < hi).any():
            mid = np.minimum((lo + hi) // 2, len(self.sa) - 1)
            less, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
            for k, w in zip(self.keys, wanted):
                own = k[mid]
                less |= same & (own < w)
                same &= own == w
            go = (less | same if after else less) & (lo < hi)
            lo, hi = np.where(go, mid + 1, lo), np.where(go, hi, np.minimum(mid, hi))
        return lo

    def ranges(self, pieces: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of the pieces occur, start and end of their ranges); pieces:
        code points in rows, filled up with zeros."""
        at = np.minimum(np.searchsorted(self.chars, pieces), len(self.chars) - 1)
        inside = np.arange(pieces.shape[1]) < lens[:, None]
        which = np.flatnonzero(((self.chars[at] == pieces) | ~inside).all(1))
        if not len(which):
            return which, which, which
        codes, inside = (at[which] + 1).astype(np.uint64), inside[which]
        bounds = []
        for fill, after in ((0, False), ((1 << self.bits) - 1, True)):
            c = np.where(inside, codes, np.uint64(fill))
            c = np.concatenate([c, np.full((len(c), self.per), fill, np.uint64)], 1)
            bounds.append(self._search([self._pack([c[:, w * self.per + i] for i in range(self.per)])
                                        for w in range(len(self.keys))], after))
        some = bounds[1] > bounds[0]
        return which[some], bounds[0][some], bounds[1][some]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.n = len(vocabulary.pieces)
        self.made_ids = np.array([vocabulary.ids[s] for s in vocabulary.made])
        self.made_len = np.array([len(s) for s in vocabulary.made])
        self.depth = int(self.made_len.max())
        self.made_points = np.zeros((len(self.made_ids), self.depth), np.uint32)
        points = np.frombuffer("".join(vocabulary.made).encode("utf-32-le"), np.uint32)
        self.made_points[np.arange(self.depth) < self.made_len[:, None]] = points
        # Pairs of tokens judged so far: a sorted table, and those since it was made.
        self.pairs, self.pair_fits, self.new_pairs = np.empty(0, np.int64), np.empty(0, bool), {}
        raw = self._raw()
        self.raw_len = np.array([len(b) for b in raw])
        self.raw_start = np.concatenate([[0], np.cumsum(self.raw_len)[:-1]])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self._forget()

    def _raw(self) -> list[bytes]:
        of_byte = {int(i): bytes([b]) for b, i in enumerate(self.v.bytes)}
        return [of_byte.get(i) or (s.replace(SPACE, " ").encode() if self.v.plain[i] else b"")
                for i, s in enumerate(self.v.pieces)]

    def _forget(self):
        self.known: dict[str, int] = {}
        self.flat: list[np.ndarray] = []
        self.lens: list[np.ndarray] = []

    def _text(self, token: int) -> str:
        return self.v.pieces[token] if token < self.n else chr(token - self.n)

    def _judge(self, pair: int) -> bool:
        got = self.new_pairs.get(pair)
        if got is None:
            a, b = self._text(pair >> 32), self._text(pair & 0xFFFFFFFF)
            got = self.new_pairs[pair] = self.v.merge(a + b) == [a, b]
        return got

    def _fit(self, pairs: np.ndarray) -> np.ndarray:
        """Whether merging the texts of two tokens gives back the two, for each pair."""
        some, inverse = np.unique(pairs, return_inverse=True)
        ok = np.zeros(len(some), bool)
        i = np.searchsorted(self.pairs, some)
        old = i < len(self.pairs)
        old[old] = self.pairs[i[old]] == some[old]
        ok[old] = self.pair_fits[i[old]]
        ok[~old] = [self._judge(p) for p in some[~old].tolist()]
        return ok[inverse]

    def _file_pairs(self):
        if len(self.pairs) + len(self.new_pairs) > PAIRS:
            self.pairs, self.pair_fits = np.empty(0, np.int64), np.empty(0, bool)
        pairs = np.concatenate([self.pairs, np.fromiter(self.new_pairs, np.int64, len(self.new_pairs))])
        fits = np.concatenate([self.pair_fits, np.fromiter(self.new_pairs.values(), bool, len(self.new_pairs))])
        order = np.argsort(pairs)
        self.pairs, self.pair_fits, self.new_pairs = pairs[order], fits[order], {}

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the chunks end to end, and how many each has."""
        lens = np.array([len(c) for c in chunks])
        starts = np.concatenate([[0], np.cumsum(lens + 1)[:-1]])
        text = np.full(int((lens + 1).sum()), SEPARATOR, np.uint32)
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        text[spread(starts, lens)] = points
        index = _Index(text, self.depth)
        which, lo, hi = index.ranges(self.made_points, self.made_len)
        count = hi - lo
        at = index.sa[spread(lo, count)]
        token, size = np.repeat(self.made_ids[which], count), np.repeat(self.made_len[which], count)
        bare = [c for c in index.chars.tolist() if chr(c) not in self.v.ids]  # characters without a piece
        if bare:
            own = np.flatnonzero(np.isin(text, bare))
            at, token = np.concatenate([at, own]), np.concatenate([token, self.n + text[own].astype(np.int64)])
            size = np.concatenate([size, np.ones(len(own), np.int64)])
        chunk_start = np.repeat(starts, lens + 1)
        end = at - chunk_start[at] + size  # place in its chunk
        order = np.argsort(end.astype(np.uint16) if end.max() < 65536 else end, kind="stable")
        at, token, size, end = at[order], token[order], size[order], end[order]
        # last[p], back[p]: last token of the encoding of a chunk up to p, and where it begins.
        last, back = np.full(len(text) + 1, -1, np.int64), np.zeros(len(text) + 1, np.int64)
        cuts = np.append(np.flatnonzero(np.diff(end, prepend=0)), len(end))
        for i, j in zip(cuts[:-1], cuts[1:]):
            s, t, n = at[i:j], token[i:j], size[i:j]
            first = s == chunk_start[s]
            take = first.copy()
            if not first.all():
                rest = np.flatnonzero(~first)
                take[rest] = self._fit((last[s[rest]] << 32) | t[rest])
            s, t, n = s[take], t[take], n[take]
            last[s + n], back[s + n] = t, s
        self._file_pairs()
        on = np.zeros(len(text) + 1, bool)
        p = starts + lens
        while len(p):
            on[p] = True
            p = back[p]
            p = p[p != chunk_start[p]]
        ends = np.flatnonzero(on)
        out, of = last[ends], np.searchsorted(starts, ends - 1, side="right") - 1
        if (out < 0).any():
            raise AssertionError("a position has no encoding")
        n_tokens = np.bincount(of, minlength=len(chunks))
        if (out >= self.n).any():  # bytes of the characters without a piece
            parts = [self.v.bytes[list(chr(t - self.n).encode("utf-8", "surrogatepass"))] if t >= self.n else [t] for t in out.tolist()]
            n_tokens = np.bincount(of, weights=[len(x) for x in parts], minlength=len(chunks)).astype(np.int64)
            out = np.concatenate(parts)
        return out.astype(np.int32), n_tokens

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the texts end to end, and how many each has."""
        per_text = [CHUNK.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        chunks = [c for x in per_text for c in x]
        if not chunks:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        if len(self.known) > REMEMBERED:
            self._forget()
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if new:
            ids, lens = self._encode_chunks(new)
            base = len(self.known)
            self.known.update(zip(new, range(base, base + len(new))))
            self.flat, self.lens = [np.concatenate([*self.flat, ids])], [np.concatenate([*self.lens, lens])]
        flat, lens = self.flat[0], self.lens[0]
        starts = np.cumsum(lens) - lens
        which = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        n = lens[which]
        text_of = np.repeat(np.arange(len(texts)), [len(x) for x in per_text])
        return flat[spread(starts[which], n)], np.bincount(text_of, weights=n, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of the ids, ``counts`` of them each."""
        n = self.raw_len[ids]
        data = self.raw[spread(self.raw_start[ids], n)].tobytes()
        cut = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        out = [data[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:])]
        return [t[1:] if t.startswith(" ") else t for t in out]


#: The encoder of this worker process: tasks that follow on it go on with what
#: it has met.  What it remembers is bounded and never changes a result; it is
#: let go when no task has asked for it for a while, as workers are shared with
#: other operators.
_kept: list[Encoder] = []
_letting_go: list[threading.Timer] = []
KEPT_SECONDS = 5


@contextmanager
def _encoder(vocabulary: Vocabulary) -> Iterator[Encoder]:
    while _letting_go:
        _letting_go.pop().cancel()
    encoder = _kept.pop() if _kept else None
    if encoder is None or encoder.v.score != vocabulary.score:
        encoder = Encoder(vocabulary)
    try:
        yield encoder
    finally:
        _kept[:] = [encoder]
        timer = threading.Timer(KEPT_SECONDS, _kept.clear)
        timer.daemon = True
        timer.start()
        _letting_go.append(timer)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, n_tokens, round_trip (decoding gives the text back, a
    literal U+2581 counting as a space) for every row."""
    held = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _encoder(held.value) as encoder:
            for batch in batches:
                for part in blocks(batch, "text", BATCH_BYTES):
                    texts = [t or "" for t in part.column(1).to_pylist()]
                    ids, counts = encoder.encode(texts)
                    back = encoder.decode(ids, counts)
                    same = [a == b or a == b.replace(SPACE, " ") for a, b in zip(back, texts)]
                    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                         pa.array(counts, pa.int64()), pa.array(same)], ["doc_id", "ids", "n_tokens", "round_trip"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids array<int>, n_tokens long, round_trip boolean")


def decode(tokens: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text from doc_id, ids (NULL ids: the empty text)."""
    held = tokens.sparkSession.sparkContext.broadcast(Vocabulary(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _encoder(held.value) as encoder:
            for batch in batches:
                rows = batch.column(1).to_pylist()
                counts = np.array([len(r or ()) for r in rows], np.int64)
                ids = np.fromiter((i for r in rows for i in r or ()), np.int64)
                text = pa.array(encoder.decode(ids, counts), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), text], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
