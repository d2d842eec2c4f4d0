"""Periodic runs of words, found in a grammar of the text.

A run is a stretch of consecutive words with smallest period q and at least
max(6, 4 q) words that no neighbouring word extends.  Each text's word ids are
compressed by Re-Pair: the pair of neighbouring symbols that occurs most often
becomes a symbol of its own, again and again, until no pair occurs twice.
Pairs that do not overlap a more frequent one are replaced in the same round
(equally frequent ones in a fixed mixed order), and all texts of a batch at
once.  A run lies wholly inside some symbol and across the boundary of its two
parts, or across a boundary of the symbols that are left at the end, which are
paired up into a balanced tree.  So for every symbol, and every node of that
tree, the runs across its one boundary are computed once: one of the two sides
of a boundary holds two periods, so hashes of neighbouring stretches tell the
periods that come into question, and the run is extended from there as far as
the symbol goes.  Its runs are then put at every place where the symbol was
derived, and intervals of one period that overlap by it are one run.

Boundaries where a pair occurs once never join again; such a boundary between
two words of the text (not yet symbols) also lies in no run, as a run repeats
each of its pairs, so only the stretches between them are looked at.  Hashes
only propose: every run is compared word for word before it is returned.

One pass over the texts, no shuffle; each text on its own.

Defined results: NULL and empty texts have no words and no runs; words are cut
at the six ASCII white spaces only; repeated rows and NULL ids are judged like
any other; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

LEAST, TIMES = 6, 4  # a run has at least max(LEAST, TIMES * period) words
#: (boundary, period) pairs looked at together: bounds the memory of a batch.
TOGETHER = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - first, counts)


class Grammar:
    """Re-Pair of the texts that ``ids`` holds end to end (``text``: the number
    of the text of each word).  ``joined``, ``repeated``: whether a symbol
    reaches across the boundary before a word, whether the pair of words there
    occurs twice in its text; ``first``, ``part``, ``length``: of each symbol a
    place in ``ids``, the length of its left part and its own;
    ``places``, ``symbols``: every place where a symbol was derived."""

    def __init__(self, ids: np.ndarray, text: np.ndarray):
        n = len(ids)
        self.joined, self.repeated = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        # Symbols of one text are never those of another, so no pair counts across texts.
        symbol = np.unique(text * (int(ids.max(initial=0)) + 1) + ids, return_inverse=True)[1]
        at, length, link = np.arange(n), np.ones(n, np.int64), np.zeros(n, bool)
        link[:-1] = text[1:] == text[:-1]  # to the symbol on the right
        fresh, made = int(symbol.max(initial=-1)) + 1, []
        known, first_round = 0, True
        while link.any():
            i = np.flatnonzero(link)
            pairs, key = np.unique(symbol[i] * fresh + symbol[i + 1], return_inverse=True)
            if first_round:
                self.repeated[at[i + 1]] = np.bincount(key)[key] > 1
                first_round = False
            # In a block of equal symbols every second boundary stands back, as its pairs overlap.
            same, opens = symbol[i] == symbol[i + 1], np.ones(len(i), bool)
            opens[1:] = ~(same[1:] & same[:-1] & (np.diff(i) == 1))
            since = np.arange(len(i)) - np.maximum.accumulate(np.where(opens, np.arange(len(i)), 0))
            ready = since % 2 == 0
            often = np.bincount(key[ready], minlength=len(pairs))[key]
            link[i[often < 2]] = False
            ready &= often >= 2
            i, key, often = i[ready], key[ready], often[ready]
            if len(i):
                mixed = np.argsort(np.arange(len(pairs), dtype=np.uint64) * MIX)  # no order of equals that follows the text
                weight = np.zeros(len(link) + 2, np.int64)
                weight[i + 1] = often * (len(pairs) + 1) + mixed[key] + 1
                best = (weight[i + 1] > weight[i]) & (weight[i + 1] > weight[i + 2])
                i, key = i[best], key[best]
                rules, one, which = np.unique(key, return_index=True, return_inverse=True)
                made.append((at[i[one]], length[i[one]], length[i[one]] + length[i[one] + 1], at[i], known + which))
                self.joined[at[i + 1]] = True
                symbol[i], link[i] = fresh + which, link[i + 1]
                length[i] += length[i + 1]
                known, fresh = known + len(rules), fresh + len(rules)
                link = np.delete(link, i + 1)
                symbol, at, length = np.delete(symbol, i + 1), np.delete(at, i + 1), np.delete(length, i + 1)
            open_ = link.copy()
            open_[1:] |= link[:-1]
            symbol, at, length, link = symbol[open_], at[open_], length[open_], link[open_]  # the others are settled
        columns = zip(*made) if made else [[np.zeros(0, np.int64)]] * 5
        self.first, self.part, self.length, self.places, self.symbols = (np.concatenate(c) for c in columns)

    def remainder(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """lo, mid, hi of the nodes of balanced trees over the symbols that are
        left, one tree for each stretch of repeated pairs that can hold a run."""
        n = len(text)
        cuts = np.flatnonzero(~self.repeated[:n])  # stretches start here
        ends = np.append(cuts[1:], n)
        long = ends - cuts >= LEAST
        cuts, ends = cuts[long], ends[long]
        places = spans(cuts, ends - cuts)
        stretch = np.repeat(np.arange(len(cuts)), ends - cuts)
        starts = ~self.joined[places]
        places, stretch, nodes = places[starts], stretch[starts], []
        while len(places):
            new = np.ones(len(places), bool)
            new[1:] = stretch[1:] != stretch[:-1]
            rank = np.arange(len(places)) - np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
            after = np.append(places[1:], n)
            stop = np.where(np.append(new[1:], True), ends[stretch], after)  # where each place's symbols end
            left = np.flatnonzero((rank % 2 == 0) & ~np.append(new[1:], True))
            nodes.append((places[left], places[left + 1], stop[left + 1]))
            even = rank % 2 == 0
            if even.all():
                break
            places, stretch = places[even], stretch[even]
        if not nodes:
            return (np.zeros(0, np.int64),) * 3
        lo, mid, hi = (np.concatenate(x) for x in zip(*nodes))
        return lo, mid, hi


class Hashes:
    """Equality of stretches of words by polynomial hashes modulo 2**64."""

    def __init__(self, ids: np.ndarray, base: int = 0x5851F42D4C957F2D):
        words = (ids.astype(np.uint64) + np.uint64(1)) * MIX
        words ^= words >> np.uint64(29)
        self.power = np.full(len(ids) + 1, base | 1, np.uint64)
        self.power[0] = 1
        self.power = np.cumprod(self.power, dtype=np.uint64)
        self.upto = np.concatenate([[np.uint64(0)], np.cumsum(words * self.power[:-1], dtype=np.uint64)])

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words from a (< b) are those from b, but for a collision."""
        return (self.upto[a + size] - self.upto[a]) * self.power[b - a] == self.upto[b + size] - self.upto[b]

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words from a and b on (step 1) or back (step -1) agree, at most ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            shift = middle if step < 0 else 0
            fits = self.equal(a - shift, b - shift, middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def _least_period(node, start, end, period):
    """One row of each (node, start, end): that of the smallest period."""
    order = np.lexsort((period, end, start, node))
    node, start, end, period = node[order], start[order], end[order], period[order]
    first = np.ones(len(node), bool)
    first[1:] = (np.diff(node) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0)
    return node[first], start[first], end[first], period[first]


def _by_words(ids: np.ndarray, lo: int, mid: int, hi: int) -> list[tuple[int, int, int]]:
    """start, end, period of the runs of a stretch that touch ``mid``, word by word."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, (hi - lo) // TIMES + 1):
        same = np.concatenate([[False], ids[lo:hi - q] == ids[lo + q:hi], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip((lo + edges[::2]).tolist(), (lo + edges[1::2] + q).tolist()):
            if e - s >= max(LEAST, TIMES * q) and s <= mid <= e:
                found.setdefault((s, e), q)
    return [(s, e, q) for (s, e), q in found.items()]


def runs_across(ids: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray, hashes: Hashes):
    """node, start, end, period of the runs of each stretch lo..hi that touch mid."""
    most = np.minimum((hi - lo) // TIMES, np.maximum(hi - mid, mid - lo) // 2)
    most[hi - lo < LEAST] = 0
    upto = np.cumsum(most)
    found = [(np.zeros(0, np.int64),) * 4]
    for begin in range(0, int(most.sum()), TOGETHER):
        flat = np.arange(begin, min(begin + TOGETHER, int(upto[-1])))
        node = np.searchsorted(upto, flat, "right")
        q = flat - (upto[node] - most[node]) + 1
        m = mid[node]
        right, left = m + 2 * q <= hi[node], m - 2 * q >= lo[node]  # two periods there
        right[right] = ids[m[right]] == ids[(m + q)[right]]
        left[left] = ids[(m - 1)[left]] == ids[(m - 1 - q)[left]]
        anchor = np.concatenate([m[right], (m - 2 * q)[left]])
        node, q = np.concatenate([node[right], node[left]]), np.concatenate([q[right], q[left]])
        square = hashes.equal(anchor, anchor + q, q)
        anchor, node, q = anchor[square], node[square], q[square]
        end = anchor + 2 * q + hashes.reach(anchor + q, anchor + 2 * q, hi[node] - anchor - 2 * q, 1)
        start = anchor - hashes.reach(anchor, anchor + q, anchor - lo[node], -1)
        long = end - start >= np.maximum(LEAST, TIMES * q)
        found.append(_least_period(node[long], start[long], end[long], q[long]))
    node, start, end, period = _least_period(*(np.concatenate(x) for x in zip(*found)))
    wrong = set()
    for k, s, e, q in zip(node.tolist(), start.tolist(), end.tolist(), period.tolist()):
        if not np.array_equal(ids[s:e - q], ids[s + q:e]):
            wrong.add(k)  # hashes of different words met
    if wrong:
        right = ~np.isin(node, list(wrong))
        again = [(k, *r) for k in sorted(wrong) for r in _by_words(ids, int(lo[k]), int(mid[k]), int(hi[k]))]
        more = np.array(again, np.int64).reshape(-1, 4).T
        node, start, end, period = (np.concatenate([x[right], y]) for x, y in zip((node, start, end, period), more))
    return node, start, end, period


def find_runs(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length, period of all runs of the texts that ``ids`` holds end to
    end, in order of start and period."""
    grammar, hashes = Grammar(ids, text), Hashes(ids)
    # Inside the symbols, once each, and from there to every place of theirs ...
    node, start, end, period = runs_across(ids, grammar.first, grammar.first + grammar.part,
                                           grammar.first + grammar.length, hashes)
    start, end = start - grammar.first[node], end - grammar.first[node]
    each = np.bincount(node, minlength=len(grammar.first))
    run = np.argsort(node, kind="stable")[spans((np.cumsum(each) - each)[grammar.symbols], each[grammar.symbols])]
    place = np.repeat(grammar.places, each[grammar.symbols])
    # ... and across the boundaries that are left.
    _, top_start, top_end, top_period = runs_across(ids, *grammar.remainder(text), hashes)
    start = np.concatenate([start[run] + place, top_start])
    end = np.concatenate([end[run] + place, top_end])
    period = np.concatenate([period[run], top_period])
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    if not len(start):
        return start, end, period
    # Parts of one run overlap by its period at least, different runs of a period by less.
    apart = period * (len(ids) + 1)
    reach = np.maximum.accumulate(end + apart)
    new = np.ones(len(start), bool)
    new[1:] = (start + apart)[1:] > reach[:-1] - period[1:]
    first = np.flatnonzero(new)
    start, period = start[first], period[first]
    length = np.append(reach[first[1:] - 1], reach[-1]) - period * (len(ids) + 1) - start
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


Edit = Callable[[int | None, list[bytes]], list[bytes]]
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _batch(rows: list[list[bytes]]) -> tuple[list[list[dict]], list[bytes]]:
    """The runs of each text, and its words without those that repeat a period."""
    names: dict[bytes, int] = {}
    ids = np.array([names.setdefault(w, len(names)) for words in rows for w in words], np.int64)
    sizes = np.array([len(words) for words in rows], np.int64)
    begins = np.cumsum(sizes) - sizes
    start, length, period = find_runs(ids, np.repeat(np.arange(len(rows)), sizes))
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change)[:-1] == 0
    of = np.searchsorted(begins, start, "right") - 1
    runs: list[list[dict]] = [[] for _ in rows]
    for k, s, n, q in zip(of.tolist(), start.tolist(), length.tolist(), period.tolist()):
        runs[k].append({"start": s - int(begins[k]), "length": n, "period": q})
    short = {k for k, r in enumerate(runs) if r}
    out = [b" ".join([w for w, k in zip(words, kept[b:b + len(words)].tolist()) if k] if i in short else words)
           for i, (words, b) in enumerate(zip(rows, begins.tolist()))]
    return runs, out


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """doc_id, runs (array of start, length, period, by start and period),
    collapsed (the words, one space apart, without those that a run contains
    after its first period) of every row.  ``edit`` may change the words of a
    text before that, given its id and its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                rows = [(t or "").encode().split() for t in part.column(1).to_pylist()]
                if edit:
                    rows = [edit(i, words) for i, words in zip(part.column(0).to_pylist(), rows)]
                runs, collapsed = _batch(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(runs, RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")

