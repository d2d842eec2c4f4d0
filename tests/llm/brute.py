"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib

import numpy as np
import xxhash


def simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, ids, radius=3):
    """Smallest id reachable from each row."""
    a = np.array(fps, np.uint64)
    parent = list(range(len(a)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= radius):
            x, y = root(i), root(i + 1 + int(j))
            parent[max(x, y)] = min(x, y)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(a))]


def repeats(rows, width=100):
    """rows: (doc_id, text) in order of their ids -> (n_bytes, n_removed, n_spans, sha256, kept bytes) each."""
    seen, out = set(), []
    for _, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            s = b[p:p + width]
            if s in seen:
                gone[p:p + width] = b"\1" * width
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def template(text, units):
    t = re.sub("\u0002", " ", text or "")
    t = re.sub(r"([^.!?\t\n\x0b\f\r ] )((?:[A-Z]|[ÀÂÄÇÈÉÊËÎÏÑÓÔÖÚÛÜ])[a-zà-öø-ÿß])", "\\1\u0002\\2", t)
    t = re.sub(r"([0-9])[.,]([0-9])", r"\1_\2", t)
    words = [w for w in re.sub("[^\\w\u0002]+", " ", t).lower().split(" ") if w]
    out = []
    for i, w in enumerate(words):
        rest = re.sub("[0-9_]", "", w)
        if w[0] in "0123456789":
            out.append((1, w) if not rest else (3, w) if rest in units else (0, w))
        elif w[0] == "\u0002":
            out.append((2, w))
        elif w in units and i and words[i - 1][0] in "0123456789":
            out.append((4, w))
        else:
            out.append((0, w))
    return out


def leaks(docs, items, units, width=5, share=0.8):
    """Windows with the same template at each offset; of the values of a slot the most frequent one (then the first) counts."""
    key = lambda ws: tuple(w if k == 0 else k for k, w in ws)
    by, places = {}, {}
    for n, (item, text) in enumerate(sorted(set(items), key=str)):
        t = template(text, units)
        places[n] = item, len(t) - width + 1
        for p in range(len(t) - width + 1):
            by.setdefault(key(t[p:p + width]), []).append((n, p, t[p:p + width]))
    best = {}
    for doc, text in set(docs):
        t, found = template(text, units), {}
        for p in range(len(t) - width + 1):
            own = t[p:p + width]
            for item, q, theirs in by.get(key(own), ()):
                found.setdefault((item, p - q), []).append((q, theirs, own))
        matched = {}
        for (item, _), wins in found.items():
            if not any(a == b or any(k == 0 for k, _ in a) for _, a, b in wins):
                continue  # nothing but placeholders
            at = {}
            for q, theirs, own in wins:
                for j, (a, b) in enumerate(zip(theirs, own)):
                    if a[0]:
                        at.setdefault((*a, b[1]), set()).add(q + j)
            top = {}
            for (kind, a, b), where in at.items():
                top.setdefault((kind, a), []).append((-len(where), min(where), b))
            top = {x: min(v)[2] for x, v in top.items()}
            for q, theirs, own in wins:
                if theirs == own or all(not a[0] or top[a] == b[1] for a, b in zip(theirs, own)):
                    m = matched.setdefault(item, [set(), False])
                    m[0].add(q)
                    m[1] |= theirs != own
        for n, (spots, reworded) in matched.items():
            item, total = places[n]
            if len(spots) >= share * total:
                old = best.get((doc, item, total), (0, False))
                best[doc, item, total] = max(old, (len(spots), not reworded))
    return {(doc, item, n, total, not literal) for (doc, item, total), (n, literal) in best.items()}


def runs(words):
    """(start, length, period) of every run, by start and period: each period against the whole text."""
    a, found = np.array([hash(w) for w in words], np.int64), {}
    for q in range(1, len(a) // 4 + 1):
        same = np.concatenate([[False], a[:-q] == a[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), (edges[1::2] + q).tolist()):
            if e - s >= max(6, 4 * q):
                found.setdefault((s, e), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words):
    gone = {i for s, n, q in runs(words) for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def damage(rows):
    """(conv, turn, role, text) rows -> the same after damage, by turn (none first), role and digest."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), digest(r)))


def conversation(rows):
    """The nine values of a conversation (without its id): all edits of each row are tried, the least (cost, audit) is kept."""
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    kinds, seen = [], set()
    for _, _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    def after(state, initial):  # states: what the roles so far match
        return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(initial)

    best = {s: (0, "", ()) for s in ("", "a")}
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            _, _, role, text = rows[i]
            more, now = 5 * (kinds[i] == "truncated"), {}
            for s in ("", "s", "u", "a"):
                options = [(2, "D", (), s)]
                if kinds[i] in ("", "truncated"):
                    options.append((more, "K", ((role, text),), after(s, role[:1])))
                    options += [(1 + more, "R", ((r, text),), after(s, r[0])) for r in ("user", "assistant")]
                options = [(best[t][0] + w, e + best[t][1], out + best[t][2]) for w, e, out, t in options if t in best]
                if options:
                    now[s] = min(options)
            best = now
        for _ in range(3):  # rows inserted here
            for s in ("", "s", "u", "a"):
                for r in ("user", "assistant"):
                    t = after(s, r[0])
                    if t in best:
                        b = best[t]
                        best[s] = min(best.get(s, (1 << 60, "", ())), (b[0] + 5, "I" + b[1], ((r, ""),) + b[2]))
    cost, audit, out = best[""]
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
