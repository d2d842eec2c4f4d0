"""Conversation structure repair: the cheapest edits that give alternating turns.

The rows of a conversation, in order of their turn, are kept (K), given another
role (R), deleted (D) or preceded by inserted rows (I), so that the initials of
the roles that result match ``(s?(ua)+)?``.  K costs 0, R 1, D 2, I 5; a
truncated row that stays costs 5 more; blank rows and repeated ones must go.

The states of the pattern before each row are the nodes of a graph, the edits
its arcs.  A cost DP from the end gives each node its cost to go, which leaves
the optimal arcs.  Nodes are then ranked by the audits (edit initials) that can
follow them, for audit lengths of 1, 2, 4, 8, ...: a node's rank for twice the
length is that of the pair of its own rank and the rank of the node it reaches
in that many edits.  An arc is chosen by its initial and then the rank of the
node it leads to; the least audit is read off by following the doubled pointers.

Large conversations are never held in one task.  Rows are reduced to ids, turn,
role, fault and a 128-bit digest of role and text; equal ones are counted
together, earlier ones with the same digest are found by an aggregate and a
join, and the small rows are dealt by range of (conversation, turn) into
sections of about ``SECTION_ROWS`` rows, which is what a task holds at once.  A conversation that reaches over several sections is solved by
pieces: each section gives its costs from state to state, these are chained
back, each section then gives the state it is left in for each one it is
entered in, and these are chained forward.  At most one conversation reaches
over each border of two sections, so what is chained is bounded by their number.
The texts move once, to be written in order: the digest of a whole repaired
conversation is a running SHA-256, so its rows stream through one task, which
holds one row (and the audit) at a time.

Defined results: NULL roles and texts are one space; rows without a turn come
first, and rows of one turn in the order of role and digest; NULL is a
conversation of its own; empty tables have no conversations; repeated rows are
duplicates of the first one; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SPACES, ENDS = r"\x20\x09-\x0D", ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the pattern: nothing yet, after s, after u, after ua (a whole number of pairs).
START, S, U, A = range(4)
INSERTED = (U, U, A, U)  # where an inserted row (or a row with a new role) leads
TO = {U: "u", A: "a"}
ROLES = {"u": "user", "a": "assistant"}
KEPT = {("s", START): S, ("u", START): U, ("u", S): U, ("u", A): U, ("a", U): A}
LEGAL = ("su", "ua", "au")
LETTERS = "DIKR"
CODE = {x: i for i, x in enumerate(LETTERS)}
FAR = 1 << 50  # no path
#: Rows of a section, about: what a task holds at once.
SECTION_ROWS = 50_000
Row = tuple[str, str]  # initial of the role, fault
ORDER = ["turn", "role", "digest"]


def faults(text: Column) -> Column:
    """blank, truncated or whole."""
    end = F.right(F.regexp_replace(text, rf"[{SPACES}]+\z", ""), F.lit(1))
    return F.when(end == "", "blank").when(~end.isin(*ENDS), "truncated").otherwise("whole")


def clean(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest of every row."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    return rows.withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, n, fault: one row of each set of equal rows,
    ``n`` of them; the fault is that of the first (the others repeat it)."""
    counted = rows.groupBy("conv_id", *ORDER).agg(F.count("*").alias("n"), F.min(faults(F.col("text"))).alias("fault"))
    # The place of the first of equal role and text is its least turn, none before all.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    counted = counted.withColumn("at", turn)
    first = counted.groupBy("conv_id", "digest").agg(F.min("at").alias("first")).select(
        F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "first")
    both = counted.join(first, counted["conv_id"].eqNullSafe(first["_conv"]) & (counted["digest"] == first["_digest"]))
    repeated = (F.col("fault") != "blank") & ~F.col("at").eqNullSafe(F.col("first"))
    return both.select("conv_id", *ORDER, "n", F.when(repeated, "duplicate").otherwise(F.col("fault")).alias("fault"))


# -- one section of one conversation ------------------------------------------------
def arcs(state: int, initial: str, fault: str) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row met in a state."""
    out = [("D", DELETE, state)]
    if fault in ("whole", "truncated"):
        more = TRUNCATED * (fault == "truncated")
        if (initial, state) in KEPT:
            out.append(("K", KEEP + more, KEPT[initial, state]))
        out.append(("R", REROLE + more, INSERTED[state]))
    return out


def with_inserts(costs: list[int]) -> list[int]:
    """Costs to go by state, when rows may be inserted first."""
    start, s, u, a = costs
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return [min(start, INSERT + u), min(s, INSERT + u), u, a]


END = with_inserts([0, FAR, FAR, 0])  # behind the last row of a conversation


def costs_to_go(rows: list[Row], after: list[int]) -> list[list[int]]:
    """The cost to go from every state, before each row and behind the last (``after``)."""
    arc = {row: [arcs(s, *row) for s in range(4)] for row in set(rows)}
    out = [after]
    for row in reversed(rows):
        c = out[-1]
        out.append(with_inserts([min([w + c[t] for _, w, t in options]) for options in arc[row]]))
    return out[::-1]


def crossing_costs(rows: list[Row]) -> list[list[int]]:
    """The cost of the rows from each state before them to each state behind them."""
    to = [costs_to_go(rows, [0 if s == t else FAR for s in range(4)])[0] for t in range(4)]
    return [[min(FAR, to[t][s]) for t in range(4)] for s in range(4)]


class OptimalArcs:
    """The optimal arcs of sections (rows, costs to go behind them, whether the
    conversation ends there), all in one graph: node (place, state) of a section
    is ``offset + 4 * place + state``, and the node after all others is where
    paths stop.  Ranks and doubled pointers as told in the module's notes."""

    def __init__(self, sections: list[tuple[list[Row], list[int], bool]]):
        self.offset, letters, targets, total = [], [], [], 0
        for rows, _, _ in sections:
            self.offset.append(total)
            total += 4 * (len(rows) + 1)
        self.stop, none = total, len(LETTERS)
        for o, (rows, after, last) in zip(self.offset, sections):
            go = costs_to_go(rows, after)
            arc = {row: [arcs(s, *row) for s in range(4)] for row in set(rows)}
            for place, costs in enumerate(go):
                here = o + 4 * place
                for state, cost in enumerate(costs):
                    letter, target = [none] * 4, [total] * 4
                    if place < len(rows):
                        for edit, w, t in arc[rows[place]][state]:
                            if w + go[place + 1][t] == cost < FAR:
                                letter[CODE[edit]], target[CODE[edit]] = CODE[edit], here + 4 + t
                    if (place < len(rows) or last) and INSERT + costs[INSERTED[state]] == cost < FAR:
                        letter[CODE["I"]], target[CODE["I"]] = CODE["I"], here + INSERTED[state]
                    letters.append(letter)
                    targets.append(target)
        letter, target = np.array([*letters, [none] * 4], np.int64), np.array([*targets, [total] * 4], np.int64)
        at = np.arange(total + 1)
        # Ranks by the first 1, 2, 4, ... initials that can follow, 0 where none does; a node's arcs differ in theirs.
        first = letter.argmin(1)
        rank, jump = (letter[at, first] + 1) % (none + 1), target[at, first]
        while (jump != total).any():
            rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
            jump = jump[jump]
        # The arc that begins the least audit, and the pointers along it, doubled.
        chosen = (letter * (int(rank.max()) + 1) + rank[target]).argmin(1)
        self.edit, jump = letter[at, chosen], target[at, chosen]
        self.jumps = [jump]
        while (jump != total).any():
            jump = jump[jump]
            self.jumps.append(jump)

    def paths(self, entries: list[tuple[int, int]]) -> list[tuple[list[tuple[int, str, int]], int]]:
        """For each (section, state it is entered in): the edits in order as
        (place, initial, state after it), and the state it is left in."""
        node = np.array([self.offset[k] + s for k, s in entries], np.int64)
        which, step = np.arange(len(entries)), np.zeros(len(entries), np.int64)
        for power, jump in enumerate(self.jumps):
            node, which, step = (np.concatenate(x) for x in ((node, jump[node]), (which, which), (step, step + (1 << power))))
            on = node != self.stop
            node, which, step = node[on], which[on], step[on]
        order = np.lexsort((step, which))
        node, which = node[order], which[order]
        cuts = np.searchsorted(which, np.arange(len(entries) + 1)).tolist()
        local, edit, out = node - np.array(self.offset, np.int64)[[entries[w][0] for w in which.tolist()]], self.edit[node], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            l, e = local[a:b].tolist(), edit[a:b].tolist()
            out.append(([(x // 4, LETTERS[c], y % 4) for x, c, y in zip(l, e, l[1:])], l[-1] % 4))
        return out


# -- sections on Spark --------------------------------------------------------------
def _rows(table: pa.Table) -> list[dict]:
    """The section's rows in order: conversation, turn (none first), role, digest."""
    low = -(1 << 63)
    key = lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["turn"] is not None,
                     low if r["turn"] is None else r["turn"], r["role"].encode(), r["digest"])
    return sorted(table.to_pylist(), key=key)


def _by_conversation(rows: list[dict]) -> list[list[dict]]:
    out: list[list[dict]] = []
    for r in rows:
        if not out or out[-1][0]["conv_id"] != r["conv_id"]:
            out.append([])
        out[-1].append(r)
    return out


def _graph_rows(rows: list[dict]) -> list[Row]:
    return [(r["role"][:1], r["fault"]) for r in rows]


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


COSTS = pa.schema([("conv_id", pa.int64()), ("section", pa.int32()), ("costs", pa.list_(pa.int64()))])
EXITS = pa.schema([("conv_id", pa.int64()), ("section", pa.int32()), ("after", pa.list_(pa.int64())), ("last", pa.bool_())])
LEFT = pa.schema([("conv_id", pa.int64()), ("section", pa.int32()), ("states", pa.list_(pa.int64()))])
ENTRIES = pa.schema([*EXITS, ("entry", pa.int64())])
EDITS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.string()), ("n", pa.int64()),
                   ("fault", pa.string()), ("before", pa.string()), ("edit", pa.string()), ("to", pa.string()), ("behind", pa.string())])


def _section_costs(table: pa.Table) -> pa.Table:
    rows = _rows(table)
    costs = crossing_costs(_graph_rows(rows))
    return _table([{"conv_id": rows[0]["conv_id"], "section": rows[0]["section"], "costs": sum(costs, [])}], COSTS)


def _chained_costs(table: pa.Table) -> pa.Table:
    after, out = END, []
    for r in sorted(table.to_pylist(), key=lambda r: -r["section"]):
        out.append({"conv_id": r["conv_id"], "section": r["section"], "after": after, "last": not out})
        after = [min([r["costs"][4 * s + t] + after[t] for t in range(4)]) for s in range(4)]
    return _table(out, EXITS)


def _section_exits(table: pa.Table) -> pa.Table:
    rows = _rows(table)
    graph = OptimalArcs([(_graph_rows(rows), rows[0]["after"], rows[0]["last"])])
    return _table([{"conv_id": rows[0]["conv_id"], "section": rows[0]["section"],
                    "states": [end for _, end in graph.paths([(0, s) for s in range(4)])]}], LEFT)


def _chained_states(table: pa.Table) -> pa.Table:
    state, out = START, []
    for r in sorted(table.to_pylist(), key=lambda r: r["section"]):
        out.append({k: r[k] for k in ("conv_id", "section", "after", "last")} | {"entry": state})
        state = r["states"][state]
    return _table(out, ENTRIES)


def _section_edits(table: pa.Table) -> pa.Table:
    convs = _by_conversation(_rows(table))
    graph = OptimalArcs([(_graph_rows(c), c[0]["after"] or END, c[0]["last"] is not False) for c in convs])
    out = []
    for conv, (path, _) in zip(convs, graph.paths([(k, c[0]["entry"] or START) for k, c in enumerate(convs)])):
        for r in conv:
            r |= {"before": "", "edit": "", "to": "", "behind": ""}
        for place, edit, state in path:
            if edit == "I":  # before the row, or behind the last
                r, side = (conv[place], "before") if place < len(conv) else (conv[-1], "behind")
                r[side] += TO[state]
            else:
                conv[place] |= {"edit": edit, "to": TO[state] if edit == "R" else ""}
        out += conv
    return _table([{k: r[k] for k in EDITS.names} for r in out], EDITS)


def _grouped(df: DataFrame, keys: list[str], function, schema: str) -> DataFrame:
    return df.groupBy(*keys).applyInArrow(function, schema)


def edits(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, n, fault of :func:`distinct_rows` of
    :func:`clean` rows with the edit of each: ``before`` (initials of the roles
    inserted before it), ``edit`` (D, K or R; the other n - 1 go), ``to`` (the
    initial of its new role), ``behind`` (inserted behind the last row)."""
    small = written(distinct_rows(rows), "conversation-rows")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    n_sections = max(1, -(-small.count() // SECTION_ROWS))
    dealt = written(small.repartitionByRange(n_sections, *order).withColumn("section", F.spark_partition_id()), "conversation-sections")
    # Conversations in several sections: fewer than there are sections, as each reaches over a border of two.
    wide = (dealt.groupBy("conv_id").agg(F.min("section").alias("a"), F.max("section").alias("b"))
            .where("a < b").select(F.col("conv_id").alias("_conv")))
    pieces = dealt.join(F.broadcast(wide), F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    key = "conv_id long, section int"
    costs = _grouped(pieces, ["conv_id", "section"], _section_costs, f"{key}, costs array<long>")
    exits = _grouped(costs, ["conv_id"], _chained_costs, f"{key}, after array<long>, last boolean")
    exits = written(exits, "conversation-costs")
    left = _grouped(_with(pieces, exits), ["conv_id", "section"], _section_exits, f"{key}, states array<long>")
    entries = _grouped(_with(left, exits), ["conv_id"], _chained_states,
                       f"{key}, after array<long>, last boolean, entry long")
    entries = written(entries, "conversation-states")
    return _grouped(_with(dealt, entries, "left"), ["section"], _section_edits,
                    "conv_id long, turn long, role string, digest string, n long, fault string, before string, edit string, "
                    "to string, behind string")


def _with(sections: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """The facts of each (conversation, section), at most two a section, beside its rows."""
    f = facts.withColumnsRenamed({"conv_id": "_conv", "section": "_section"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("section") == F.col("_section"))
    return sections.join(F.broadcast(f), same, how).drop("_conv", "_section")


REPORT = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                    ("repaired_sha256", pa.string())])


class _Conversation:
    """What is known of a conversation whose rows come in order."""

    def __init__(self, conv_id: int | None):
        self.id, self.turns, self.seen, self.last_initial = conv_id, [], 0, None
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.audit: list[str] = []
        self.sha, self.any = hashlib.sha256(), False

    def write(self, role: str, text: str) -> None:
        self.sha.update(("\n" * self.any + f"{role}:{text}").encode())
        self.any = True

    def row(self, r: dict, text: str) -> None:
        turn, n, fault, initial = r["turn"], r["n"], r["fault"], r["role"][:1]
        if turn is not None:
            if not self.turns or self.turns[1] != turn:
                self.seen += 1
            self.turns = [self.turns[0] if self.turns else turn, turn]
        if fault != "whole":
            self.count[fault] += 1
        self.count["blank" if fault == "blank" else "duplicate"] += n - 1
        if self.last_initial is not None:
            self.count["illegal"] += self.last_initial + initial not in LEGAL
        self.count["illegal"] += n - 1
        self.last_initial = initial
        edit, more = r["edit"], TRUNCATED * (fault == "truncated")
        self.audit.append("I" * len(r["before"]) + edit + "D" * (n - 1) + "I" * len(r["behind"]))
        self.count["cost"] += (INSERT * (len(r["before"]) + len(r["behind"])) + DELETE * (n - 1)
                               + {"D": DELETE, "K": KEEP + more, "R": REROLE + more}[edit])
        for x in r["before"]:
            self.write(ROLES[x], "")
        if edit != "D":
            self.write(ROLES[r["to"]] if edit == "R" else r["role"], text)
        for x in r["behind"]:
            self.write(ROLES[x], "")

    def done(self) -> dict:
        gaps = self.turns[1] - self.turns[0] + 1 - self.seen if self.turns else 0
        return {"conv_id": self.id, "gaps": gaps, **self.count, "audit": "".join(self.audit),
                "repaired_sha256": self.sha.hexdigest()}


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, row, out = None, None, []
    for batch in batches:
        for r in batch.to_pylist():
            if now is None or r["conv_id"] != now.id:
                if now:
                    out.append(now.done())
                now = _Conversation(r["conv_id"])
            if r["edit"] is not None:
                row = r  # its edit comes before its texts, of which the first counts
            elif row is not None:
                now.row(row, r["text"])
                row = None
        yield pa.RecordBatch.from_pylist(out, REPORT)
        out = []
    if now:
        yield pa.RecordBatch.from_pylist([now.done()], REPORT)


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 of every conversation that has rows."""
    rows = clean(conversations)
    made = edits(rows)
    columns = ["conv_id", *ORDER, "n", "fault", "before", "edit", "to", "behind", "text"]
    texts = rows.select("conv_id", *ORDER, "text")
    both = made.unionByName(texts, allowMissingColumns=True).select(*columns)
    return (both.repartition("conv_id")
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest",
                                  F.col("edit").asc_nulls_last())
            .mapInArrow(_report, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                 "cost long, audit string, repaired_sha256 string"))
