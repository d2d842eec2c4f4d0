"""Order-dependent operators inside a group: next value (W4) and bidirectional
fill (W5), safe for groups of any size.

Rows are windowed by (key, chunk).  A key of ordinary size is one chunk, so that
is the plain window of its rows.  A key that holds a large share of the rows is
cut into chunks of about ``hot_rows`` rows that follow the whole window order:
the cuts are rows of that key themselves, so even a key with all its rows in one
second is spread.  The operator runs inside each chunk, a summary of each chunk
(its first value, or its first and last known ones) is carried along the key's
chunks, and rows at a border take what is missing from it.

Cuts come from a thin sample of the keys and order columns alone, chosen by hash,
``PER_CUT`` rows a chunk on average, of which every ``PER_CUT``-th of a key in
order is a cut.  They are a function of the rows, the same on every
re-execution, and any set of cuts gives the same result.  There are at most
``MAX_CUTS`` (evenly thinned beyond that), so the cuts and the summaries, at
most two rows for each, are broadcast.  No job runs while the frame is built,
and without a hot key adaptive execution drops the joins as empty.

Rows whose group key is NULL are not a real group for ``lead`` (a NULL flow id
mixes unrelated people, Q7): they get no next value.  ``order`` lists the order's
columns, ascending with NULLs last; it should tell all rows of a key apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .keys import join_null_safe

HOT_ROWS = 2_000_000           # rows of a chunk, about
PER_CUT = 16                   # sampled rows of a chunk
MAX_CUTS = 100_000


def _sorted(order: Sequence[Column]) -> list[Column]:
    return [c.asc_nulls_last() for c in order]


def _at(order: Sequence[Column]) -> Column:
    """The row's place in the order as one comparable value (NULLs last)."""
    fields = [f for i, c in enumerate(order) for f in (c.isNull().alias(f"n{i}"), c.alias(f"v{i}"))]
    return F.struct(*fields)


def _so_far(group: WindowSpec, order: Sequence[Column], upto: int = Window.currentRow) -> tuple[WindowSpec, WindowSpec]:
    """The rows up to the current one in ``order``, and those up to it in the
    reverse order.  Both frames only grow, so each row is looked at once; a frame
    that ends at the last row is built anew for every row."""
    return tuple(group.orderBy(*by).rowsBetween(Window.unboundedPreceding, upto)
                 for by in (_sorted(order), [c.desc_nulls_first() for c in order]))


def _cuts(df: DataFrame, keys: list[str], order: Sequence[Column], hot_rows: int, max_cuts: int) -> DataFrame:
    """keys, _cuts: the sorted cuts of each hot key."""
    rows = df.select(*keys, _at(order).alias("_at"))
    sampled = rows.where(F.pmod(F.xxhash64(*keys, "_at"), F.lit(max(1, hot_rows // PER_CUT))) == 0)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))
    cuts = sampled.withColumn("_nth", nth).where(F.col("_nth") % PER_CUT == 0).drop("_nth")
    # One row for each ``hot_rows`` rows of the table: thinned to the bound of the broadcast.
    everywhere = Window.partitionBy()
    cuts = cuts.withColumns({"_n": F.count("*").over(everywhere), "_r": F.row_number().over(everywhere.orderBy(*keys, "_at"))})
    cuts = cuts.where(F.col("_r") % F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(max_cuts))) == 0)
    return cuts.groupBy(*keys).agg(F.array_sort(F.collect_list("_at")).alias("_cuts"))


def _chunked(df: DataFrame, keys: list[str], order: Sequence[Column], hot_rows: int, max_cuts: int = MAX_CUTS) -> DataFrame:
    """``df`` with _at, _cuts (NULL unless the key is hot) and _chunk: the
    number of the key's cuts up to the row, by binary search."""
    tagged = join_null_safe(df.withColumn("_at", _at(order)), F.broadcast(_cuts(df, keys, order, hot_rows, max_cuts)), keys, "left")
    middle = "cast((s.lo + s.hi) div 2 as int)"
    search = F.expr(f"""aggregate(sequence(1, {max_cuts.bit_length()}), named_struct('lo', 0, 'hi', size(_cuts)), (s, i) ->
        if(s.lo < s.hi, if(_cuts[{middle}] <= _at, named_struct('lo', {middle} + 1, 'hi', s.hi), named_struct('lo', s.lo, 'hi', {middle})), s),
        s -> s.lo)""")
    return tagged.withColumn("_chunk", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(search))


def lead_within(df: DataFrame, key: str, order: Sequence[Column], value: str, out: str,
                keep: Column | None = None, *, hot_rows: int = HOT_ROWS, max_cuts: int = MAX_CUTS) -> DataFrame:
    """``out`` = ``value`` of the next row of the same ``key`` in ``order``;
    NULL for the last row and for rows with a NULL key.  ``keep`` filters the
    rows returned (after the next value is known)."""
    cols = df.columns
    rows = _chunked(df.where(F.col(key).isNotNull()), [key], order, hot_rows, max_cuts)
    w = Window.partitionBy(key, "_chunk").orderBy(*_sorted(order))
    led = rows.withColumns({"_lead": F.lead(value).over(w), "_last": F.lead(F.lit(1)).over(w).isNull()})
    # Of each chunk of a hot key its first value, and that of the chunk after it.
    firsts = rows.where(F.col("_cuts").isNotNull()).groupBy(key, "_chunk").agg(
        F.min_by(F.struct(F.col(value).alias("v")), "_at").alias("_first"))
    nexts = firsts.withColumn("_next", F.lead("_first").over(Window.partitionBy(key).orderBy("_chunk"))).drop("_first")
    led = join_null_safe(led, F.broadcast(nexts), [key, "_chunk"], "left")
    led = led.withColumn(out, F.when(F.col("_last"), F.col("_next.v")).otherwise(F.col("_lead")))
    without = df.where(F.col(key).isNull()).withColumn(out, F.lit(None).cast(df.schema[value].dataType))
    if keep is not None:
        led, without = led.where(keep), without.where(keep)
    return led.select(*cols, out).unionByName(without)


def fill_updown(df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: Sequence[str], *,
                hot_rows: int = HOT_ROWS, max_cuts: int = MAX_CUTS) -> DataFrame:
    """tidyr ``fill(.direction = "updown")``: a NULL takes the next non-NULL
    value of its group (in ``order``), else the previous one.  NULL keys form a
    group, as in R's ``group_by``."""
    keys, names = list(keys), df.columns
    rows = _chunked(df, keys, order, hot_rows, max_cuts)
    # Rows equal in the order go by their values too, so that both directions see one order.
    order = [*order, *map(F.col, cols)]
    before, after = _so_far(Window.partitionBy(*keys, "_chunk"), order)
    local = rows.withColumns({f"_p_{c}": F.last(c, ignorenulls=True).over(before) for c in cols}) \
                .withColumns({f"_n_{c}": F.last(c, ignorenulls=True).over(after) for c in cols})
    # Of each chunk of a hot key the first and last known values, carried along its chunks both ways.
    known = {c: F.when(F.col(c).isNotNull(), _at(order)) for c in cols}
    summary = rows.where(F.col("_cuts").isNotNull()).groupBy(*keys, "_chunk").agg(
        *[F.min_by(c, known[c]).alias(f"_f_{c}") for c in cols], *[F.max_by(c, known[c]).alias(f"_l_{c}") for c in cols])
    earlier, later = _so_far(Window.partitionBy(*keys), [F.col("_chunk")], upto=-1)
    summary = summary.withColumns({f"_pl_{c}": F.last(f"_l_{c}", ignorenulls=True).over(earlier) for c in cols}) \
                     .withColumns({f"_nf_{c}": F.last(f"_f_{c}", ignorenulls=True).over(later) for c in cols})
    summary = summary.select(*keys, "_chunk", *[f"{p}_{c}" for c in cols for p in ("_pl", "_nf")])
    filled = join_null_safe(local, F.broadcast(summary), [*keys, "_chunk"], "left").withColumns({
        c: F.coalesce(c, f"_n_{c}", f"_nf_{c}", f"_p_{c}", f"_pl_{c}") for c in cols})
    return filled.select(*names)
