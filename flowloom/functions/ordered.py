"""Ordered operators that never need a whole key inside one task.

Spark's window functions put every row of a partition key into one task.  Here a key is
cut into blocks of its order first.  Each operator works inside ``key + block`` and adds
what earlier blocks contribute, which is computed from one small row per block.  Those
block rows are cut once more into groups of ``FAN`` blocks, so even the rows that are
summarised stay spread when a single key holds most of a long history.

A block column must not decrease along the order: it is usually a time window, or one of
the finer slices :func:`split_hot_groups` makes of crowded windows and of crowded instants.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from flowloom.functions.scalar import idiv, size_ns, window_id
from flowloom.functions.sized import keep

#: Blocks per group of blocks.
FAN = 4096
#: Slices a crowded window may be cut into.
MAX_SLICES = 65_536
#: Parts the crowded instants of one slice may be cut into.
MAX_PARTS = 1024
#: Blocks per window of the block columns finer than a window.
PER_WINDOW = {"slice_id": MAX_SLICES, "part_id": MAX_SLICES * MAX_PARTS}


def _spec(keys: Sequence[str], order: Sequence[str], frame_end: int) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)


def _with_group(df: DataFrame, keys: Sequence[str], block: str) -> DataFrame:
    """Add the group of blocks a row lies in.

    Per-block rows are used twice.  Grouping by ``_group`` as well and naming the null checks
    that the joins imply makes both uses equal below the exchange, so Spark runs it once.
    """
    # Slice and part ids pack their window, so groups are counted in windows for all.
    grouped = df.withColumn("_group", idiv(block, FAN * PER_WINDOW.get(block, 1)))
    return grouped.filter(functools.reduce(operator.and_, [F.col(c).isNotNull() for c in (*keys, "_group", block)]))


def last_before(
    df: DataFrame,
    keys: Sequence[str],
    block: str,
    order: Sequence[str],
    values: dict[str, Column],
    inclusive: bool = False,
) -> DataFrame:
    """Add, per name in ``values``, its last non-null value on earlier rows of the key.

    ``inclusive`` lets a row see its own value.  ``order`` names ascending columns; negate
    time to look forward.
    """
    tails = (
        _with_group(df, keys, block)
        .select(*keys, "_group", block, F.struct(*order).alias("_pos"), *[v.alias(n) for n, v in values.items()])
        .groupBy(*keys, "_group", block)
        .agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_pos"))).alias(n) for n in values])
    )
    return _add_last(df, keys, block, order, values, inclusive, _carry(tails, keys, block, list(values)))


def _add_last(df, keys, block, order, values, inclusive, carried) -> DataFrame:
    here = _spec([*keys, block], order, 0 if inclusive else -1)
    local = df.select("*", *[F.last(v, ignorenulls=True).over(here).alias(f"_in_{n}") for n, v in values.items()])
    renamed = carried.select(*keys, block, *[F.col(n).alias(f"_up_{n}") for n in values])
    out = local.join(renamed, [*keys, block], "left")
    return out.select(*df.columns, *[F.coalesce(f"_in_{n}", f"_up_{n}").alias(n) for n in values])


def remembered(
    df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], ttl: int, lines: Sequence[tuple[Column, dict[str, Column]]]
) -> DataFrame:
    """Add, per named value, its last non-null on rows of its line up to and including the row itself.

    A line is the rows of a key that meet a condition.  What it taught is forgotten where it had no row for longer
    than ``ttl``, counted in the first column of ``order``.  Rows are sorted and stored once; the last row of a block
    tells what the block leaves to later ones, so what is carried comes from one short row per block.
    """
    ts, pos = F.col(order[0]), F.struct(*order)
    before, here = _spec([*keys, block], order, -1), _spec([*keys, block], order, 0)
    numbered = list(enumerate(lines))
    mark = lambda name, d: f"_{name}{d}"
    last = lambda value: F.last(value, ignorenulls=True)
    cuts, inside = {}, {}
    for d, (mine, values) in numbered:
        pause = ts - last(F.when(mine, ts)).over(before) > ttl
        cuts[mark("start", d)] = F.when(mine & F.coalesce(pause, ts.isNull()), pos)
        inside[mark("start", d)] = last(F.col(mark("start", d))).over(here)
        inside[mark("seen", d)] = last(F.when(mine, ts)).over(here)
        inside[mark("first", d)] = F.first(F.when(mine, pos), ignorenulls=True).over(here)
        for name, value in values.items():
            known = F.when(mine & value.isNotNull(), F.struct(pos.alias("pos"), value.alias("value")))
            inside[f"_in_{name}"] = last(known).over(here)
    ending = F.lead(F.lit(1)).over(Window.partitionBy(*keys, block).orderBy(*order)).isNull()
    stored = keep(df.withColumns(cuts).select(*df.columns, *[c.alias(n) for n, c in inside.items()], ending.alias("_end")))
    ends = keep(_with_group(stored.filter("_end"), keys, block).select(*keys, "_group", block, *inside))

    def start(d: int) -> Column:
        """Where the line last began inside the block: after a pause there, or at its first row after one that reaches back."""
        first, was = F.col(mark("first", d)), F.col(mark("was", d))
        return F.coalesce(mark("start", d), F.when(first.isNotNull() & F.coalesce(first[order[0]] - was > ttl, F.lit(True)), first))

    seen = _carry(ends, keys, block, [mark("seen", d) for d, _ in numbered])
    seen = seen.select(*keys, block, *[F.col(mark("seen", d)).alias(mark("was", d)) for d, _ in numbered])
    ends = keep(ends.join(seen, [*keys, block], "left").withColumns({mark("start", d): start(d) for d, _ in numbered}))
    names = [*[mark("start", d) for d, _ in numbered], *[n for n in inside if n.startswith("_in_")]]
    above = _carry(ends, keys, block, names).select(*keys, block, *[F.col(n).alias(f"_up{n}") for n in names])
    carried = keep(ends.select(*keys, block, *[mark("was", d) for d, _ in numbered]).join(above, [*keys, block]))
    out = stored.join(carried, [*keys, block], "left")
    alive = []
    for d, (_, values) in numbered:
        live = ts - F.coalesce(mark("seen", d), mark("was", d)) <= ttl
        began = F.coalesce(start(d), F.col("_up" + mark("start", d)))
        for name in values:
            known = F.coalesce(f"_in_{name}", f"_up_in_{name}")
            alive.append(F.when(live & (known["pos"] >= began), known["value"]).alias(name))
    return out.select(*df.columns, *alive)


def _carry(tails: DataFrame, keys, block: str, names: list[str]) -> DataFrame:
    """Per block: the last non-null value over all earlier blocks of the key."""
    inner = _spec([*keys, "_group"], [block], -1)
    local = tails.select(
        *keys, block, "_group", *[F.last(n, ignorenulls=True).over(inner).alias(f"_l_{n}") for n in names]
    )
    tops = tails.groupBy(*keys, "_group").agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col(block))).alias(n) for n in names]
    )
    outer = _spec(keys, ["_group"], -1)
    above = tops.select(
        *keys, "_group", *[F.last(n, ignorenulls=True).over(outer).alias(f"_t_{n}") for n in names]
    )
    joined = local.join(above, [*keys, "_group"], "left")
    return joined.select(*keys, block, *[F.coalesce(f"_l_{n}", f"_t_{n}").alias(n) for n in names])


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    block: str,
    order: Sequence[str],
    values: dict[str, Column],
    whole: bool = False,
) -> DataFrame:
    """Add cumulative sums over all rows of the key up to and including the current one.

    With ``whole``, also add the sum over all rows of the key as ``<name>_all``.
    """
    grouped = (
        _with_group(df, keys, block)
        .select(*keys, "_group", block, *[v.alias(n) for n, v in values.items()])
        .groupBy(*keys, "_group", block)
        .agg(*[F.sum(n).alias(n) for n in values])
    )
    inner, outer = _spec([*keys, "_group"], [block], -1), _spec(keys, ["_group"], -1)
    local = grouped.select(*keys, block, "_group", *[F.sum(n).over(inner).alias(f"_l_{n}") for n in values])
    above = (
        grouped.groupBy(*keys, "_group")
        .agg(*[F.sum(n).alias(n) for n in values])
        .select(
            *keys,
            "_group",
            *[F.sum(n).over(outer).alias(f"_t_{n}") for n in values],
            *[F.sum(n).over(Window.partitionBy(*keys)).alias(f"{n}_all") for n in values if whole],
        )
    )
    totals = [f"{n}_all" for n in values if whole]
    base = local.join(above, [*keys, "_group"], "left").select(
        *keys,
        block,
        *[(F.coalesce(f"_l_{n}", F.lit(0)) + F.coalesce(f"_t_{n}", F.lit(0))).alias(f"_up_{n}") for n in values],
        *totals,
    )
    here = _spec([*keys, block], order, 0)
    rows = df.select("*", *[F.sum(v).over(here).alias(f"_in_{n}") for n, v in values.items()])
    out = rows.join(base, [*keys, block], "left")
    return out.select(
        *df.columns,
        *[(F.coalesce(f"_in_{n}", F.lit(0)) + F.coalesce(f"_up_{n}", F.lit(0))).alias(n) for n in values],
        *totals,
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], name: str, whole: bool = False
) -> DataFrame:
    """Add the 1-based position of each row inside its key, with ``whole`` also the key's rows."""
    return running_total(df, keys, block, order, {name: F.lit(1).cast("long")}, whole)


def split_hot_groups(
    df: DataFrame,
    keys: Sequence[str],
    size_s: float,
    max_rows: int | None,
    ts: str = "ts_ns",
    tie: str | None = None,
) -> tuple[DataFrame, str]:
    """Add ``window_id``, where it is missing, and name the block column that keeps ordered work small.

    Groups of ``keys + window_id`` with more than ``max_rows`` rows are cut into equal time
    slices, each by its own count.  Counting is one pre-aggregated pass; the crowded groups are stored
    and joined back, by broadcast only where the stored table is small enough for Spark's own limit.
    With no crowded group, or with ``max_rows=None`` for input of proven rate, windows are blocks.
    ``tie`` names the integer column that orders rows of equal time, if nothing else does; with it a
    burst at one instant is cut as well.
    A ``crowded`` column marks the rows of cut groups where there are any.
    """
    ns = size_ns(size_s)
    out = df if "window_id" in df.columns else df.withColumn("window_id", window_id(ts, size_s))
    if max_rows is None:
        return out, "window_id"
    counts = out.groupBy(*keys, "window_id").agg(F.count(F.lit(1)).alias("_n"))
    # Four times as many slices as an even spread would need leaves room for bursts.
    slices = F.least(F.ceil(F.col("_n") * 4 / F.lit(max_rows)), F.lit(MAX_SLICES)).cast("long")
    crowded = keep(counts.filter(F.col("_n") > max_rows).select(*keys, "window_id", slices.alias("_slices")))
    if crowded.isEmpty():
        return out, "window_id"
    out = out.join(crowded, [*keys, "window_id"], "left")
    offset = F.col(ts) - F.col("window_id") * F.lit(ns).cast("long")
    part = idiv(offset * F.coalesce(F.col("_slices"), F.lit(0)), ns)
    out = out.withColumn("slice_id", F.col("window_id") * F.lit(MAX_SLICES).cast("long") + part)
    out = out.withColumn("crowded", F.col("_slices").isNotNull()).drop("_slices")
    return _split_instants(out, keys, max_rows, ts, tie) if tie else (out, "slice_id")


def passed_cuts(cuts: Column, here: Column) -> Column:
    """How many of the sorted ``cuts`` are not beyond ``here``, at most ``MAX_PARTS - 1``; a look-up costs ten comparisons."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(MAX_PARTS.bit_length() - 1))])
    step = lambda n, more: F.when(F.get(cuts, n + more - 1) <= here, n + more).otherwise(n)
    return F.aggregate(steps, F.lit(0), step)


def _split_instants(rows: DataFrame, keys: Sequence[str], max_rows: int, ts: str, tie: str) -> tuple[DataFrame, str]:
    """Cut slices where more than ``max_rows`` rows share one time, at quantiles of ``tie``.

    Counts and quantile sketches merge before they are shuffled.  A cut is a position ``(time, tie)``; the
    part of a row is the number of its slice's cuts up to it, found by halving, so parts follow the order whatever the cuts are.
    """
    at = [*keys, "slice_id", ts]
    counts = rows.filter("crowded").groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
    heavy = keep(counts.filter(F.col("_n") > max_rows))
    if heavy.isEmpty():
        return rows, "slice_id"
    inside = rows.filter("crowded").select(*at, F.col(tie).cast("long").alias("_tie")).join(heavy, at)
    shares = [i / MAX_PARTS for i in range(1, MAX_PARTS)]
    marks = inside.groupBy(*at).agg(F.percentile_approx("_tie", shares, 10_000).alias("_marks"), F.first("_n").alias("_n"))
    # Every so many marks, so that a part holds about half of max_rows.
    step = F.greatest(F.lit(1), F.floor(F.lit(MAX_PARTS * max_rows) / (F.col("_n") * 2))).cast("int")
    chosen = F.filter("_marks", lambda mark, i: F.pmod(i, step) == 0)
    positions = F.transform(chosen, lambda mark: F.struct(F.col(ts).alias("at"), mark.alias("tie")))
    cuts = marks.select(*at, positions.alias("_cuts")).groupBy(*keys, "slice_id")
    cuts = keep(cuts.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_cuts")))).alias("_cuts")))
    here = F.struct(F.col(ts).alias("at"), F.col(tie).cast("long").alias("tie"))
    part = F.when(F.col("_cuts").isNull(), 0).otherwise(passed_cuts(F.col("_cuts"), here))
    out = rows.join(cuts, [*keys, "slice_id"], "left")
    return out.withColumn("part_id", F.col("slice_id") * F.lit(MAX_PARTS).cast("long") + part).drop("_cuts"), "part_id"

