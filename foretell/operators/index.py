"""Stable row positions and deep pages: global order without a single-task sort.

Rows are cut into ranges of the whole key at bounds from a sample.  The first ``TOP`` bounds are
found in a sample of constant size and are literals of the plan; finer ones are a table, whose
rows hold the bounds between two of the first.  So neither the driver nor the plan holds
anything that grows with the rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foretell.functions.predicates import INDEX
from foretell.plans.workspace import stored

SAMPLES_PER_RANGE = 50
ROWS_PER_RANGE = 5_000_000  # rows that one task sorts, about
TOP = 256  # bounds that the driver and the plan hold
FEW_ROWS = 100_000  # rows that a page may sort


def _sampled(keys: DataFrame, rows: int, wanted: int) -> DataFrame:
    """About ``wanted`` of the rows, or all."""
    return keys if rows <= wanted else keys.sample(min(1.0, wanted / rows), 42)


def _sorted_sample(keys: DataFrame, order: list, rows: int, wanted: int) -> list:
    """About ``wanted`` rows in their order; under a limit (never reached) they are sorted in one pass over the rows."""
    return _sampled(keys, rows, wanted).orderBy(*order).limit(max(4 * wanted, 1000)).collect()


def _top_bounds(keys: DataFrame, order: list, rows: int, ranges: int) -> list:
    """At most ``ranges - 1`` sorted bounds, from a sample whose expected size depends on ``ranges`` alone."""
    sample = _sorted_sample(keys, order, rows, ranges * SAMPLES_PER_RANGE)
    step = max(len(sample) // ranges, 1)
    return list(dict.fromkeys(tuple(r) for r in sample[step::step]))[: ranges - 1]


def _literals(bounds: list, types: list) -> Column:
    rows = [F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(b, types))]) for b in bounds]
    kind = ",".join(f"k{i}:{t.simpleString()}" for i, t in enumerate(types))
    return F.array(*rows) if rows else F.array().cast(f"array<struct<{kind}>>")


def _not_above(bound: Column, key: Column, falling: list) -> Column:
    """Whether a bound stands at or before a key; null stands before all values if it rises, behind them if it falls."""
    if not any(falling):
        return bound <= key
    out = F.lit(True)
    for i in reversed(range(len(falling))):
        b, k = F.struct(bound[f"k{i}"]), F.struct(key[f"k{i}"])  # a struct compares its nulls
        out = (b > k if falling[i] else b < k) | ((b == k) & out)
    return out


def bucket_of(key: Column, bounds: Column, most: int, falling: list = ()) -> Column:
    """How many of the sorted bounds, ``most`` of them at most, are not above the key: binary search."""
    steps, step = [], 1
    while step <= most:
        steps.insert(0, step)
        step *= 2
    if not steps:
        return F.lit(0)

    def walk(at, step):
        inside = at + step <= F.size(bounds)
        return F.when(inside & _not_above(F.get(bounds, at + step - 1), key, list(falling)), at + step).otherwise(at)

    return F.reduce(F.array(*[F.lit(s) for s in steps]), F.lit(0), walk)


def _fine_bounds(keys: DataFrame, coarse: Column, rows: int, ranges: int) -> tuple:
    """``(table, most)``: ``(_coarse, _bounds)``, the finer bounds of each coarse range; and the most of one range."""
    sample = _sampled(keys, rows, ranges * SAMPLES_PER_RANGE)
    step = F.lit(max(1, min(SAMPLES_PER_RANGE, rows // ranges)))
    listed = sample.select(coarse.alias("_coarse"), F.struct(*keys.columns).alias("b")).groupBy("_coarse").agg(
        F.array_sort(F.array_distinct(F.collect_list("b"))).alias("b"))
    table = stored(listed.select("_coarse", F.filter("b", lambda _, i: i % step == step - 1).alias("_bounds")), "range-bounds")
    return table, table.agg(F.coalesce(F.max(F.size("_bounds")), F.lit(0))).first()[0]


def with_index(df: DataFrame, order_by: list, name: str = INDEX, buckets: int | None = None) -> DataFrame:
    """Adds the 0-based position of each row in the ascending order of ``order_by``.

    The order must end in a unique key.  One hot leading value is spread by the keys behind it;
    each range is numbered on its own and shifted by the sizes of the ranges before it.  The
    bounds are fixed, which keeps numbers and shifts consistent when a task is run again.
    """
    spark = df.sparkSession
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    keys = df.select(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    rows = keys.count()
    if rows < SAMPLES_PER_RANGE:
        at = Window.orderBy(*order)
        return df.withColumn(name, F.row_number().over(at) - F.lit(1).cast("long"))
    # ranges follow the number of rows, and are as many as the cluster works on at a time at least
    ranges = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE))
    types = [f.dataType for f in keys.schema.fields]
    top = _top_bounds(keys, keys.columns, rows, min(ranges, TOP))
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    cut = df.withColumn("_coarse", bucket_of(key, _literals(top, types), len(top)))
    parts = ["_coarse"]
    if ranges > TOP:
        table, most = _fine_bounds(keys, bucket_of(F.struct(*keys.columns), _literals(top, types), len(top)), rows, ranges)
        cut = cut.join(table, "_coarse", "left").withColumn("_fine", F.coalesce(bucket_of(key, F.col("_bounds"), most), F.lit(0))).drop("_bounds")
        parts.append("_fine")
    sizes = cut.groupBy(*parts).agg(F.count("*").alias("_rows"))
    within = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
    if ranges <= TOP:
        counts = {r["_coarse"]: r["_rows"] for r in sizes.collect()}  # TOP rows at most
        before = {i: sum(n for j, n in counts.items() if j < i) for i in sorted(counts)}
        shift = F.element_at(F.create_map(*[F.lit(x).cast("long") for item in before.items() for x in item]), F.col("_coarse").cast("long"))
        return cut.withColumn(name, (within + shift - 1).cast("long")).drop(*parts)
    sizes = stored(sizes, "range-sizes")
    whole = sizes.groupBy("_coarse").agg(F.sum("_rows").alias("_all"))
    outer = whole.select("_coarse", (F.sum("_all").over(Window.orderBy("_coarse")) - F.col("_all")).alias("_outer"))  # TOP rows at most
    chain = Window.partitionBy("_coarse").orderBy("_fine")
    shift = sizes.withColumn("_inner", F.sum("_rows").over(chain) - F.col("_rows")).join(F.broadcast(outer), "_coarse").select(
        *parts, (F.col("_inner") + F.col("_outer")).alias("_shift"))
    return (
        cut.withColumn("_at", within)
        .join(shift, parts)
        .withColumn(name, (F.col("_at") + F.col("_shift") - 1).cast("long"))
        .drop(*parts, "_at", "_shift")
    )


def curve_position(df: DataFrame, columns: list, bits: int = 8) -> Column:
    """A place on a space-filling curve: the bits of the columns' ranks in turn, the highest first.

    A rank is the range of the value among ``2 ** bits`` of about equal size, at bounds from a sample; null
    stands before all values.  Rows that are close in any of the columns are close on the curve.
    """
    if len(columns) * bits > 62:
        raise ValueError("too many columns for the bits of a whole number")
    rows = df.count()
    out = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        keys = df.select(F.col(c).alias("k0"))
        bounds = _top_bounds(keys, ["k0"], rows, 1 << bits)
        rank = bucket_of(F.struct(F.col(c).alias("k0")), _literals(bounds, [keys.schema[0].dataType]), len(bounds))
        for bit in range(bits):
            place = bit * len(columns) + len(columns) - 1 - i
            out = out.bitwiseOR(F.shiftleft(F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")), place))
    return out


def _from(bound: tuple, keys: list, types: list, falling: list) -> Column:
    """Whether a key stands at or behind a bound: plain comparisons, as Spark compiles them."""
    out = F.lit(True)
    for i in reversed(range(len(keys))):
        k = keys[i]
        if bound[i] is None:
            behind, same = (F.lit(False) if falling[i] else k.isNotNull()), k.isNull()
        else:
            b = F.lit(bound[i]).cast(types[i])
            behind, same = F.coalesce(k < b if falling[i] else k > b, F.lit(falling[i])), k.eqNullSafe(b)
        out = behind | (same & out)
    return out


def _bounds_around(sample: list, whole: bool, start: float, end: float) -> list:
    """At most two bounds, little before and little behind the ``start`` and ``end`` share of all rows.

    The share of the rows that stand before a value of the sample is off by five standard deviations at most,
    nearly surely; if the sample is ``whole``, not at all.
    """
    off = 0 if whole else 2.5 * len(sample) ** 0.5 + 1
    at = int(start * len(sample) - off)
    lower = tuple(sample[at]) if at > 0 else None
    behind = (tuple(r) for r in sample[max(math.ceil(end * len(sample) + off), 0) :])
    upper = next((r for r in behind if r != (lower or tuple(sample[0]))), None)
    return [b for b in (lower, upper) if b is not None]


def page_ranges(df: DataFrame, keys: list, falling: list, offset: int, limit: int | None, few: int = FEW_ROWS) -> tuple:
    """``(rows, skipped, left)``: ``left`` rows that hold a page, of which ``skipped`` others stand before.

    The rows before, between and behind two bounds are counted, which come from a sample of constant size and
    enclose the page nearly surely; only those that the page lies in are looked at again, until they are ``few``
    rows or little more than the page.
    """
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    order = [F.desc(f"k{i}") if down else F.asc(f"k{i}") for i, down in enumerate(falling)]
    rows = df
    types = [f.dataType for f in df.select(*named).schema.fields]
    skipped, left = 0, df.count()
    end = left if limit is None else min(left, offset + limit)
    while left > max(few, 2 * (end - offset)) and offset < end:
        wanted = TOP * SAMPLES_PER_RANGE
        sample = _sorted_sample(rows.select(*named), order, left, wanted)
        if not sample:
            break
        bounds = _bounds_around(sample, left <= wanted, (offset - skipped) / left, (end - skipped) / left)
        behind = [_from(b, keys, types, falling) for b in bounds]
        at = reduce(lambda x, y: x + y, [b.cast("int") for b in behind], F.lit(0))
        counts = {r[0]: r[1] for r in rows.groupBy(at.alias("at")).agg(F.count("*")).collect()}  # three rows at most
        first = last = start = None
        before = skipped
        for i in sorted(counts):
            if before + counts[i] > offset and first is None:
                first, start = i, before
            if before < end:
                last = i
            before += counts[i]
        kept = sum(n for i, n in counts.items() if first <= i <= last)
        if kept == left:
            break  # a key that many rows share; the order should end in a unique one
        if first:
            rows = rows.where(behind[first - 1])
        if last < len(behind):
            rows = rows.where(~behind[last])
        skipped, left = start, kept
    return rows, skipped, left


def deep_page(df: DataFrame, keys: list, falling: list, offset: int, limit: int | None, few: int = FEW_ROWS) -> DataFrame:
    """The rows at ``offset`` to ``offset + limit`` of an order; only the ranges that the page lies in are sorted."""
    rows, skipped, _ = page_ranges(df, keys, falling, offset, limit, few)
    page = rows.orderBy(*[k.desc() if down else k.asc() for k, down in zip(keys, falling)]).offset(max(offset - skipped, 0))
    return page if limit is None else page.limit(limit)
