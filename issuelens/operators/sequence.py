"""Ordered per-group windows that survive a hot group.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of one key to one task.
If one issue (or one dictionary name) holds a third of all rows, that task holds a third
of the data.  These helpers first measure group sizes with a map-side-combined aggregate.
Every group above ``rows_per_task`` is cut into ranges of its whole ordering key (time, then
position), with borders taken from a hashed sample of the group, so that ranges have about
equal *numbers of rows* even where most share one time; each range is its own window
partition.  A tiny per-range summary, windowed over the ranges, carries the value across
range borders (lag) or the running offset (row number).  There are at most rows /
``rows_per_task`` hot groups and ranges.  NULL keys are a group like any other.  With no hot
group the plan is the plain single-exchange window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelens.session import as_table


@dataclass(frozen=True)
class SkewPolicy:
    rows_per_task: int = 4_000_000     # groups above this many rows are split into ranges
    sample_per_range: int = 200        # sampled ordering keys per range, for its borders
    enabled: bool = True


DEFAULT_POLICY = SkewPolicy()

_B = "_range"


def ordering_key(order_cols: Sequence[str]) -> Column:
    """A struct that compares like the ordering (ascending, NULLs last): (is null, value) per column."""
    return F.struct(*[x for c in order_cols for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c))])


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``cols`` where NULL matches NULL; the key columns come from ``left``."""
    renamed = right.select(*[F.col(c).alias(f"__{c}") if c in cols else F.col(c) for c in right.columns])
    condition = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cols])
    return left.join(renamed, condition, how).drop(*[f"__{c}" for c in cols])


def split_groups(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], policy: SkewPolicy) -> DataFrame | None:
    """The hot groups with the borders of their ranges, or None when no group is hot.

    One aggregate job over ``keys`` (partial aggregation, so the shuffle carries one row
    per group per map task) and, only when there are hot groups, a sample of their keys.
    """
    if not policy.enabled:
        return None
    sizes = as_table(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > policy.rows_per_task), "hot")
    if sizes.isEmpty():
        return None
    ranges = F.ceil(F.col("_n") / policy.rows_per_task)
    drawn = F.pmod(F.xxhash64(*order_cols), F.lit(1_000_000)) * F.col("_n") < 1_000_000 * policy.sample_per_range * ranges
    sample = null_safe_join(df, sizes, keys, "inner").where(drawn) \
        .groupBy(*keys).agg(F.array_sort(F.collect_list(ordering_key(order_cols))).alias("_s"), F.first(ranges).alias("_nr"))
    step = F.size("_s") / F.col("_nr")

    def border(i: Column) -> Column:
        return F.col("_s")[F.floor(i * step).cast("int")]

    # ascending, so a border that repeats is equal to the one before
    new = F.filter(F.sequence(F.lit(1).cast("bigint"), F.col("_nr") - 1), lambda i: (i == 1) | (border(i) != border(i - 1)))
    return as_table(sample.select(*keys, F.when(F.col("_nr") > 1, F.transform(new, border)).alias("_borders")), "borders")


def borders_below(borders: Column, key: Column) -> Column:
    """How many of the ascending ``borders`` are at most ``key``: a binary search, so a row of a group with a
    million ranges looks at twenty borders."""
    halvings = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.size(borders) + F.lit(1))).cast("int")))
    start = F.struct(F.lit(0).alias("low"), F.size(borders).alias("high"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        below = F.get(borders, middle) <= key
        return F.when(span["low"] >= span["high"], span) \
            .when(below, F.struct((middle + 1).alias("low"), span["high"].alias("high"))) \
            .otherwise(F.struct(span["low"].alias("low"), middle.alias("high")))

    return F.aggregate(halvings, start, halve, lambda span: span["low"])


NODE = 64            # borders that a row looks through at once


def border_nodes(hot: DataFrame, keys: Sequence[str]) -> list[DataFrame]:
    """The borders of every group as a tree: for each level, from the top, a table (keys, _node, _borders) of at most
    ``NODE`` borders a row, every ``NODE ** k``-th one at k levels above the lowest."""
    most = hot.agg(F.max(F.size("_borders"))).first()[0] or 0
    depth = 1
    while NODE ** depth < most:
        depth += 1
    levels = []
    for level in range(depth):
        step = NODE ** (depth - 1 - level)
        taken = F.floor(F.size("_borders") / step).cast("int")            # borders of the group that are on this level
        last = F.greatest(F.ceil(taken / NODE).cast("int") - 1, F.lit(0))
        nodes = hot.where("_borders is not null").select(*keys, "_borders", taken.alias("_taken"), F.explode(F.sequence(F.lit(0), last)).alias("_node"))
        left = F.least(F.lit(NODE), F.col("_taken") - F.col("_node") * NODE)
        at = F.when(left > 0, F.sequence(F.lit(1), left)).otherwise(F.array().cast("array<int>"))
        levels.append(nodes.select(*keys, "_node", F.transform(
            at, lambda j: F.element_at("_borders", ((F.col("_node") * NODE + j) * step).cast("int"))).alias("_borders")))
    return [as_table(nodes, "border-nodes") for nodes in levels] if depth > 1 else levels


def with_ranges(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], hot: DataFrame) -> DataFrame:
    """Attach ``_range`` (0 for ordinary groups) and ``_hot``; equal ordering keys share a range.

    A row goes down its group's tree of borders, so it meets at most ``NODE`` borders a level, however many ranges
    the group has.  The result is a written table: it is read for the ranges' summaries and for their rows, and what
    ``df`` is made of is not worked out for each.
    """
    ranged = df.withColumn("_order", ordering_key(order_cols))
    for level, nodes in enumerate(border_nodes(hot, keys)):
        found = null_safe_join(ranged, nodes.where("_node = 0").drop("_node"), keys).withColumn("_hot", F.col("_borders").isNotNull()) \
            if level == 0 else null_safe_join(ranged, nodes, [*keys, "_node"])
        above = F.lit(0) if level == 0 else F.col("_node") * NODE
        node = F.when(F.col("_borders").isNull(), above).otherwise(above + borders_below(F.col("_borders"), F.col("_order")))
        ranged = found.withColumn("_node", node.cast("int")).drop("_borders")
    return as_table(ranged.withColumn(_B, F.col("_node").cast("long")).drop("_node", "_order"), "ranged")


def lag_in_order(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value: str,
                 default: Column | str | None, out: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """``lag(value, 1, default) OVER (PARTITION BY keys ORDER BY order_cols)``.

    Ordering is ascending with NULLs last on every column.  ``default`` may be a column
    (the reference uses the ticket's creation time).
    """
    default = F.col(default) if isinstance(default, str) else (default if default is not None else F.lit(None))
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    hot = split_groups(df, keys, order_cols, policy)
    prev_struct = F.struct(F.col(value).alias("v"))
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        prev = F.lag(prev_struct, 1).over(w)
        return df.withColumn(out, F.when(prev.isNull(), default).otherwise(prev["v"]))

    ranged = with_ranges(df, keys, order_cols, hot)
    # Last value of every range of the split groups (one row per range).
    last = (ranged.where("_hot").groupBy(*keys, _B)
            .agg(F.max_by(prev_struct, ordering_key(order_cols)).alias("_last")))
    carry = last.select(*keys, _B, F.lag("_last", 1).over(Window.partitionBy(*keys).orderBy(_B)).alias("_carry"))
    w = Window.partitionBy(*keys, _B).orderBy(*order)
    prev = F.lag(prev_struct, 1).over(w)
    res = (null_safe_join(ranged.withColumn("__in_range", prev), carry, [*keys, _B])
           .withColumn(out, F.when(F.col("__in_range").isNotNull(), F.col("__in_range")["v"])
                       .when(F.col("_carry").isNotNull(), F.col("_carry")["v"])
                       .otherwise(default)))
    return res.drop("__in_range", "_carry", _B, "_hot")


def running_max_in_order(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value: str, out: str,
                         policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """``max(value) OVER (PARTITION BY keys ORDER BY order_cols ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)``
    (ascending, NULLs last); NULL on a group's first row."""
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    hot = split_groups(df, keys, order_cols, policy)
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.max(value).over(w))

    ranged = with_ranges(df, keys, order_cols, hot)
    tops = ranged.where("_hot").groupBy(*keys, _B).agg(F.max(value).alias("_top"))
    earlier = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = tops.select(*keys, _B, F.max("_top").over(earlier).alias("_carry"))
    w = Window.partitionBy(*keys, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    res = null_safe_join(ranged.withColumn("__in_range", F.max(value).over(w)), carry, [*keys, _B])
    return res.withColumn(out, F.greatest("__in_range", "_carry")).drop("__in_range", "_carry", _B, "_hot")


def row_number_in_order(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], out: str,
                        count_out: str | None = None, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """``row_number()`` (and optionally ``count(*)``) over ``PARTITION BY keys ORDER BY order_cols``
    (ascending, NULLs last, as in :func:`lag_in_order`)."""
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    hot = split_groups(df, keys, order_cols, policy)
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        res = df.withColumn(out, F.row_number().over(w))
        if count_out:
            res = res.withColumn(count_out, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        return res

    ranged = with_ranges(df, keys, order_cols, hot)
    sizes = ranged.where("_hot").groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("__cnt"))
    wr = Window.partitionBy(*keys).orderBy(_B)
    offsets = sizes.select(
        *keys, _B,
        F.coalesce(F.sum("__cnt").over(wr.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
        F.sum("__cnt").over(Window.partitionBy(*keys)).alias("__tot"))
    w = Window.partitionBy(*keys, _B).orderBy(*order)
    numbered = (ranged.withColumn("__rn", F.row_number().over(w))
                .withColumn("__cnt_local", F.count(F.lit(1)).over(Window.partitionBy(*keys, _B))))
    res = (null_safe_join(numbered, offsets, [*keys, _B])
           .withColumn(out, F.col("__rn") + F.coalesce(F.col("__off"), F.lit(0))))
    if count_out:
        res = res.withColumn(count_out, F.coalesce(F.col("__tot"), F.col("__cnt_local")))
    return res.drop("__rn", "__cnt_local", "__off", "__tot", _B, "_hot")
