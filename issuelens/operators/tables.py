"""Table-level operators: page append, indicator matrices, reshapes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelens.operators.names import by_place, distinct_names, join_labels, labels, named, q


def natural_full_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """J1 ``dplyr::full_join(a, b)`` without ``by``: keys are all shared columns, NULL matches NULL.

    Null-safe equality (``<=>``) on every shared column keeps it an equi-join (planned as a
    sort-merge or hash join, never a nested loop); key columns are coalesced, the others
    come from the side that has them, in ``a``'s column order then ``b``'s new columns.
    Columns are shared when their labels are exactly equal, and are addressed by place.
    """
    mine, theirs = labels(a), labels(b)
    shared = [c for c in mine if c in theirs]
    if not shared:
        raise ValueError("natural join needs at least one shared column")
    left, right = by_place(a, "_a"), by_place(b, "_b")
    at = {c: (F.col(f"_a{mine.index(c)}"), F.col(f"_b{theirs.index(c)}")) for c in shared}
    joined = left.join(right, reduce(and_, [x.eqNullSafe(y) for x, y in at.values()]), "full")
    out = [(c, F.coalesce(*at[c]) if c in shared else F.col(f"_a{i}")) for i, c in enumerate(mine)]
    out += [(c, F.col(f"_b{i}")) for i, c in enumerate(theirs) if c not in shared]
    return joined.select(*[named(x, n, c) for (c, x), n in zip(out, distinct_names([c for c, _ in out]))])


def option_values(long: DataFrame, key: str, pos: str, value: str, blank: str = "Blank",
                  distinct: bool = True) -> DataFrame:
    """F15 + P11 + A3: (key, option) rows for an indicator matrix.

    The first slot of an issue (``pos == 0``) that is missing becomes ``Blank``; other
    missing slots are dropped; duplicates are removed.
    """
    labelled = long.select(F.col(key), F.when(F.col(pos) == 0, F.coalesce(F.col(value), F.lit(blank)))
                           .otherwise(F.col(value)).alias("Value"))
    labelled = labelled.where(F.col("Value").isNotNull())
    return labelled.dropDuplicates([key, "Value"]) if distinct else labelled


# One output column per distinct name: a table wider than this is a modelling error, not a report.
MAX_SPREAD_COLUMNS = 5_000


def vocabulary(rows: DataFrame, name_col: str) -> list:
    """The distinct non-NULL names of a column, sorted: the columns a spread will have."""
    found = rows.select(name_col).where(q(name_col).isNotNull()).distinct().limit(MAX_SPREAD_COLUMNS + 1).collect()
    if len(found) > MAX_SPREAD_COLUMNS:
        raise ValueError(f"{name_col} has more than {MAX_SPREAD_COLUMNS} distinct values, one column each")
    return sorted(r[0] for r in found)


def known_value(value: Column, values: Sequence) -> Column:
    """``value``, or an error for one that ``values`` does not list (NULL passes)."""
    unknown = F.raise_error(F.concat(F.lit("value not listed: "), value.cast("string"))).cast("string")
    return F.when(value.isNull() | value.isin(list(values)), value).otherwise(unknown)


def spread(long: DataFrame, key: str, name_col: str, cell: Column, values: Sequence | None = None,
           fill: float | None = None) -> DataFrame:
    """R2, R3 ``pivot_wider``: one row per key, one column per name, ``cell`` (an aggregate input) summed up by ``max``.

    The columns come from the data (one distinct job over the names) unless ``values`` lists
    them; a name that a given list lacks is an error, never a dropped cell.  Empty cells are
    ``fill``.  One exchange: a conditional aggregate per column.  A column is labelled with its
    value; names that Spark cannot tell apart or address are made distinct (``names``).
    """
    names = list(values) if values is not None else vocabulary(long, name_col)
    name = q(name_col)
    if values is not None:
        long = long.withColumn(name_col, known_value(name, names))
    texts = [str(n) for n in names]
    cells = [named(F.coalesce(F.max(F.when(name == n, cell)), F.lit(fill)), c, text)
             for n, text, c in zip(names, texts, distinct_names(texts, [key]))]
    return long.groupBy(q(key)).agg(*cells) if names else long.select(q(key)).distinct()


def indicator_matrix(options: DataFrame, key: str, values: Sequence[str] | None = None, value_col: str = "Value") -> DataFrame:
    """R2 + J2 + F13: one 0/1 column per option, zero-filled (``pivot_wider`` + ``replace_na(0)``)."""
    return spread(options, key, value_col, F.lit(1.0), values, fill=0.0)


def indicators(values: Column, options: Sequence[str], taken: Sequence[str] = ()) -> list[Column]:
    """The 0/1 columns of an options array that sits in the row: no explode, no exchange.

    ``taken`` are the names of the columns beside them."""
    return [named(F.array_contains(values, F.lit(o)).cast("double"), name, o) for o, name in zip(options, distinct_names(options, taken))]


def row_sum(df: DataFrame, cols: Sequence[str], out: str = "Count") -> DataFrame:
    """A4 ``rowwise() |> sum(c_across(a:b))``: NULL if any input is NULL."""
    return df.withColumn(out, reduce(add, [q(c) for c in cols]))


def unpivot_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], names_to: str = "name",
                 values_to: str = "value") -> DataFrame:
    """R1 ``pivot_longer``: columns -> (name, value) rows; NULL values are kept."""
    typed = df.select(*[q(c) for c in ids], *[q(c).cast("string").alias(c) for c in cols])
    return typed.unpivot([q(c) for c in ids], [q(c) for c in cols], names_to, values_to)


def left_enrich(left: DataFrame, right: DataFrame, on: str | Sequence[str], suffixes: tuple[str, str] = (".x", ".y"),
                na_matches: bool = False) -> DataFrame:
    """J3 ``left_join(by = key)``; the planner picks broadcast (by measured size) or sort-merge.

    A column beside the keys that both tables have is in the result twice, with the suffix of its
    side (again, until the label is free).  Columns are matched by their exact labels and addressed
    by place.  ``na_matches`` lets a missing key match a missing key (an issue has a key always, and
    plain equality reaches the scan as a filter).
    """
    keys = [on] if isinstance(on, str) else list(on)
    mine, theirs = labels(left), labels(right)
    a, b = by_place(left, "_l"), by_place(right, "_r")
    pairs = [(F.col(f"_l{mine.index(k)}"), F.col(f"_r{theirs.index(k)}")) for k in keys]
    joined = a.join(b, reduce(and_, [x.eqNullSafe(y) if na_matches else x == y for x, y in pairs]), "left")
    new_mine, new_theirs = join_labels(keys, mine, [c for c in theirs if c not in keys], suffixes)
    cells = [F.col(f"_l{i}") for i in range(len(mine))] + [F.col(f"_r{i}") for i, c in enumerate(theirs) if c not in keys]
    found = new_mine + new_theirs
    return joined.select(*[named(x, n, c) for x, n, c in zip(cells, distinct_names(found), found)])
