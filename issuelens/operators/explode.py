"""Ordered nested -> long helpers.

Spark has no implicit row order, so every explode keeps its 0-based position column
(``posexplode``); later windows order by these positions instead of input order.
Explodes are narrow: they never shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.functions.paths import Step, variant_path
from issuelens.operators.names import q


def unnest_longer(df: DataFrame, col: str, values_to: str | None = None, pos_to: str | None = None,
                  keep_empty: bool = False) -> DataFrame:
    """N6/N2 ``unnest_longer`` of a VARIANT array: one row per element, position kept.

    Rows whose cell is an empty array, JSON null or not an array disappear, as in the
    reference; ``keep_empty`` keeps them with NULL element and position.
    """
    values_to = values_to or col
    pos_to = pos_to or f"{values_to}_pos"
    arr = F.try_variant_get(F.col(col), "$", "array<variant>")
    gen = F.posexplode_outer(arr) if keep_empty else F.posexplode(arr)
    others = [q(c) for c in df.columns if c != col]
    return df.select(*others, gen.alias(pos_to, values_to))


def unnest_keyed(df: DataFrame, col: str, key_to: str = "column", values_to: str = "values",
                 pos_to: str | None = None) -> DataFrame:
    """N7 ``unnest_longer(indices_to = ...)`` of an object: one row per (key, value).

    The object is read as ``map<string, variant>`` and exploded; keys come back sorted,
    which is how VARIANT stores them.
    Rows whose cell is not an object disappear.
    """
    others = [q(c) for c in df.columns if c != col]
    as_map = F.try_variant_get(F.col(col), "$", "map<string,variant>")
    out = df.select(*others, F.posexplode(as_map).alias(pos_to or "_kpos", key_to, values_to))
    return out if pos_to else out.drop("_kpos")


def parallel_unnest(df: DataFrame, cols: Sequence[str], pos_to: str = "pos") -> DataFrame:
    """N8 lock-step ``unnest_longer`` of several arrays: element i of each on row i.

    The shorter arrays are padded with NULL (``arrays_zip``); the row survives as long as
    one array has elements.
    """
    arrays = [F.try_variant_get(F.col(c), "$", "array<variant>").alias(c) for c in cols]
    zipped = F.arrays_zip(*arrays)
    others = [q(c) for c in df.columns if c not in cols]
    out = df.select(*others, F.posexplode(zipped).alias(pos_to, "_z"))
    return out.select(*[q(c) for c in df.columns if c not in cols], pos_to,
                      *[F.col(f"_z.{c}").alias(c) for c in cols])


def keyed_to_record(df: DataFrame, ids: Sequence[str], key_col: str, value_col: str,
                    keys: Sequence[str], order_col: str | None = None) -> DataFrame:
    """R4 + A2 ``pivot_wider(values_fn = list)``: key/value rows back to one row per id.

    Each listed key becomes an array column of its values, in ``order_col`` order.  This is
    a pivot with ``collect_list`` partial aggregation; one cell holds at most the values one
    record carried under that key, so its size is bounded by the source document.
    """
    val = F.struct(F.col(order_col), F.col(value_col)) if order_col else F.col(value_col)
    pivoted = df.groupBy(*ids).pivot(key_col, list(keys)).agg(F.collect_list(val))
    if order_col:
        pivoted = pivoted.withColumns({k: F.transform(F.array_sort(q(k)), lambda s: s[value_col])
                                       for k in keys})
    return pivoted
