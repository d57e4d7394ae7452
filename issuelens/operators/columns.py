"""Schema-level helpers (P1-P7, P13, F16): decided on the driver from ``df.schema``; the data
work they imply (one projection) runs on the executors."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType, VariantType

from issuelens.operators.names import q

NESTED_TYPES = (ArrayType, MapType, StructType, VariantType)


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P1 ``select(new = old, ...)``; duplicate targets keep their first occurrence."""
    seen, cols = set(), []
    for new, old in mapping.items():
        if new in seen:
            continue
        seen.add(new)
        cols.append(q(old).alias(new))
    return df.select(*cols)


def drop_nested(df: DataFrame) -> DataFrame:
    """P3 ``select(-where(is.list))``: drop array, map, struct and VARIANT columns."""
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, NESTED_TYPES)])


def drop_all_null(df: DataFrame) -> DataFrame:
    """P4 ``select_if(~ !all(is.na(.)))``: one aggregate job counts non-NULLs per column."""
    if not df.columns:
        return df
    counts = df.agg(*[F.count(q(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if counts[f"c{i}"] > 0]
    return df.select(*[q(c) for c in keep])


# Fixed value: the suffixes the reference strips from column names.  Longest alternative
# first, because Java regex alternation takes the first match ("_val" would leave "ue").
SUFFIX_PATTERN = "_name|_text|_value|_val"


def rename_regex(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """P5 ``rename_with(~ gsub(pattern, replacement, .))``; collisions are an error."""
    new = [re.sub(pattern, replacement, c) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({n for n in new if new.count(n) > 1})
        raise ValueError(f"renaming makes duplicate columns: {dup}")
    return df.toDF(*new)


def matching(df: DataFrame, starts_with: str | None = None, ends_with: str | None = None,
             regex: str | None = None, exclude: Callable[[str], bool] | None = None) -> list[str]:
    """P6 tidyselect: ``starts_with`` (case-insensitive), ``ends_with``, ``matches``, ``!``."""
    out = []
    for c in df.columns:
        if starts_with is not None and not c.lower().startswith(starts_with.lower()):
            continue
        if ends_with is not None and not c.lower().endswith(ends_with.lower()):
            continue
        if regex is not None and not re.search(regex, c):
            continue
        if exclude is not None and exclude(c):
            continue
        out.append(c)
    return out


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """P6 ``first:last`` by position, from right to left where ``last`` comes first."""
    i, j = df.columns.index(first), df.columns.index(last)
    return df.columns[i:j + 1] if i <= j else df.columns[j:i + 1][::-1]


def mutate_after(df: DataFrame, name: str, expr: Column, after: str, consumed: Sequence[str] = ()) -> DataFrame:
    """P7 ``mutate(name = expr, .after = after, .keep = "unused")``."""
    cols = []
    for c in df.columns:
        if c in consumed and c != after:
            continue
        if c == name:
            continue
        if not (c in consumed and c == after):
            cols.append(q(c))
        if c == after:
            cols.append(expr.alias(name))
    return df.select(*cols)


def across(df: DataFrame, fn: Callable[[Column], Column], cols: Sequence[str] | None = None,
           of_type: type | None = None) -> DataFrame:
    """P13 ``mutate(across(...))``: one expression over listed columns or columns of a type."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if of_type is None or isinstance(f.dataType, of_type)]
    return df.withColumns({c: fn(q(c)) for c in cols}) if cols else df


def string_columns(df: DataFrame) -> list[str]:
    """F16 ``where(is.character)``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
