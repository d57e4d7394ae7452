"""Column names that come from data or from two tables: every value gets a name of its own.

Spark tells names apart without regard to case and cannot address an empty one; statuses,
options and field names know no such rules.  A column's *label* is its exact text (in the column's
metadata where it differs from the name), its *name* is what Spark addresses.  ``distinct_names``
gives every label a name, no two alike; ``column_named`` finds a column by its exact label;
``by_place`` renames all columns by their place, so that a table whose names clash can be worked on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

LABEL = "label"
NO_NAME = "(empty)"


def q(name: str) -> Column:
    """A column by its exact name (spaces, dots, back-ticks, ``/``, ``?``, ``#``, ``Σ`` allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def label_of(field: StructField) -> str:
    """The exact text a column stands for: its label, else its name."""
    return (field.metadata or {}).get(LABEL, field.name)


def labels(df: DataFrame) -> list[str]:
    return [label_of(f) for f in df.schema.fields]


def distinct_names(found: Sequence[str], taken: Sequence[str] = ()) -> list[str]:
    """A name for each text of ``found`` (in order): the text itself unless it is empty or, but for case, in
    use (by ``taken`` or by another text), then with ``.2``, ``.3``, ... behind it."""
    used = {t.lower() for t in taken}
    out: list[str | None] = []
    for text in found:
        free = text != "" and text.lower() not in used
        out.append(text if free else None)
        if free:
            used.add(text.lower())
    for i, text in enumerate(found):         # texts that keep their own name come first
        if out[i] is not None:
            continue
        name, n = text or NO_NAME, 1
        while name.lower() in used:
            n += 1
            name = f"{text or NO_NAME}.{n}"
        out[i] = name
        used.add(name.lower())
    return out


def named(column: Column, name: str, label: str) -> Column:
    """``column`` under ``name``, with its label where that differs."""
    return column.alias(name) if name == label else column.alias(name, metadata={LABEL: label})


def by_place(df: DataFrame, prefix: str = "c") -> DataFrame:
    """The columns called ``prefix0``, ``prefix1``, ... by their place."""
    return df.toDF(*[f"{prefix}{i}" for i in range(len(df.columns))])


def column_named(df: DataFrame, label: str) -> str:
    """The name of the column with exactly this label; an error when there is none or more than one."""
    found = [f.name for f in df.schema.fields if label_of(f) == label]
    if len(found) != 1:
        raise ValueError(f"{len(found)} columns are called {label!r}")
    return found[0]


def suffixed(left: Sequence[str], right: Sequence[str], suffixes: tuple[str, str] = (".x", ".y")) -> tuple[list[str], list[str]]:
    """The labels of a join's columns: one that both sides have gets its side's suffix, again until it is free."""
    def one_side(mine: Sequence[str], others: Sequence[str], suffix: str) -> list[str]:
        out: list[str] = []
        for label in mine:
            while label in others or label in out:
                label += suffix
            out.append(label)
        return out

    return one_side(left, right, suffixes[0]), one_side(right, left, suffixes[1])


def join_labels(keys: Sequence[str], left: Sequence[str], right: Sequence[str], suffixes: tuple[str, str] = (".x", ".y")) -> tuple[list[str], list[str]]:
    """Labels of a left join's columns: the left table's (its keys unchanged), then those the right one adds to the keys."""
    others, _ = suffixed([c for c in left if c not in keys], right, suffixes)
    _, theirs = suffixed(left, right, suffixes)
    rest = iter(others)
    return [c if c in keys else next(rest) for c in left], theirs
