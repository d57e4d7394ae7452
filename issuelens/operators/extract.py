"""Safe extraction from nested cells (N9 safe hoist, N10 safe hoist all, N11, A5, N5).

All of it is column expressions over a VARIANT column: no per-row Python, no collect.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from issuelens.functions.paths import Step, as_steps, variant_path
from issuelens.operators.names import q
from issuelens.sources.pages import once

PathSpec = Step | Sequence[Step] | tuple  # ("a", 1) or (("a", 1), "double")


def _split_spec(spec) -> tuple[tuple[Step, ...], str]:
    if isinstance(spec, tuple) and len(spec) == 2 and isinstance(spec[1], str) and not isinstance(spec[0], (str, int)):
        return as_steps(spec[0]), spec[1]
    return as_steps(spec), "string"


def _place(df: DataFrame, anchor: str, new_cols: dict[str, Column], after: bool) -> DataFrame:
    """Add ``new_cols`` next to ``anchor``; a name that already exists is replaced in place."""
    existing = [c for c in df.columns]
    out: list[Column] = []
    pending = {k: v for k, v in new_cols.items() if k not in existing}
    for c in existing:
        if c == anchor and not after:
            out.extend(v.alias(k) for k, v in pending.items())
        out.append(new_cols[c].alias(c) if c in new_cols else q(c))
        if c == anchor and after:
            out.extend(v.alias(k) for k, v in pending.items())
    return df.select(*out)


def hoist(df: DataFrame, col: str, outputs: Mapping[str, PathSpec], remove: bool = False) -> DataFrame:
    """``safe_hoist(df, col, new = path, ...)``.

    ``outputs`` maps a new column name to a path (or ``(path, type)``).  When ``col`` is a
    VARIANT every output is a typed path lookup; when it is a plain scalar column (the
    reference's "not a list" case) every output is NULL, including one that overwrites
    ``col`` itself.  New columns go before ``col``; ``remove`` drops ``col`` afterwards.
    """
    field = df.schema[col]
    is_variant = isinstance(field.dataType, VariantType)
    new_cols: dict[str, Column] = {}
    for name, spec in outputs.items():
        steps, dtype = _split_spec(spec)
        if is_variant:
            new_cols[name] = F.try_variant_get(q(col), variant_path(steps), dtype)
        else:
            new_cols[name] = F.lit(None).cast(dtype)
    out = _place(df, col, new_cols, after=False)
    if remove and col not in outputs:
        out = out.drop(col)
    return out


def _is_list(e: Column) -> Column:
    """R's ``is.list`` on a VARIANT value: an object or an array.

    Objects are probed by a cast to the empty struct, which reads no members."""
    return F.try_variant_get(e, "$", "struct<>").isNotNull() \
        | F.try_variant_get(e, "$", "array<variant>").isNotNull()


_SEP = "\u0001"


def hoist_all_expr(v: Column, path: Sequence[Step], sep: str = ";") -> Column:
    """Column form of ``safe_hoist_all``: every element's ``path[-1]`` joined by ``sep``.

    NULL when the cell is not a list, an intermediate step is out of range or absent,
    any element of the final list is not a record, an element holds a nested value under
    the name, or no element has a value.  Logical values print as ``TRUE``/``FALSE``.
    Two element passes (extract, then format); the checks run on the resulting arrays.
    """
    steps = as_steps(path)
    if not steps or not isinstance(steps[-1], str):
        return F.lit(None).cast("string")
    *lead, leaf = steps
    cur = F.try_variant_get(v, variant_path(lead), "variant") if lead else v
    as_array = F.try_variant_get(cur, "$", "array<variant>")
    as_object = F.map_values(F.try_variant_get(cur, "$", "map<string,variant>"))
    leaf_path = variant_path((leaf,))
    # Per element: is it a record, the value's JSON form (tells a logical from text and a
    # nested value from a scalar), and the value as text.
    cells = F.transform(F.coalesce(as_array, as_object), lambda e: F.struct(
        (~_is_list(e)).alias("bad"),
        F.to_json(F.try_variant_get(e, leaf_path, "variant")).alias("j"),
        F.try_variant_get(e, leaf_path, "string").alias("s")))

    def joined(cells: Column) -> Column:
        nested = F.array_join(cells["j"], _SEP).rlike("(^|" + _SEP + ")[\\[{]")
        ok = (F.size(cells) > 0) & ~F.coalesce(F.array_contains(cells["bad"], True), F.lit(False)) & ~nested
        text = F.array_compact(F.transform(
            cells, lambda c: F.when(c["j"].isin("true", "false"), F.upper(c["j"])).otherwise(c["s"])))
        return F.when(ok, once(text, lambda t: F.when(F.size(t) > 0, F.array_join(t, sep))))

    return once(cells, joined)


def hoist_all(df: DataFrame, col: str, path: Sequence[Step], sep: str = ";", remove: bool = False,
              name: str | None = None) -> DataFrame:
    """``safe_hoist_all(df, col, path, sep, .remove)``: new column ``<col>_<path>`` after ``col``."""
    steps = as_steps(path)
    name = name or f"{col}_" + "_".join(str(s) for s in steps)
    field = df.schema[col]
    if isinstance(field.dataType, VariantType):
        expr = hoist_all_expr(q(col), steps, sep)
    else:
        expr = F.lit(None).cast("string")
    out = _place(df, col, {name: expr}, after=True)
    if remove and name != col:
        out = out.drop(col)
    return out


def list_size(v: Column) -> Column:
    """Elements of a VARIANT list; 0 for anything else."""
    return F.coalesce(F.array_size(F.try_variant_get(v, "$", "array<variant>")), F.lit(0))


def page_width(issues: Column, path: Sequence[Step]) -> Column:
    """N5 over a page: the longest list that an issue of the page (an array of VARIANT) has at ``path``.

    Worked out inside the page's own array, before its issues are exploded, so it costs no exchange.
    """
    at = variant_path(as_steps(path))
    return F.coalesce(F.array_max(F.transform(issues, lambda i: list_size(F.try_variant_get(i, at, "variant")))), F.lit(0))


def collapse_strict(v: Column, leaf: str, sep: str = ";", width: Column | int | None = None) -> Column:
    """A5 row-wise collapse that is NA-contagious: NULL if any slot lacks ``leaf``.

    The slots are the numbered columns of the issue's page: ``width`` many, as many as the page's longest
    list has (``page_width``), so a shorter, empty or missing list gives NULL too; on a page where no
    issue has an element there are no slots and the result is empty text.  Without ``width`` an issue's
    slots are its own elements.
    """
    elems = F.try_variant_get(v, "$", "array<variant>")
    vals = F.transform(elems, lambda e: F.try_variant_get(e, variant_path((leaf,)), "string"))

    def joined(vals: Column) -> Column:
        return F.when(~F.exists(vals, lambda x: x.isNull()), F.array_join(vals, sep))

    if width is None:
        return once(vals, joined)
    slots = width if isinstance(width, Column) else F.lit(width)
    return once(vals, lambda x: F.when(slots == 0, F.lit(""))
                .when(F.size(F.coalesce(x, F.array().cast("array<string>"))) == slots, joined(x)))


# A list is widened into columns up to this length; a longer one belongs in rows.
MAX_NUMBERED = 5_000


def numbered_columns(df: DataFrame, col: str, leaf: str, prefix: str, width: int | None = None) -> list[Column]:
    """N5 ``unnest_wider(names_sep = "_")``: ``prefix_1_leaf`` ... as wide as the longest list of the data.

    The width is one aggregate over the list sizes (map-side combined) unless it is given; a
    given width that an element would not fit in is an error, never a dropped element.
    """
    v = q(col)
    size = list_size(v)
    if width is None:
        width = df.agg(F.max(size)).first()[0] or 0
        if width > MAX_NUMBERED:
            raise ValueError(f"a list of {width} elements is too long for columns")
    else:
        v = F.when(size <= width, v).otherwise(F.raise_error(F.concat(F.lit(f"{col}: more than {width} elements: "), size.cast("string"))).cast("variant")) \
            if width else v
    return [F.try_variant_get(v, f"$[{i}]" + variant_path((leaf,))[1:], "string").alias(f"{prefix}_{i + 1}_{leaf}")
            for i in range(width)]


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add each missing column as a typed NULL (``Parent`` is sometimes absent)."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df
