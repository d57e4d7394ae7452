"""Field dictionaries: id -> display name, duplicate names numbered.

Every landed page carries a ``names`` object (field id -> display name).  The reference
rebuilds the dictionary for every page and renames that page's columns.  Here the different
``names`` texts of a project are its dictionary's *versions*: each is numbered once, however many
pages have it, and an issue knows the version of its page (``names_id``).  A report resolves its
display names to field ids once; only where the versions of a project disagree does a row look at
its version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelens.functions.paths import variant_path
from issuelens.operators.sequence import DEFAULT_POLICY, SkewPolicy, row_number_in_order
from issuelens.session import small_methods
from issuelens.sources.pages import field_kinds


def dictionary_entries(pages: DataFrame, raw_col: str = "raw", project_col: str = "project",
                       page_col: str = "page_no") -> DataFrame:
    """N2 ``enframe(names)``: (project, pull, page_no, pos, field_id, display) in document order.

    VARIANT objects keep keys sorted, so document order is read from the page text:
    ``from_json`` into a map keeps the order in which the keys were written.
    """
    if "names" in pages.columns:             # issue rows carry their page's names once
        pages = pages.where(F.col("names").isNotNull())
        text = F.col("names")
    else:
        text = F.get_json_object(F.col(raw_col), "$.names")
    names = F.from_json(text, "map<string,string>")
    pull = F.col("pull") if "pull" in pages.columns else F.lit(None).cast("string")
    return pages.select(project_col, pull.alias("pull"), page_col, F.posexplode(names).alias("pos", "field_id", "display"))


def dictionary_versions(pages: DataFrame) -> DataFrame:
    """N2 + N12 per version: (project, names_id, first, last, pos, field_id, display).

    ``first`` and ``last`` are the (pull, page) between which pages have this ``names`` text.  Pages are
    reduced to their texts' hashes map-side, so the shuffle carries one text per version and task.
    """
    if "names" in pages.columns:             # issue rows carry their page's names once
        named = pages.where(F.col("names").isNotNull()).select("project", "pull", "page_no", "names")
    else:
        pull = F.col("pull") if "pull" in pages.columns else F.lit(None).cast("string")
        named = pages.select("project", pull.alias("pull"), "page_no", F.get_json_object("raw", "$.names").alias("names")).where("names is not null")
    at = F.struct(F.coalesce("pull", F.lit("")).alias("pull"), F.coalesce(F.col("page_no"), F.lit(-1)).alias("page_no"))
    versions = named.groupBy("project", F.xxhash64("names").alias("names_id")) \
        .agg(F.min(at).alias("first"), F.max(at).alias("last"), F.first("names").alias("names"))
    return versions.select("project", "names_id", "first", "last",
                           F.posexplode(F.from_json("names", "map<string,string>")).alias("pos", "field_id", "display"))


def field_presence(issues: DataFrame) -> DataFrame:
    """(project, field_id, n, kinds): how many issues have a value for a field, and of what kinds.

    Worked out from ``fields`` row by row, but for rows that were written with their ``present`` column.
    """
    kinds = field_kinds(F.col("fields"))
    present = F.coalesce(F.col("present"), kinds) if "present" in issues.columns else kinds
    each = issues.select("project", F.explode(present).alias("e"))
    return each.groupBy("project", F.col("e.id").alias("field_id")) \
        .agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("e.kind")).alias("kinds"))


def fields_with_values(issues: DataFrame, ids: Sequence[str]) -> set[str]:
    """Those of ``ids`` that ``field_presence`` would list: one aggregate, which looks at these fields alone."""
    def has_value(field: str) -> Column:
        value = F.try_variant_get(F.col("fields"), variant_path((field,)), "variant")
        found = value.isNotNull() & ~F.is_variant_null(value)
        if "present" not in issues.columns:
            return found
        return F.coalesce(F.exists(F.col("present"), lambda e: e["id"] == field), found)

    if not ids:
        return set()
    with small_methods(issues.sparkSession):
        row = issues.agg(*[F.max(has_value(field)) for field in ids]).first()
    return {field for field, found in zip(ids, row) if found}


def project_dictionary(entries: DataFrame, project_col: str = "project", page_col: str = "page_no") -> DataFrame:
    """One entry per (project, field id): the display name and position from its latest page.

    Latest by pull, then page; a missing pull or page number sorts first, and the position
    and name settle ties, so every id keeps a name whatever is missing.
    """
    pull = F.coalesce(F.col("pull"), F.lit("")) if "pull" in entries.columns else F.lit("")
    latest = F.max_by(F.struct("display", "pos"),
                      F.struct(pull, F.coalesce(F.col(page_col), F.lit(-1)), F.col("pos"), F.coalesce(F.col("display"), F.lit(""))))
    return (entries.groupBy(project_col, "field_id")
            .agg(latest.alias("_d"))
            .select(project_col, "field_id", F.col("_d.display").alias("display"), F.col("_d.pos").alias("pos")))


def disambiguate(dictionary: DataFrame, group_cols: Sequence[str] = ("project",), name_col: str = "display",
                 order_col: str = "pos", out: str = "name", policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """A display name used n > 1 times becomes ``Name-1`` ... ``Name-n`` in key order.

    ``row_number`` and ``count(*)`` over (group, name) -- the reference's ``row_number()``
    and ``n()`` -- with hot names split by position range.
    """
    ranked = row_number_in_order(dictionary, [*group_cols, name_col], [order_col], out="_rn",
                                 count_out="_cnt", policy=policy)
    # As R pastes them: a missing name that repeats becomes NA-1, NA-2, ...
    named = F.when(F.col("_cnt") > 1, F.concat(F.coalesce(F.col(name_col), F.lit("NA")), F.lit("-"), F.col("_rn").cast("string"))) \
        .otherwise(F.col(name_col))
    return ranked.withColumn(out, named).drop("_rn", "_cnt")


# Versions of one project that may disagree about a wanted name; more is not a dictionary any more.
MAX_VERSIONS = 5_000


class FieldCatalog:
    """A field dictionary of one or more projects, asked for the names a report wants.

    ``dictionary`` has a row per (project, version, field) with its numbered name, or, without
    ``names_id``, one per (project, field).  ``presence`` (``field_presence``) tells which fields have
    values, and so do the ``issues``, where given, for a few fields in one aggregate.  Only the wanted names reach the driver: at most one row per report column and
    project, and, where a project's versions disagree about a name, one per version.
    """

    def __init__(self, dictionary: DataFrame, name_col: str = "name", id_col: str = "field_id",
                 project_col: str = "project", presence: DataFrame | None = None, issues: DataFrame | None = None):
        version = F.col("names_id") if "names_id" in dictionary.columns else F.lit(None).cast("long")
        last = F.col("last") if "last" in dictionary.columns else F.lit(None).cast("struct<pull:string,page_no:long>")
        self.dictionary = dictionary.select(F.col(project_col).alias("project"), F.col(id_col).alias("id"), F.col(name_col).alias("name"),
                                            version.alias("version"), last.alias("last"))
        self.presence = presence
        self.issues = issues

    def _keyed(self, project: str | None, strip_spaces: bool) -> DataFrame:
        name = F.replace("name", F.lit(" "), F.lit("")) if strip_spaces else F.col("name")
        rows = self.dictionary if project is None else self.dictionary.where(F.col("project") == F.lit(project))
        return rows.withColumn("key", name)

    def sources(self, wanted: Sequence[str], project: str | None = None, strip_spaces: bool = False) -> dict[str, dict[str, list]]:
        """Display name -> {field id: where it is used for this name} (N3 deframe + N13 rename).

        *Where* is a project, or (project, versions) for a field that had the name in these versions of
        the project's dictionary only.  The field that had a name last also stands for it on pages that
        do not know the name: it is the same field before or after it was renamed.  Two fields of
        one page that read alike once spaces are stripped are an error.
        """
        rows = self._keyed(project, strip_spaces).where(F.col("key").isin(list(wanted)))
        found = rows.groupBy("project", "key", "id").agg(F.max("last").alias("last"), F.count(F.lit(1)).alias("n")).collect()
        by_name: dict[tuple, list] = {}
        for r in found:
            by_name.setdefault((r["project"], r["key"]), []).append(r)
        disputed = {k: v for k, v in by_name.items() if len(v) > 1}
        versions: dict[tuple, dict[str, list]] = {}
        if disputed:
            keys = sorted({k for _, k in disputed})
            each = rows.where(F.col("key").isin(keys)).select("project", "key", "id", "version").limit(MAX_VERSIONS * len(keys) + 1).collect()
            if len(each) > MAX_VERSIONS * len(keys):
                raise ValueError(f"more than {MAX_VERSIONS} dictionary versions disagree about {keys}")
            seen: dict[tuple, str] = {}
            for proj, key, fid, version in each:
                if (proj, key) not in disputed:
                    continue
                if seen.setdefault((proj, key, version), fid) != fid:
                    raise ValueError(f"project {proj}: more than one field reads {key!r}")
                versions.setdefault((proj, key), {}).setdefault(fid, []).append(version)
        out: dict[str, dict[str, list]] = {}
        for (proj, key), fields in by_name.items():
            uses = out.setdefault(key, {})
            latest = max(fields, key=lambda r: (tuple(r["last"]) if r["last"] is not None else ("", -1), r["id"]))["id"]
            uses.setdefault(latest, []).append(proj)
            for r in fields:
                if r["id"] != latest:
                    uses.setdefault(r["id"], []).append((proj, sorted(versions[(proj, key)][r["id"]])))
        return out

    def unresolved(self, wanted: Sequence[str], project: str | None = None, strip_spaces: bool = False) -> DataFrame:
        """(project, name): the wanted names that no version of a project's dictionary has."""
        rows = self._keyed(project, strip_spaces)
        asked = rows.select("project").distinct().select("project", F.explode(F.array(*[F.lit(w) for w in wanted]).cast("array<string>")).alias("key"))
        return asked.join(rows.select("project", "key").distinct(), ["project", "key"], "left_anti").select("project", F.col("key").alias("name"))

    def empty_fields(self, ids: Sequence[str], project: str | None = None) -> set[str]:
        """Those of ``ids`` that no issue (of the project) has a value for."""
        if self.issues is not None:
            rows = self.issues if project is None else self.issues.where(F.col("project") == F.lit(project))
            return set(ids) - fields_with_values(rows, sorted(ids))
        if self.presence is None:
            return set()
        rows = self.presence if project is None else self.presence.where(F.col("project") == F.lit(project))
        found = rows.where(F.col("field_id").isin(list(ids))).select("field_id").distinct().collect()
        return set(ids) - {r["field_id"] for r in found}

    def ids(self, wanted: Sequence[str], project: str | None = None, strip_spaces: bool = False) -> dict[str, str]:
        """Display name -> field id; an error where projects or versions use different ids for a name."""
        out = {}
        for key, uses in self.sources(wanted, project, strip_spaces).items():
            if len(uses) > 1:
                raise ValueError(f"{key!r} is a different field in different projects or pages; name the project")
            out[key] = next(iter(uses))
        return out
