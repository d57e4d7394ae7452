"""Landed issue pages: scan, issue explode, completeness audit.

The reference pulls pages over REST one after another.  Here the pages are already
landed as JSON files, one file per page, ideally under ``.../project=<P>/`` folders so a
project predicate prunes whole directories.  A page file is read whole
(``wholetext``), so a page is one row; ``parse_json`` turns it into a VARIANT once, in the
scan stage, and everything downstream is path extraction on that value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.operators.sequence import DEFAULT_POLICY, SkewPolicy, null_safe_join, running_max_in_order
from issuelens.session import as_table

PAGE_COLUMNS = ["project", "pull", "page_no", "raw", "body"]
ISSUES = "array<struct<id:string,key:string,fields:variant,changelog:variant>>"


def read_pages(spark: SparkSession, path: str, project: str | None = None,
               one_page_per_line: bool = False) -> DataFrame:
    """Landed page files -> (project, page_no, raw, body).

    A page is a whole file (``page-00012.json``), or, with ``one_page_per_line``, one line
    of a JSON-lines file holding many pages (large files split across tasks by line).
    ``page_no`` comes from the page itself (``startAt / maxResults`` for offset pages) or
    from the trailing number of the file name (token pages, one page per file).  The
    project is the ``project=`` directory when the layout is partitioned, else ``project``.
    ``pull`` orders pulls of the same pages: the ``pull=`` directory where there is one (name
    pulls so that they sort), else the file's modification time.
    """
    df = spark.read.text(path) if one_page_per_line else spark.read.text(path, wholetext=True)
    file_col = F.col("_metadata.file_path")
    if "project" in df.columns:
        proj = F.col("project").cast("string")
    else:
        proj = F.coalesce(F.regexp_extract(file_col, r"project=([^/]+)/", 1).cast("string"), F.lit(project))
        proj = F.when(proj == "", F.lit(project)).otherwise(proj)
    # the number in a file's name is a page number only where a file is a page
    file = F.lit("") if one_page_per_line else file_col
    pages = df.select(proj.alias("project"), pull_of(file_col), file.alias("file"), F.col("value").alias("raw"))
    if project is not None:
        pages = pages.where(F.col("project") == F.lit(project))   # P14
    return pages_from_text(pages, "raw")


def pull_of(file_col) -> Column:
    """The pull a page file belongs to, as text that sorts by age."""
    folder = F.regexp_extract(file_col, r"pull=([^/]+)/", 1)
    at = F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(folder != "", folder).otherwise(at).alias("pull")


def pages_from_text(df: DataFrame, text_col: str = "raw", project_col: str = "project",
                    page_col: str | None = None) -> DataFrame:
    """Pages already held as JSON text in a DataFrame -> the page schema.

    A page is parsed once: what is read of it travels in one struct, which the optimiser does not take apart."""
    read = once(F.try_parse_json(F.col(text_col)), lambda body: F.struct(
        F.try_variant_get(body, "$.startAt", "bigint").alias("start"), F.try_variant_get(body, "$.maxResults", "bigint").alias("size"),
        body.alias("body")))
    df = df.withColumn("_page", read)
    start, size = F.col("_page.start"), F.col("_page.size")
    if page_col is not None:
        page_no = F.col(page_col).cast("bigint")
    elif "file" in df.columns:
        page_no = F.coalesce(
            (start / F.nullif(size, F.lit(0))).cast("bigint"),
            F.regexp_extract(F.col("file"), r"(\d+)\D*$", 1).try_cast("bigint"))
    else:
        page_no = (start / F.nullif(size, F.lit(0))).cast("bigint")
    pull = F.col("pull").cast("string") if "pull" in df.columns else F.lit(None).cast("string")
    return df.select(F.col(project_col).cast("string").alias("project"), pull.alias("pull"), page_no.alias("page_no"),
                     F.col(text_col).alias("raw"), F.col("_page.body").alias("body"))


def field_kinds(fields: Column) -> Column:
    """The fields that an issue's ``fields`` VARIANT has a value for: array of (id, kind of value).

    A record or a list is told by a probe that reads no members; only a scalar's schema is worked out.
    """
    found = F.map_entries(F.coalesce(F.try_variant_get(fields, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    scalar = lambda v: F.substring_index(F.substring_index(F.schema_of_variant(v), "(", 1), "_", 1)
    return F.transform(F.filter(found, lambda e: ~F.is_variant_null(e["value"])), lambda e: F.struct(
        e["key"].alias("id"), F.when(F.try_variant_get(e["value"], "$", "struct<>").isNotNull(), F.lit("OBJECT"))
        .when(F.try_variant_get(e["value"], "$", "array<struct<>>").isNotNull(), F.lit("ARRAY")).otherwise(scalar(e["value"])).alias("kind")))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value bound to a lambda variable, so that it is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def list_widths(issues: Column) -> Column:
    """Field id -> the longest list that an issue of the page (an array of ``ISSUES``) has in it; no member of a list is read."""
    def lists(issue: Column) -> Column:
        found = F.map_entries(F.try_variant_get(issue["fields"], "$", "map<string,array<struct<>>>"))
        return F.transform(F.filter(found, lambda e: e["value"].isNotNull()), lambda e: F.struct(e["key"].alias("id"), F.size(e["value"]).alias("size")))

    def widest(sizes: Column) -> Column:
        return once(F.array_distinct(F.transform(sizes, lambda e: e["id"])), lambda ids: F.map_from_arrays(ids, F.transform(
            ids, lambda i: F.array_max(F.transform(F.filter(sizes, lambda e: e["id"] == i), lambda e: e["size"])))))

    found = F.flatten(F.array_compact(F.transform(F.coalesce(issues, F.array().cast(ISSUES)), lists)))
    return once(F.array_distinct(found.cast("array<struct<id:string,size:int>>")), widest)


def explode_issues(pages: DataFrame, keep_names: bool = False) -> DataFrame:
    """N1 pluck ``issues`` + N2 enframe + N4 unnest_wider of the issue record.

    One row per issue: (project, pull, page_no, issue_pos, id, key, fields, changelog).  Empty
    pages produce no rows (the reference's stop test).  No shuffle.

    ``keep_names`` adds what reports look up later, all of it worked out on the page's row: the
    page's ``names`` text (on the page's first issue only, so that it is not copied to every
    issue), ``names_id`` (which dictionary the issue's page has), ``present`` (the fields that the
    issue has a value for, with their kinds) and ``widths`` (the page's longest list per field).
    """
    if "body" not in pages.columns:          # already one row per issue
        return pages
    # One cast takes an issue apart: a cast to VARIANT builds the value anew, so it is done once a member, never for the whole issue.
    issues = F.try_variant_get(F.col("body"), "$.issues", ISSUES)
    base = ["project", "pull", "page_no"]
    members = [F.col(f"issue.{c}").alias(c) for c in ("id", "key", "fields", "changelog")]
    if not keep_names:
        return pages.select(*base, F.posexplode(issues).alias("issue_pos", "issue")).select(*base, "issue_pos", *members)
    names = F.col("names") if "names" in pages.columns else F.get_json_object(F.col("raw"), "$.names")
    # the fields' kinds are worked out issue by issue: a page's row holds the issues once, and nothing about each
    page = once(issues, lambda x: F.struct(x.alias("issues"), list_widths(x).alias("widths")))
    read = pages.select(*base, names.alias("names"), page.alias("page")) \
        .select(*base, "names", F.xxhash64("names").alias("names_id"), "page.widths", F.posexplode("page.issues").alias("issue_pos", "issue")) \
        .select(*base, F.when(F.col("issue_pos") == 0, F.col("names")).alias("names"), F.when(F.col("names").isNotNull(), F.col("names_id")).alias("names_id"),
                "widths", "issue_pos", *members)
    return read.select(*base, "issue_pos", "id", "key", "fields", "changelog", "names", "names_id", field_kinds(F.col("fields")).alias("present"), "widths")


def latest_issue_version(issues: DataFrame) -> DataFrame:
    """When pulls overlap, keep each issue's copy from its latest pull, then page, then position.

    ``max_by`` per issue id is a partial aggregate (a hot id is combined map-side); VARIANT
    values travel inside the struct, never as a grouping key.
    """
    cols = [c for c in issues.columns if c not in ("project", "id")]
    latest = F.max_by(F.struct(*cols), F.struct(F.coalesce("pull", F.lit("")), F.coalesce("page_no", F.lit(-1)), "issue_pos"))
    return issues.groupBy("project", "id").agg(latest.alias("_v")).select("project", "id", "_v.*") \
        .select(*issues.columns)


def page_figures(pages: DataFrame) -> DataFrame:
    """Every page reduced to what the audit needs, in the scan: one parse a page.

    ``begin``/``finish`` is the part of its set that a page covers: the issues
    [startAt, startAt + issues) of a page with an offset, else its page number.
    """
    ids = F.transform(F.coalesce(F.try_variant_get(F.col("body"), "$.issues", "array<variant>"), F.array().cast("array<variant>")),
                      lambda i: F.try_variant_get(i, "$.id", "string"))
    read = pages.select("project", "page_no", F.col("body").isNull().alias("broken"), ids.alias("ids"),
                        F.try_variant_get(F.col("body"), "$.nextPageToken", "string").isNotNull().alias("continued"),
                        F.try_variant_get(F.col("body"), "$.total", "bigint").alias("total"),
                        F.try_variant_get(F.col("body"), "$.startAt", "bigint").alias("offset"))
    n = F.size("ids").cast("bigint")
    return read.select("*", n.alias("n"), F.col("offset").isNotNull().alias("by_offset"), F.coalesce("offset", "page_no").alias("begin"),
                       (F.coalesce("offset", "page_no") + F.when(F.col("offset").isNotNull(), n).otherwise(1)).alias("finish"))


def coverage(figures: DataFrame, first_offset: int = 0, first_page: int = 0, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """What the pages of a set leave out or hold twice: a sweep over their parts in order of their begins.

    A page leaves a hole where it begins after everything before it has ended (the first one: after
    the set's beginning), and overlaps where it begins sooner.  The running maximum of the ends makes
    this right for pages of any size, and is carried over ranges where a project has very many pages.
    """
    parts = figures.where(F.col("begin").isNotNull() & ((F.col("finish") > F.col("begin")) | ~F.col("by_offset")))
    swept = running_max_in_order(parts.select("project", "by_offset", "begin", "finish", "n"), ["project", "by_offset"], ["begin", "finish", "n"],
                                 "finish", "_before", policy)
    before = F.coalesce("_before", F.when(F.col("by_offset"), F.lit(first_offset)).otherwise(F.lit(first_page)))
    hole = F.greatest(F.col("begin") - before, F.lit(0))
    twice = F.when(F.col("_before").isNotNull(), F.greatest(F.least("finish", "_before") - F.col("begin"), F.lit(0)))
    again = F.coalesce(F.col("_before").isNotNull() & (F.col("finish") <= F.col("_before")), F.lit(False))
    zero = F.lit(0).cast("bigint")
    return swept.groupBy("project").agg(
        F.coalesce(F.sum(F.when(~F.col("by_offset"), hole)), zero).alias("missing_pages"),
        F.coalesce(F.sum(F.when(F.col("by_offset"), hole)), zero).alias("_holes"),
        F.coalesce(F.sum(F.when(F.col("by_offset"), twice)), zero).alias("overlapping_issues"),
        F.count_if(again).alias("repeated_pages"),
        F.max(F.when(F.col("by_offset"), F.col("finish"))).alias("_end"))


def page_audit(pages: DataFrame, first_offset: int = 0, first_page: int = 0, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """S2 + A7: completeness of each project's landed page set.

    Per project: pages, non-empty pages, distinct issues, the largest announced ``total``, last
    pages, pages that do not parse, pages that lie wholly in what earlier ones cover, missing pages
    (of sets without offsets; numbered from ``first_page``), missing issues (of sets with
    offsets, from ``first_offset`` to the announced total) and issues that two pages cover.  A last page
    has issues and no continuation token; in a set without any token it is one that reaches the
    announced total.  A set is complete when it has exactly one last page, nothing broken,
    repeated, missing or overlapping, and exactly as many distinct issues as announced.

    Pages are parsed once, into a written table of their figures and issue ids; issues are
    counted from map-side combined ids, and the sweep orders only begins and ends.
    """
    read = as_table(page_figures(pages), "page-figures")
    per_project = read.groupBy("project").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("n") > 0).alias("nonempty_pages"),
        F.max("total").alias("announced_total"),
        F.count_if(F.col("continued")).alias("_tokens"),
        F.count_if(~F.col("continued") & (F.col("n") > 0)).alias("_without_token"),
        F.count_if((F.col("n") > 0) & (F.col("finish") >= F.col("total"))).alias("_at_total"),
        F.count_if(F.col("broken")).alias("broken_pages"))
    issues = read.select("project", F.explode("ids").alias("id")).distinct().groupBy("project").agg(F.count("id").alias("issues"))
    covered = coverage(read, first_offset, first_page, policy)
    both = null_safe_join(null_safe_join(per_project, issues, ["project"]), covered, ["project"])
    zero = F.lit(0).cast("bigint")
    by_token = (F.col("_tokens") > 0) | F.col("announced_total").isNull() | F.col("_end").isNull()
    tail = F.greatest(F.coalesce(F.col("announced_total") - F.col("_end"), zero), zero)
    counted = both.select(
        "project", "pages", "nonempty_pages", F.coalesce("issues", zero).alias("issues"), "announced_total",
        F.when(by_token, F.col("_without_token")).otherwise(F.col("_at_total")).alias("last_pages"), "broken_pages",
        F.coalesce("repeated_pages", zero).alias("repeated_pages"), F.coalesce("missing_pages", zero).alias("missing_pages"),
        (F.coalesce("_holes", zero) + tail).alias("missing_issues"), F.coalesce("overlapping_issues", zero).alias("overlapping_issues"))
    defects = F.col("broken_pages") + F.col("repeated_pages") + F.col("missing_pages") + F.col("missing_issues") + F.col("overlapping_issues")
    return counted.withColumn("complete", (F.col("last_pages") == 1) & (defects == 0)
                              & (F.col("announced_total").isNull() | (F.col("issues") == F.col("announced_total"))))
