"""Report specifications and builders (Q1-Q11).

A report is declared once as data: output column, source display name (as the project's
field dictionary names it), path inside the field value, type.  ``build_report`` resolves
the display names to field ids through the dictionary (one small driver-side lookup),
then emits one narrow projection of ``try_variant_get`` calls over the exploded issues,
so scan, parse, explode, hoists and derived columns run as one stage with no shuffle.
Fields a project lacks come out as typed NULL columns (the reference's optional-column
guard).  Everything that needs grouping -- time in status, indicator matrices -- is a
separate keyed stage joined back on the issue key.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.functions.paths import Step, variant_path
from issuelens.functions.scalars import (hours_between, millis_to_minutes, nan_if_null, r_date,
                                         r_timestamp, strip_commas, trim_ws)
from issuelens.operators.columns import across, string_columns
from issuelens.operators.extract import collapse_strict, hoist_all_expr
from issuelens.operators.fields import FieldCatalog, dictionary_versions, disambiguate, field_presence
from issuelens.operators.history import days_by_status, now_text
from issuelens.operators.names import distinct_names, join_labels, named, q
from issuelens.operators.sequence import SkewPolicy
from issuelens.operators.tables import indicators, known_value, row_sum, vocabulary
from issuelens.fixtures import landed_once, landed_table
from issuelens.session import as_table, shared_dir, small_methods
from issuelens.sources.pages import explode_issues, latest_issue_version, pages_from_text
from issuelens.sources.sinks import csv_header, read_csv, write_csv
from issuelens.streaming.compact import compact_batch, read_compacted

BUILTIN = {"id", "key"}


@dataclass(frozen=True)
class Col:
    """One output column: ``out`` from field ``source`` at ``path`` typed ``dtype``.

    ``source`` is a display name (matched after the spec's name normalisation), a field
    id written ``id:<field id>`` (immune to display names that shift), or the builtins
    ``id`` / ``key``; ``how="all"`` joins ``path[-1]`` of every element (N10), ``how="strict"`` does
    when the list is as long as the page's longest and nothing is missing (A5);
    ``how="raw"`` keeps the field value as VARIANT (for the change log).
    """
    out: str
    source: str
    path: tuple[Step, ...] = ()
    dtype: str = "string"
    how: str = "one"


@dataclass(frozen=True)
class ReportSpec:
    name: str
    columns: tuple[Col, ...]
    strip_name_spaces: bool = True          # ``rename_with(~ gsub(" ", "", .))`` before select
    derived: tuple[tuple[str, Callable[[], Column]], ...] = field(default_factory=tuple)


# A dictionary version is one page's names, so numbering duplicate names needs no hot-group split.
CATALOG_POLICY = SkewPolicy(enabled=False)


def field_dictionary(pages: DataFrame) -> DataFrame:
    """N12 over every page of every project: (project, names_id, first, last, field_id, display, pos, name)."""
    return disambiguate(dictionary_versions(pages), group_cols=["project", "names_id"], policy=CATALOG_POLICY)


def field_catalog(pages: DataFrame) -> FieldCatalog:
    """The field dictionary of landed pages, written once, and of a bronze table also which fields have values
    (worked out when a report asks for it); reports ask it for their names."""
    bronze = {"present", "widths"} & set(pages.columns)
    return FieldCatalog(as_table(field_dictionary(pages), "fields"), presence=field_presence(pages) if bronze else None, issues=pages if bronze else None)


def _field_value(c: Col, fid: str) -> Column:
    base = variant_path((fid,))
    if c.how == "raw":
        return F.try_variant_get(F.col("fields"), base, "variant")
    if c.how == "all":
        return hoist_all_expr(F.try_variant_get(F.col("fields"), base, "variant"), c.path)
    if c.how == "strict":
        width = F.coalesce(F.try_element_at(F.col("widths"), F.lit(fid)), F.lit(0))
        return collapse_strict(F.try_variant_get(F.col("fields"), base, "variant"), str(c.path[-1]), width=width)
    return F.try_variant_get(F.col("fields"), base + variant_path(c.path)[1:], c.dtype)


def _source_expr(c: Col, uses: dict[str, list]) -> Column:
    """The value of a report column; where projects or pages keep it in different fields, by the row's project
    and the version of its page's dictionary."""
    if c.source in BUILTIN:
        return F.col(c.source).cast(c.dtype) if c.dtype != "string" else F.col(c.source)
    if not uses:
        return F.lit(None).cast(c.dtype if c.how != "raw" else "variant")
    if len(uses) == 1:
        return _field_value(c, next(iter(uses)))
    rules = [(where, fid) for fid, places in sorted(uses.items()) for where in places]
    out = None
    for where, fid in sorted(rules, key=lambda r: not isinstance(r[0], tuple)):      # single versions before whole projects
        if isinstance(where, tuple):
            mine = F.col("project").eqNullSafe(F.lit(where[0])) & F.col("names_id").isin(where[1])
        else:
            mine = F.col("project").eqNullSafe(F.lit(where))
        out = F.when(mine, _field_value(c, fid)) if out is None else out.when(mine, _field_value(c, fid))
    return out


def wanted_names(spec: ReportSpec) -> list[str]:
    return sorted({c.source for c in spec.columns if c.source not in BUILTIN and not c.source.startswith("id:")})


def unresolved_columns(catalog: FieldCatalog, spec: ReportSpec, project: str | None = None) -> DataFrame:
    """(project, name): display names of the report that a project's dictionary never had, so its cells are NULL."""
    return catalog.unresolved(wanted_names(spec), project, spec.strip_name_spaces)


def report_sources(catalog: FieldCatalog, spec: ReportSpec, project: str | None = None) -> dict[str, dict[str, list]]:
    """The fields of a report's columns; finding none of them is an error, not a table of NULLs, and the names
    that are not found are listed in a warning (``unresolved_columns`` lists them by project)."""
    wanted = wanted_names(spec)
    found = catalog.sources(wanted, project=project, strip_spaces=spec.strip_name_spaces)
    if wanted and not found:
        raise ValueError(f"report {spec.name}: none of its fields is in the dictionary" + (f" of project {project}" if project else ""))
    if len(found) < len(wanted):
        warnings.warn(f"report {spec.name}: no field is called {', '.join(sorted(set(wanted) - set(found)))}", stacklevel=3)
    found.update({c.source: {c.source[3:]: []} for c in spec.columns if c.source.startswith("id:")})
    return found


def build_report(issues: DataFrame, catalog: FieldCatalog, spec: ReportSpec, project: str | None = None,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Issues (from :func:`explode_issues`) -> the flat report of ``spec``, of one ``project`` or of all.

    In a table of several projects every row is read through its own project's fields (P14).
    ``keep`` names columns of ``issues`` to pass on beside the report's.
    """
    uses = report_sources(catalog, spec, project)
    if project is not None:
        issues = issues.where(F.col("project") == F.lit(project))
    out = issues.select(*[_source_expr(c, uses.get(c.source, {})).alias(c.out) for c in spec.columns], *keep)
    for name, fn in spec.derived:
        out = out.withColumn(name, fn())
    return out


# --------------------------------------------------------------------------------------
# The report specs.  Display names are the tracker's own field names, as
# the project reports select them (after space stripping where a project strips spaces);
# they must match the landed pages' dictionaries for a report to find its fields.
# --------------------------------------------------------------------------------------
PAR = ReportSpec("PAR", (
    Col("IssueID", "id"), Col("IssueKey", "key"),
    Col("ProjectEffectiveDate", "ProjectEffectiveDate"),
    Col("Created", "Created"), Col("Resolved", "Resolved"), Col("Updated", "Updated"),
    Col("Organization", "Ministry/BPSOrganization", ("value",)),
    Col("RequestType", "RequestType", ("requestType", "name")),
    Col("Status", "Status", ("name",)), Col("StatusCategory", "StatusCategory", ("name",)),
    Col("StatusCategoryChanged", "StatusCategoryChanged"),
    Col("Assignee", "Assignee", ("displayName",)), Col("Reporter", "Reporter", ("displayName",)),
    Col("Resolution", "Resolution", ("name",)), Col("Summary", "Summary"),
))

RBAS = ReportSpec("RBAS", (
    Col("IssueID", "id"), Col("IssueKey", "key"), Col("Created", "Created"), Col("EndDate", "EndDate"),
    Col("RequestedDueDate", "RequestedDueDate", ("value",)), Col("Duedate", "Duedate"),
    Col("Updated", "Updated"), Col("Resolved", "Resolved"), Col("Resolution", "Resolution", ("name",)),
    Col("TimeToResolution", "Timetoresolution", ("ongoingCycle", "elapsedTime", "millis"), "double"),
    Col("ServiceRequested", "ServiceRequested", ("value",)), Col("ProjectType", "ProjectType", ("value",)),
    Col("Organization", "Ministry/BPSOrganization", ("value",)),
    Col("BranchDivision", "Branch/Division", ("value",)), Col("RPDBranch", "RPDBranch", ("value",)),
    Col("MYSCReq", "MYSCReq#"), Col("RequestType", "RequestType", ("requestType", "name")),
    Col("RequestSubtype", "RequestSubtype", ("value",)), Col("Casetype", "Casetype", ("value",)),
    Col("Status", "Status", ("name",)), Col("StatusCategory", "StatusCategory", ("name",)),
    Col("StatusCategoryChanged", "StatusCategoryChanged"), Col("Assignee", "Assignee", ("displayName",)),
    Col("EmployeeID", "EmployeeID"), Col("Reporter", "Reporter", ("displayName",)), Col("Summary", "Summary"),
))

GPOPR = ReportSpec("GPOPR", (
    Col("IssueID", "id"), Col("IssueKey", "key"), Col("Created", "Created"), Col("Updated", "Updated"),
    Col("Duedate", "Duedate"), Col("Priority", "Priority", ("name",)), Col("Status", "Status", ("name",)),
    Col("Assignee", "Assignee", ("displayName",)),
    Col("GPOPackageApprover", "GPOPackageApprover", ("displayName",)),
    Col("GPOSubtype", "GPOSubtype", ("value",)),
    Col("Organization", "Ministry/BPSOrganization", ("value",)), Col("City", "CityDropdown", ("value",)),
    Col("RequestType", "RequestType", ("requestType", "name")),
    Col("RequestParticipants", "Requestparticipants", ("displayName",), how="all"),
    Col("Summary", "Summary"),
))

SBP = ReportSpec("SBP", (
    Col("IssueKey", "key"), Col("IssueType", "Issue Type", ("name",)),
    Col("Address", "Address", ("content", 1, "content", 1, "text")),
    Col("Assignee", "Assignee", ("displayName",)), Col("Created", "Created"),
    Col("RequestedDueDate", "Requested Due Date", ("value",)),
    Col("SpaceBookingAdmin", "Name of Space Booking Admin", ("displayName",)),
    Col("NumberOfSpaces", "Number of Spaces to Onboard"),
    Col("FloorPlan", "Do you have a floor plan?", ("value",)),
    Col("FurniturePlan", "Do you have a furniture plan?", ("value",)),
    Col("LastUpdatedStatus", "Last Updated Status"),
    Col("Department", "Department-1", ("value",)), Col("DueDate", "Due date"),
    Col("Organization", "Ministry/BPS Organization", ("value",)),
    Col("Priority", "Priority", ("name",)), Col("Reporter", "Reporter", ("displayName",)),
    Col("RequestParticipants", "Request participants", ("displayName",), how="all"),
    Col("RequestType", "Request Type", ("requestType", "name")),
    Col("Resolved", "Resolved"), Col("Status", "Status", ("name",)), Col("Summary", "Summary"),
    Col("Updated", "Updated"), Col("Parent", "Parent", ("key",)),
), strip_name_spaces=False)

COM = ReportSpec("COM", (
    Col("IssueKeyNumber", "id"), Col("IssueKey", "key"), Col("Priority_name", "Priority", ("name",)),
    Col("AssigneeName", "Assignee", ("displayName",)), Col("Resolved", "Resolved"),
    Col("Frequency_val", "Frequency", (1, "value")), Col("Initial Target Date", "Initial Target Date"),
    Col("RequestType", "Request Type", ("requestType", "name")), Col("Summary", "Summary"),
    Col("IssueType", "Issue Type", ("name",)), Col("Reporter_val", "Reporter", ("displayName",)),
    Col("CreatorName", "Creator", ("displayName",)), Col("Created", "Created"),
    Col("Description_val", "Description", ("content", 1, "content", 1, "text")),
    Col("RPD_Branch", "RPD Branch", ("value",)), Col("RequireCommsPlan", "Comms Plan Required?", ("value",)),
    Col("CommunicationLead", "Communication Lead", ("displayName",)),
    Col("Communication Topic", "Communication Topic", how="raw"),
    Col("TopicOfCommunication", "Topic of Communication", ("content", 1, "content", 1, "text")),
    Col("Status_val", "Status", ("name",)),
), strip_name_spaces=False)

CSR = ReportSpec("CSR", (
    Col("IssueID", "id"), Col("IssueKey", "key"), Col("Assignee", "Assignee", ("displayName",)),
    Col("Creator", "Creator", ("displayName",)), Col("CSM", "CSM", ("displayName",)),
    Col("CSRIssueSubtype", "CSRIssueSubtype", ("value",)), Col("Reporter", "Reporter", ("displayName",)),
    Col("Organization", "Ministry/BPSOrganization", ("value",)),
    Col("ResponsibleGroup", "ResponsibleGroup", ("value",)),
    Col("ProjectEffectiveDate", "ProjectEffectiveDate"), Col("StatusCategory", "StatusCategory", ("name",)),
    Col("Resolution", "Resolution", ("name",)), Col("Progress", "Progress", ("progress",), "double"),
    Col("IssueType", "IssueType", ("name",)), Col("Project", "Project", ("name",)),
    Col("PIN", "PIN(ARENumber)"), Col("Resolved", "Resolved"), Col("Updated", "Updated"),
    Col("Description", "Description", ("content", 1, "content", 1, "text")),
    Col("RequestType", "RequestType", ("requestType", "name")), Col("Summary", "Summary"),
    Col("StatusCategoryChanged", "StatusCategoryChanged"), Col("Priority", "Priority", ("name",)),
    Col("Status", "Status", ("name",)), Col("TotalProgress", "ΣProgress", ("progress",), "double"),
    Col("Created", "Created"),
))

# --------------------------------------------------------------------------------------
# Report finishing rules per project
# --------------------------------------------------------------------------------------
def finish_par(df: DataFrame) -> DataFrame:
    """Q1: effective date as written, hours to completion (NaN when open), instants."""
    hours = hours_between(r_timestamp(F.col("Resolved")), r_timestamp(F.col("Created")))
    instants = [c for c in ("Resolved", "Created", "Updated", "StatusCategoryChanged") if c in df.columns]
    return (df.withColumn("ProjectEffectiveDate", r_date(F.col("ProjectEffectiveDate")))
            .withColumn("TimeToCompletion", nan_if_null(hours))
            .withColumns({c: r_timestamp(F.col(c)) for c in instants}))


def finish_rbas(df: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Q2: instants, minutes to resolution replacing the millis, excluded test tickets."""
    out = df.withColumns({c: r_timestamp(F.col(c)) for c in ("Created", "Updated", "StatusCategoryChanged")})
    cols = []
    for c in out.columns:
        if c == "TimeToResolution":
            continue
        cols.append(q(c))
        if c == "Resolution":
            cols.append(millis_to_minutes(F.col("TimeToResolution")).alias("MinutesToResolution"))
    out = out.select(*cols)
    if excluded:
        out = out.where(~F.coalesce(F.col("IssueKey").isin(list(excluded)), F.lit(False)))
    return out


def finish_gpopr(df: DataFrame) -> DataFrame:
    """Q3: calendar dates as written."""
    return df.withColumns({c: r_date(F.col(c)) for c in ("Created", "Updated", "Duedate")})


def finish_com(df: DataFrame) -> DataFrame:
    """Q7: dates as written, then the header clean-up: drop still-nested columns (P3),
    strip the ``_name``/``_text``/``_val``/``_value`` suffixes (P5), underscores to spaces."""
    from issuelens.operators.columns import SUFFIX_PATTERN, drop_nested, rename_regex
    out = df.withColumns({c: r_date(q(c)) for c in ("Created", "Initial Target Date", "Resolved")})
    return rename_regex(rename_regex(drop_nested(out), SUFFIX_PATTERN, ""), "_", " ")


def csr_columns(issues: DataFrame, catalog: FieldCatalog, project: str | None = None) -> DataFrame:
    """Q11 (the intent of the unfinished script): the change log and the report's columns, but for
    those whose field no issue has a value for (P4, read off the catalogue's presence table)."""
    uses = report_sources(catalog, CSR, project)
    fields = sorted({fid for use in uses.values() for fid in use})
    empty = catalog.empty_fields(fields, project)
    kept = tuple(c for c in CSR.columns if c.source in BUILTIN or set(uses.get(c.source, {})) - empty)
    return build_report(issues, catalog, replace(CSR, columns=kept), project, keep=["changelog"]).withColumnRenamed("changelog", "Changelog")


def finish_csr(df: DataFrame) -> DataFrame:
    """Q11: dates and instants, where the columns are there."""
    out = df.withColumns({c: r_date(F.col(c)) for c in ("ProjectEffectiveDate",) if c in df.columns})
    return out.withColumns({c: r_timestamp(F.col(c)) for c in ("Resolved", "Created", "Updated", "StatusCategoryChanged") if c in df.columns})


def clean_report_strings(df: DataFrame, flatten: bool = False) -> DataFrame:
    """Q6: delete commas and trim every text column (optionally also inner newlines)."""
    out = across(df, strip_commas, string_columns(df))
    out = across(out, trim_ws, string_columns(out))
    if flatten:
        from issuelens.functions.scalars import flatten_newlines
        out = across(out, flatten_newlines, string_columns(out))
    return out


# --------------------------------------------------------------------------------------
# Change history of the SBP project -> time in status (Q5) -> final report (Q6)
# --------------------------------------------------------------------------------------
def history_items(issues: DataFrame, key_col: str = "key", created_col: str = "Created") -> DataFrame:
    """Changelog -> one row per history item (N6 twice, N9 on each item).

    The reference goes histories -> key/value rows -> list pivot -> parallel unnest -> items;
    reading ``created`` and ``items`` of each history by path gives the same rows without
    the round trip.  Positions keep the document order for equal timestamps.
    """
    histories = F.try_variant_get(F.col("changelog"), "$.histories", "array<variant>")
    h = issues.select(F.col(key_col).alias("IssueKey"), F.col(created_col).alias("TicketCreated"),
                      F.posexplode(histories).alias("history_pos", "history"))
    items = F.try_variant_get(F.col("history"), "$.items", "array<variant>")
    i = h.select("IssueKey", "TicketCreated", "history_pos",
                 F.try_variant_get("history", "$.created", "string").alias("created"),
                 F.posexplode(items).alias("item_pos", "item"))
    return i.select("IssueKey", "TicketCreated", "history_pos", "item_pos", "created",
                    F.try_variant_get("item", "$.field", "string").alias("item_field"),
                    F.try_variant_get("item", "$.fromString", "string").alias("item_fromString"),
                    F.try_variant_get("item", "$.toString", "string").alias("item_toString"))


def sbp_report(pages: DataFrame, as_of: str | None = None, statuses: Sequence[str] | None = None,
               spec: ReportSpec = SBP, catalog: FieldCatalog | None = None, include_open: bool = False,
               project: str | None = None) -> DataFrame:
    """Q4 + Q5 + Q6: issues with one day-count column per status left, strings cleaned.

    An issue's change log sits in its row, so the days are worked out there: no explode, no
    shuffle, no join.  The status columns come from the data (one distinct job over the
    statuses), or from ``statuses``, where an unlisted status is an error.  Pages (with
    ``body``) are first settled into the bronze issue table.
    """
    issues = settle_issues(pages) if "body" in pages.columns else pages
    catalog = catalog or field_catalog(issues)
    as_of = as_of or now_text()
    uses = catalog.sources(["Created"], project, strip_spaces=spec.strip_name_spaces).get("Created") or {"created": []}
    created = r_timestamp(_source_expr(Col("Created", "Created"), uses))
    histories = F.try_variant_get(F.col("changelog"), "$.histories", "array<variant>")
    spent = issues.withColumn("_days", days_by_status(histories, created, as_of, include_open=include_open))
    names = list(statuses) if statuses is not None else vocabulary(
        (spent if project is None else spent.where(F.col("project") == F.lit(project)))
        .select(F.explode(F.map_keys("_days")).alias("status")), "status")
    report = clean_report_strings(build_report(spent, catalog, spec, project, keep=["_days"]))
    days = F.col("_days")
    if statuses is not None:
        days = F.transform_keys(days, lambda k, v: known_value(k, names))
        report = report.withColumn("_days", days)
    # The join on the issue key in the reference: a status called like a report column gets a suffix, and so does the column.
    mine, theirs = join_labels([spec.columns[0].out], [c.out for c in spec.columns], names)
    cells = [q(c.out) for c in spec.columns] + [F.try_element_at(F.col("_days"), F.lit(n)) for n in names]
    found = mine + theirs
    return report.select(*[named(x, n, c) for x, n, c in zip(cells, distinct_names(found), found)])


BRONZE = {"compression": "zstd"}        # VARIANTs repeat their field ids in every issue


def settle_issues(pages: DataFrame, overlapping_pulls: bool = False) -> DataFrame:
    """Parse once: the bronze issue table as Parquet in the shared folder.

    One row per issue with its ``fields`` and ``changelog`` VARIANTs, the page's ``names`` text on each
    page's first issue and its hash on every one (for the dictionary), and the page's list widths;
    which fields have values is read off ``fields`` when a report asks for it.  Every later job reads
    this table, and only the columns it needs: a report without a change history never
    reads the logs, the dictionary only the names.  Lineage is cut, so a lost executor
    reads the table again instead of the pages.
    """
    with small_methods(pages.sparkSession):
        return as_table(bronze_issues(pages, overlapping_pulls), "issues", **BRONZE)


def bronze_issues(pages: DataFrame, overlapping_pulls: bool = False) -> DataFrame:
    """The rows of the bronze table; with ``overlapping_pulls`` each issue's latest copy only.

    A page's names text stays with its first issue.  A copy that a later pull replaces takes
    its names along: the later pull's pages carry names of their own, which the dictionary
    would prefer anyway.
    """
    issues = explode_issues(pages, keep_names=True).drop("present")
    return latest_issue_version(issues) if overlapping_pulls else issues


def write_bronze(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The bronze issue table at a path of its own, as ``settle_issues`` writes it."""
    with small_methods(pages.sparkSession):
        bronze_issues(pages).write.options(**BRONZE).mode(mode).parquet(path)


def read_bronze(spark: SparkSession, path: str, overlapping_pulls: bool = True) -> DataFrame:
    """A bronze table of ``write_bronze`` or the stream: by default each issue's latest copy."""
    rows = spark.read.parquet(path)
    return latest_issue_version(rows) if overlapping_pulls else rows


# --------------------------------------------------------------------------------------
# Registered queries on pages landed from the provided tables
# --------------------------------------------------------------------------------------
AS_OF = "2025-01-01 00:00:00"
def landed_issues(spark: SparkSession, sf: str) -> DataFrame:
    """The bronze issue table of the landed pages, written once by an application: a report reads it, as it
    would read the table that the ingest keeps."""
    return landed_once(spark, "bronze", sf, lambda path: write_bronze(pages_from_text(landed_table(spark, sf), "raw"), path))


def sbp_time_in_status(spark: SparkSession, sf: str) -> DataFrame:
    """Q4-Q6, every column; the status columns come from the data."""
    issues = landed_issues(spark, sf)
    rep = sbp_report(issues, as_of=AS_OF)
    fixed = len(SBP.columns)
    return rep.select(*[q(c) for c in rep.columns[:fixed]], *[F.round(q(c), 6).alias(c) for c in rep.columns[fixed:]])


# What the landed orders look like to a report, in SQL: plain field n is v<n>-<key modulo 50> unless
# the key leaves 0 modulo n + 3.
def _plain(n: int) -> str:
    return f"CASE WHEN o_orderkey % {n + 3} <> 0 THEN 'v{n}-' || CAST(o_orderkey % 50 AS VARCHAR) END"


_BASE_SQL = """
WITH b AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate, o.o_totalprice,
         c.c_name, c.c_mktsegment, n.n_name, least(23, floor(o.o_totalprice / 25000)) AS h,
         CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN NULL ELSE c_name END AS assignee
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""


def _day(days: int, modulus: int) -> str:
    return f"CASE WHEN o_orderkey % {modulus} <> 0 THEN strftime(o_orderdate + INTERVAL {days} DAY, '%Y-%m-%d') END"


def _at(days: int, form: str = "%Y-%m-%d %H:%M:%S", when: str = "true") -> str:
    return f"CASE WHEN {when} THEN strftime(o_orderdate + INTERVAL {days} DAY, '{form}') END"


ISO = "%Y-%m-%dT%H:%M:%S.000+0000"
_REVIEWED = "o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' AND o_orderkey % 4 = 0"
_FINAL, _NOT_P = "o_orderstatus = 'F'", "o_orderstatus <> 'P'"


def _select(columns: dict[str, str]) -> str:
    return "SELECT " + ",\n       ".join(f'{sql} AS "{name}"' for name, sql in columns.items()) + "\nFROM b"


FLAGSHIP_ORACLE = _BASE_SQL + _select({
    "IssueKey": "'ORD-' || CAST(o_orderkey AS VARCHAR)", "IssueType": _plain(8), "Address": _plain(30), "Assignee": "assignee",
    "Created": _at(0, ISO), "RequestedDueDate": _plain(16), "SpaceBookingAdmin": _plain(13), "NumberOfSpaces": _plain(3),
    "FloorPlan": _plain(25), "FurniturePlan": _plain(26), "LastUpdatedStatus": _plain(4), "Department": "n_name",
    "DueDate": _day(8, 5), "Organization": "n_name || ' Branch'", "Priority": "o_orderpriority", "Reporter": _plain(10),
    "RequestParticipants": "c_name || ';' || n_name", "RequestType": "c_mktsegment", "Resolved.x": _at(3, ISO, _FINAL),
    "Status": "o_orderstatus", "Summary": _plain(0), "Updated": _at(4, ISO), "Parent": _plain(33),
    "InReview": f"CASE WHEN {_REVIEWED} THEN 0.0::DOUBLE END", "Resolved.y": f"CASE WHEN {_REVIEWED} THEN 2.0::DOUBLE END",
    "InProgress": "CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus <> 'F' THEN NULL ELSE round(2 - h / 24.0, 6) END",
    "Open": f"""CASE WHEN o_orderpriority = '5-LOW' THEN NULL
            WHEN o_orderstatus = 'P' THEN round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(o_orderdate)) / 86400000000.0, 6)
            ELSE round(1 + h / 24.0, 6) END"""})


def _days_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(q(c), "yyyy-MM-dd") for c in cols})


def _instants_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(q(c), "yyyy-MM-dd HH:mm:ss") for c in cols})


def _landed(spark: SparkSession, sf: str, spec: ReportSpec) -> DataFrame:
    issues = landed_issues(spark, sf)
    return build_report(issues, field_catalog(issues), spec)


def _par_text(rep: DataFrame) -> DataFrame:
    rep = _instants_text(_days_text(rep, "ProjectEffectiveDate"), "Created", "Resolved", "Updated", "StatusCategoryChanged")
    return rep.withColumn("TimeToCompletion", F.round("TimeToCompletion", 6))


def par_report(spark: SparkSession, sf: str) -> DataFrame:
    """Q1, every column: dates as written, hours to completion, NaN when open."""
    return _par_text(finish_par(_landed(spark, sf, PAR)))


_PAR_COLUMNS = {
    "IssueID": "CAST(o_orderkey AS VARCHAR)", "IssueKey": "'ORD-' || CAST(o_orderkey AS VARCHAR)",
    "ProjectEffectiveDate": _day(6, 3), "Created": _at(0), "Resolved": _at(3, when=_FINAL), "Updated": _at(4),
    "Organization": "' ' || n_name || ', Branch '", "RequestType": "c_mktsegment", "Status": "o_orderstatus",
    "StatusCategory": _plain(6), "StatusCategoryChanged": _at(5, when=_NOT_P), "Assignee": "assignee", "Reporter": _plain(10),
    "Resolution": _plain(7), "Summary": _plain(0), "TimeToCompletion": "CASE WHEN o_orderstatus = 'F' THEN 72.0::DOUBLE ELSE 'NaN'::DOUBLE END"}
PAR_ORACLE = _BASE_SQL + _select(_PAR_COLUMNS)


def project_reports(spark: SparkSession, sf: str) -> DataFrame:
    """PAR over pages of several projects, one of which keeps Request Type and Department
    in each other's fields: every row is read through its own project's dictionary."""
    pages = landed_table(spark, sf, by_project=True)
    a, b, hold = "customfield_10010", "customfield_10020", "customfield_swap"
    swapped = F.replace(F.replace(F.replace("raw", F.lit(a), F.lit(hold)), F.lit(b), F.lit(a)), F.lit(hold), F.lit(b))
    issues = settle_issues(pages_from_text(pages.withColumn("raw", F.when(F.col("project") == "O", swapped).otherwise(F.col("raw"))), "raw"))
    catalog = field_catalog(issues)
    whole = build_report(issues, catalog, PAR, keep=["project"])
    one = build_report(issues, catalog, PAR, project="O").withColumn("project", F.lit("only O"))
    return _par_text(finish_par(whole.unionByName(one)))


PROJECT_REPORTS_ORACLE = _BASE_SQL + _select({**_PAR_COLUMNS, "project": "o_orderstatus"}) + "\nUNION ALL BY NAME\n" \
    + _select({**_PAR_COLUMNS, "project": "'only O'"}) + "\nWHERE o_orderstatus = 'O'"


PLACES = ReportSpec("places", (Col("IssueKey", "key"), Col("Branch", "Branch/Division", ("value",)), Col("RPDBranch", "RPDBranch", ("value",)),
                               Col("RequestParticipants", "Requestparticipants", ("displayName",), how="strict")))


def renamed_fields(spark: SparkSession, sf: str) -> DataFrame:
    """J1, N12, N13, A5 over two pulls: the second lands every other page again, with new values, one field
    under another name and two fields under each other's.  The table is merged batch by batch and holds an
    issue once; every row is read by its own page's dictionary."""
    pages = landed_table(spark, sf)
    swap = [("\"customfield_10103\": \"Branch/Division\"", "\"customfield_10103\": \"Branch\""),
            ("\"customfield_10104\": \"RPD Branch\"", "\"customfield_10104\": \"Case type\""),
            ("\"customfield_10106\": \"Case type\"", "\"customfield_10106\": \"RPD Branch\""),
            ("\"customfield_10103\":{\"value\":\"v19-", "\"customfield_10103\":{\"value\":\"new-")]
    raw = F.col("raw")
    for old, new in swap:
        raw = F.replace(raw, F.lit(old), F.lit(new))
    table = shared_dir(spark, "latest")
    first = pages.withColumn("pull", F.lit("2025-01-01"))
    again = pages.where(F.col("page_no") % 2 == 0).withColumn("pull", F.lit("2025-01-02")).withColumn("raw", raw)
    for version, pull in enumerate((first, again)):
        with small_methods(spark):
            compact_batch(explode_issues(pages_from_text(pull, "raw"), keep_names=True), table, version, buckets=16)
    issues = read_compacted(spark, table)
    return build_report(issues, field_catalog(issues), PLACES, keep=["pull"])


_AGAIN = "o_orderkey // 100 % 2 = 0"
RENAMED_FIELDS_ORACLE = _BASE_SQL + _select({
    "IssueKey": "'ORD-' || CAST(o_orderkey AS VARCHAR)", "pull": f"CASE WHEN {_AGAIN} THEN '2025-01-02' ELSE '2025-01-01' END",
    "Branch": f"CASE WHEN {_AGAIN} THEN replace({_plain(19)}, 'v19-', 'new-') ELSE {_plain(19)} END",
    "RPDBranch": f"CASE WHEN {_AGAIN} THEN {_plain(22)} ELSE {_plain(20)} END",
    "RequestParticipants": "c_name || ';' || n_name"})


# --------------------------------------------------------------------------------------
# COM multi-select matrices (Q8-Q10)
# --------------------------------------------------------------------------------------
BLANK = "Blank"


def selected_options(uses: Sequence[dict[str, list]], leaf: str = "value") -> Column:
    """The options an issue has in one or more multi-select fields, as an array.

    The reference widens every option list into numbered columns, lengthens them again,
    numbers the rows per issue and calls a missing first row ``Blank``.  Its first row is
    always slot 1 of the first source field, so the options are, in the row itself: ``Blank``
    when that slot has no value, and every distinct value of every source.
    """
    none = F.array().cast("array<string>")

    def values(use: dict[str, list]) -> Column:
        field = _source_expr(Col("options", "options", how="raw"), use)
        slots = F.coalesce(F.try_variant_get(field, "$", "array<variant>"), F.array().cast("array<variant>"))
        return F.transform(slots, lambda o: F.try_variant_get(o, variant_path((leaf,)), "string"))

    first = F.try_element_at(values(uses[0]), F.lit(1))
    found = F.concat(F.when(first.isNull(), F.array(F.lit(BLANK))).otherwise(none), *[values(u) for u in uses])
    return F.array_distinct(F.filter(found, lambda v: v.isNotNull()))


def option_matrix(issues: DataFrame, catalog: FieldCatalog, key: str, sources: Sequence[str], project: str | None = None,
                  options: Sequence[str] | None = None) -> DataFrame:
    """Q8, Q9: issue x option, 0/1; the options come from the data, or from a list that must hold them all.

    Every cell is read off the options array of its own row: one scan, no exchange.
    """
    if project is not None:
        issues = issues.where(F.col("project") == F.lit(project))
    found = catalog.sources(sources, project)
    if not found:
        raise ValueError(f"none of {list(sources)} is in the dictionary")
    rows = issues.select(F.col(key), selected_options([found.get(s, {}) for s in sources]).alias("_options"))
    if options is None:
        options = vocabulary(rows.select(F.explode("_options").alias("option")), "option")
    else:
        rows = rows.withColumn("_options", F.transform("_options", lambda v: known_value(v, options)))
    return rows.select(key, *indicators(F.col("_options"), options, [key]))


AUDIENCES = ["Intended audiences", "Intended Audience(s)"]


def _com_issues(spark: SparkSession, sf: str):
    issues = landed_issues(spark, sf)
    return issues.withColumnRenamed("id", "IssueKeyNumber"), field_catalog(issues)


def com_tactics(spark: SparkSession, sf: str) -> DataFrame:
    """Q8: issue x tactic indicator matrix."""
    return option_matrix(*_com_issues(spark, sf), "IssueKeyNumber", ["Tactics"])


def com_tactics_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Q8 + S3: the tactics matrix as CSV, whose header has the options' exact texts, read back by place."""
    matrix = com_tactics(spark, sf)
    path = shared_dir(spark, "matrix")
    write_csv(matrix, path)
    if spark.read.text(path).where(F.col("value") == F.lit(csv_header(matrix))).isEmpty():
        raise RuntimeError("the report has no header with the options' texts")
    return read_csv(spark, path, matrix.schema)


def com_audiences(spark: SparkSession, sf: str) -> DataFrame:
    """Q9: issue x audience matrix over both audience fields."""
    return option_matrix(*_com_issues(spark, sf), "IssueKeyNumber", AUDIENCES)


def com_audience_count(spark: SparkSession, sf: str) -> DataFrame:
    """Q10: audiences per issue, the row sum over the audience columns (``Blank`` is none)."""
    wide = com_audiences(spark, sf)
    return row_sum(wide, [c for c in wide.columns if c not in ("IssueKeyNumber", BLANK)], "Count").select("IssueKeyNumber", "Count")


_COM_BASE = """
WITH b AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS IssueKeyNumber, o.o_orderkey AS k, o.o_orderpriority AS prio, o.o_orderstatus AS status,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN 'All Employees' WHEN 'AUTOMOBILE' THEN 'Executive'
                             WHEN 'MACHINERY' THEN 'Managers' ELSE 'Other' END AS seg_aud
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)
"""
COM_TACTICS_ORACLE = _COM_BASE + """
SELECT IssueKeyNumber,
  CASE WHEN prio = '5-LOW' OR prio = '4-NOT SPECIFIED' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "Blank",
  CASE WHEN prio <> '5-LOW' AND (prio = '2-HIGH' OR status = 'F') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "Email",
  CASE WHEN prio = '3-MEDIUM' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "Newsletter",
  CASE WHEN prio <> '5-LOW' AND status = 'O' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "Poster",
  CASE WHEN prio = '1-URGENT' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "Social Media",
  CAST(prio <> '5-LOW' AND k % 11 = 0 AS DOUBLE) AS "email.2",
  CAST(prio <> '5-LOW' AND k % 11 <> 0 AND k % 13 = 0 AS DOUBLE) AS "(empty)",
  CAST(prio <> '5-LOW' AND k % 11 <> 0 AND k % 13 <> 0 AND k % 17 = 0 AS DOUBLE) AS "Paper `A4`",
  CAST(prio <> '5-LOW' AND k % 11 <> 0 AND k % 13 <> 0 AND k % 17 <> 0 AND k % 19 = 0 AS DOUBLE) AS "IssueKeyNumber.2"
FROM b
"""
_COM_AUDIENCE_MATRIX = _COM_BASE + """,
m AS (
  SELECT IssueKeyNumber,
    CASE WHEN status <> 'O' AND seg_aud = 'All Employees' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "All Employees",
    CASE WHEN status = 'O' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "Blank",
    CASE WHEN (status <> 'O' AND seg_aud = 'Executive') OR prio IN ('1-URGENT', '2-HIGH') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "Executive",
    CASE WHEN status <> 'O' AND seg_aud = 'Managers' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "Managers",
    CASE WHEN (status <> 'O' AND seg_aud = 'Other') OR prio IN ('1-URGENT', '2-HIGH') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "Other",
    CAST(prio IN ('1-URGENT', '2-HIGH') AND k % 11 = 0 AS DOUBLE) AS "executive.2"
  FROM b)
"""
COM_AUDIENCES_ORACLE = _COM_AUDIENCE_MATRIX + "SELECT * FROM m"
COM_COUNT_ORACLE = _COM_AUDIENCE_MATRIX + """SELECT IssueKeyNumber,
  "All Employees" + "Executive" + "Managers" + "Other" + "executive.2" AS "Count" FROM m"""


# --------------------------------------------------------------------------------------
# RBAS (Q2) and GPOPR (Q3) on the landed pages
# --------------------------------------------------------------------------------------
RBAS_EXCLUDED = ["ORD-1", "ORD-2", "ORD-3", "ORD-4", "ORD-5", "ORD-6"]   # the test tickets


def rbas_report(spark: SparkSession, sf: str) -> DataFrame:
    """Q2, every column: instants, minutes to resolution replacing the SLA millis, test tickets removed."""
    rep = finish_rbas(_landed(spark, sf, RBAS), excluded=RBAS_EXCLUDED)
    return _instants_text(rep, "Created", "Updated", "StatusCategoryChanged") \
        .withColumn("MinutesToResolution", F.round("MinutesToResolution", 6))


RBAS_ORACLE = _BASE_SQL + _select({
    "IssueID": "CAST(o_orderkey AS VARCHAR)", "IssueKey": "'ORD-' || CAST(o_orderkey AS VARCHAR)", "Created": _at(0),
    "EndDate": _day(7, 4), "RequestedDueDate": _plain(16), "Duedate": _day(8, 5), "Updated": _at(4), "Resolved": _at(3, ISO, _FINAL),
    "Resolution": _plain(7),
    "MinutesToResolution": "CASE WHEN o_totalprice >= 1000 THEN round(floor(o_totalprice / 1000) * 60000 / 1000.0 / 60, 6) END",
    "ServiceRequested": _plain(17), "ProjectType": _plain(18), "Organization": "' ' || n_name || ', Branch '",
    "BranchDivision": _plain(19), "RPDBranch": _plain(20), "MYSCReq": _plain(1), "RequestType": "c_mktsegment",
    "RequestSubtype": _plain(21), "Casetype": _plain(22), "Status": "o_orderstatus", "StatusCategory": _plain(6),
    "StatusCategoryChanged": _at(5, when=_NOT_P), "Assignee": "assignee", "EmployeeID": _plain(2), "Reporter": _plain(10),
    "Summary": _plain(0)}) + "\nWHERE o_orderkey NOT IN (1, 2, 3, 4, 5, 6)"


def gpopr_report(spark: SparkSession, sf: str) -> DataFrame:
    """Q3, every column: calendar dates as written, participants joined by ``;``."""
    return _days_text(finish_gpopr(_landed(spark, sf, GPOPR)), "Created", "Updated", "Duedate")


GPOPR_ORACLE = _BASE_SQL + _select({
    "IssueID": "CAST(o_orderkey AS VARCHAR)", "IssueKey": "'ORD-' || CAST(o_orderkey AS VARCHAR)", "Created": _at(0, "%Y-%m-%d"),
    "Updated": _at(4, "%Y-%m-%d"), "Duedate": _day(8, 5), "Priority": "o_orderpriority", "Status": "o_orderstatus",
    "Assignee": "assignee", "GPOPackageApprover": _plain(12), "GPOSubtype": _plain(23), "Organization": "' ' || n_name || ', Branch '",
    "City": _plain(24), "RequestType": "c_mktsegment", "RequestParticipants": "c_name || ';' || n_name", "Summary": _plain(0)})


def com_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Q7: COM issue list with the header clean-up (dates as written, nested columns dropped)."""
    return _days_text(finish_com(_landed(spark, sf, COM)), "Created", "Initial Target Date", "Resolved")


COM_ISSUES_ORACLE = _BASE_SQL + _select({
    "IssueKeyNumber": "CAST(o_orderkey AS VARCHAR)", "IssueKey": "'ORD-' || CAST(o_orderkey AS VARCHAR)", "Priority": "o_orderpriority",
    "AssigneeName": "assignee", "Resolved": _at(3, "%Y-%m-%d", _FINAL), "Frequency": _plain(32), "Initial Target Date": _day(9, 6),
    "RequestType": "c_mktsegment", "Summary": _plain(0), "IssueType": _plain(8), "Reporter": _plain(10), "CreatorName": _plain(11),
    "Created": _at(0, "%Y-%m-%d"), "Description": "c_name", "RPD Branch": _plain(20), "RequireCommsPlan": _plain(27),
    "CommunicationLead": _plain(14), "TopicOfCommunication": _plain(31), "Status": "o_orderstatus"})


def csr_report(spark: SparkSession, sf: str) -> DataFrame:
    """Q11: the intended CSR report: all-null columns dropped, dates, instants, description text, the
    change log kept (as its number of histories here)."""
    issues = landed_issues(spark, sf)
    rep = finish_csr(csr_columns(issues, field_catalog(issues)))
    histories = F.array_size(F.try_variant_get("Changelog", "$.histories", "array<struct<>>"))     # none is read
    return _days_text(_instants_text(rep, "Resolved", "Created", "Updated", "StatusCategoryChanged"), "ProjectEffectiveDate") \
        .withColumn("Changelog", histories.cast("bigint"))


CSR_ORACLE = _BASE_SQL + _select({
    "IssueID": "CAST(o_orderkey AS VARCHAR)", "IssueKey": "'ORD-' || CAST(o_orderkey AS VARCHAR)", "Assignee": "assignee",
    "Creator": _plain(11), "CSM": _plain(15), "CSRIssueSubtype": _plain(28), "Reporter": _plain(10),
    "Organization": "' ' || n_name || ', Branch '", "ResponsibleGroup": _plain(29), "ProjectEffectiveDate": _day(6, 3),
    "StatusCategory": _plain(6), "Resolution": _plain(7), "Progress": "CAST(o_orderkey % 101 AS DOUBLE)", "IssueType": _plain(8),
    "Project": _plain(9), "PIN": _plain(5), "Resolved": _at(3, when=_FINAL), "Updated": _at(4), "Description": "c_name",
    "RequestType": "c_mktsegment", "Summary": _plain(0), "StatusCategoryChanged": _at(5, when=_NOT_P), "Priority": "o_orderpriority",
    "Status": "o_orderstatus", "TotalProgress": "CAST(o_orderkey % 102 AS DOUBLE)", "Created": _at(0),
    "Changelog": """CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 0 WHEN o_orderstatus IN ('P', 'O') THEN 1
                          WHEN o_orderkey % 4 = 0 THEN 3 ELSE 2 END AS BIGINT)"""})


REPORT_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sbp_time_in_status": sbp_time_in_status,
    "par_report": par_report,
    "project_reports": project_reports,
    "renamed_fields": renamed_fields,
    "com_tactics": com_tactics,
    "com_tactics_csv": com_tactics_csv,
    "com_audiences": com_audiences,
    "com_audience_count": com_audience_count,
    "rbas_report": rbas_report,
    "gpopr_report": gpopr_report,
    "com_issues": com_issues,
    "csr_report": csr_report,
}
REPORT_ORACLES: dict[str, str] = {
    "par_report": PAR_ORACLE,
    "project_reports": PROJECT_REPORTS_ORACLE,
    "renamed_fields": RENAMED_FIELDS_ORACLE,
    "com_tactics": COM_TACTICS_ORACLE,
    "com_tactics_csv": COM_TACTICS_ORACLE,
    "com_audiences": COM_AUDIENCES_ORACLE,
    "com_audience_count": COM_COUNT_ORACLE,
    "rbas_report": RBAS_ORACLE,
    "gpopr_report": GPOPR_ORACLE,
    "com_issues": COM_ISSUES_ORACLE,
    "csr_report": CSR_ORACLE,
}
