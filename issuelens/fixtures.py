"""Landed issue pages derived from the provided relational tables.

The reference reads issue-tracker pages; the test tables are relational.  These helpers
write each order as an issue document (JSON text, the form pages land in) so that the
nested operators are exercised on real, growing data.  Every document is built from one
row's columns; a page gathers at most ``PAGE_SIZE`` consecutive order keys, so no group
is larger than a page whatever the data size.

Mapping: order = issue (``o_orderkey`` = id, ``o_orderdate`` = created), customer =
assignee/reporter, nation = department, order status/priority = status/priority.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuelens.session import shared_dir, small_methods, spread

PAGE_SIZE = 100
ORDERS_PER_TASK = 10_000       # orders whose documents a task gathers into pages
# A page text has some 500 KB, so pages are written in small row groups, each some ten pages: a reader holds
# one row group at a time, a writer one more.
LANDED = {"compression": "zstd", "parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 10,
          "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 10, "parquet.enable.dictionary": "false"}

# Fixed field catalogue of the landed project: field id -> display name, in page order.
# Two ids share the display name "Department" (the duplicate-name case).
FIELD_NAMES = [
    ("status", "Status"),
    ("priority", "Priority"),
    ("assignee", "Assignee"),
    ("customfield_10010", "Request Type"),
    ("customfield_10020", "Department"),
    ("customfield_10021", "Department"),
    ("customfield_10030", "Request participants"),
    ("created", "Created"),
    ("resolutiondate", "Resolved"),
    ("customfield_10040", "Ministry/BPS Organization"),
    ("description", "Description"),
    ("customfield_10050", "Tactics"),
    ("customfield_10060", "Intended audiences"),
    ("customfield_10061", "Intended Audience(s)"),
    ("customfield_10070", "Time to resolution"),
    ("updated", "Updated"),
    ("statuscategorychangedate", "Status Category Changed"),
    ("customfield_10080", "Project Effective Date"),
    ("customfield_10081", "End Date"),
    ("duedate", "Due date"),
    ("customfield_10082", "Initial Target Date"),
    ("summary", "Summary"),
    ("customfield_10083", "MYSC Req#"),
    ("customfield_10084", "Employee ID"),
    ("customfield_10085", "Number of Spaces to Onboard"),
    ("customfield_10086", "Last Updated Status"),
    ("customfield_10087", "PIN (ARE Number)"),
    ("statusCategory", "Status Category"),
    ("resolution", "Resolution"),
    ("issuetype", "Issue Type"),
    ("project", "Project"),
    ("reporter", "Reporter"),
    ("creator", "Creator"),
    ("customfield_10090", "GPO Package Approver"),
    ("customfield_10091", "Name of Space Booking Admin"),
    ("customfield_10092", "Communication Lead"),
    ("customfield_10093", "CSM"),
    ("customfield_10100", "Requested Due Date"),
    ("customfield_10101", "Service Requested"),
    ("customfield_10102", "Project Type"),
    ("customfield_10103", "Branch/Division"),
    ("customfield_10104", "RPD Branch"),
    ("customfield_10105", "Request Subtype"),
    ("customfield_10106", "Case type"),
    ("customfield_10107", "GPO Subtype"),
    ("customfield_10108", "City Dropdown"),
    ("customfield_10109", "Do you have a floor plan?"),
    ("customfield_10110", "Do you have a furniture plan?"),
    ("customfield_10111", "Comms Plan Required?"),
    ("customfield_10112", "CSR Issue Subtype"),
    ("customfield_10113", "Responsible Group"),
    ("customfield_10120", "Address"),
    ("customfield_10121", "Topic of Communication"),
    ("customfield_10122", "Frequency"),
    ("customfield_10123", "Communication Topic"),
    ("parent", "Parent"),
    ("progress", "Progress"),
    ("aggregateprogress", "ΣProgress"),
]

# How the plain fields above are landed: field id -> shape.  The value of field number n (its
# place in this list) is ``v<n>-<order key modulo 50>``, and missing where the order key leaves
# 0 modulo n + 3.
PLAIN_FIELDS = [
    ("summary", "text"), ("customfield_10083", "text"), ("customfield_10084", "text"), ("customfield_10085", "text"),
    ("customfield_10086", "text"), ("customfield_10087", "text"),
    ("statusCategory", "name"), ("resolution", "name"), ("issuetype", "name"), ("project", "name"),
    ("reporter", "displayName"), ("creator", "displayName"), ("customfield_10090", "displayName"), ("customfield_10091", "displayName"),
    ("customfield_10092", "displayName"), ("customfield_10093", "displayName"),
    ("customfield_10100", "value"), ("customfield_10101", "value"), ("customfield_10102", "value"), ("customfield_10103", "value"),
    ("customfield_10104", "value"), ("customfield_10105", "value"), ("customfield_10106", "value"), ("customfield_10107", "value"),
    ("customfield_10108", "value"), ("customfield_10109", "value"), ("customfield_10110", "value"), ("customfield_10111", "value"),
    ("customfield_10112", "value"), ("customfield_10113", "value"),
    ("customfield_10120", "rich"), ("customfield_10121", "rich"), ("customfield_10122", "options"), ("parent", "key"),
]


def plain_fields() -> dict[str, Column]:
    out = {}
    for n, (field, shape) in enumerate(PLAIN_FIELDS):
        value = F.concat(F.lit(f"v{n}-"), (F.col("o_orderkey") % 50).cast("string"))
        shaped = {"text": value, "rich": _rich_text(value), "options": F.array(F.struct(value.alias("value")), F.struct(F.lit("second").alias("value")))}
        out[field] = F.when(F.col("o_orderkey") % (n + 3) != 0, shaped.get(shape, F.struct(value.alias(shape))))
    return out


def load(spark: SparkSession, sf_dir: str, name: str, heavy_rows: bool = False) -> DataFrame:
    """A provided table.  ``heavy_rows``: the next stage does costly per-row work (JSON,
    text, timestamp parsing), so spread an input that arrives in fewer splits than cores.
    Light aggregations skip it: a partial aggregate in one task beats an extra shuffle."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if heavy_rows else df


def _rec(**fields: Column) -> Column:
    """A JSON object with a fixed shape (``to_json`` drops NULL members)."""
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def _json_text(c: Column) -> Column:
    """A string column as a JSON string literal (quoted, escaped): ``["x"]`` without brackets."""
    arr = F.to_json(F.array(c))
    return arr.substr(F.lit(2), F.length(arr) - 2)


def _splice(obj_json: Column, key: str, value_json: Column) -> Column:
    """Add ``"key": <value_json>`` to a JSON object text; used where a member changes
    JSON type from row to row (object, scalar or null), which a struct cannot express."""
    head = obj_json.substr(F.lit(1), F.length(obj_json) - 1)       # drop the closing brace
    return F.concat(head, F.lit(f',"{key}":'), value_json, F.lit("}"))


def _iso(ts: Column, offset: str = "+0000") -> Column:
    return F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss.SSS'{offset}'")


def _rich_text(text: Column) -> Column:
    para = _rec(type=F.lit("paragraph"), content=F.array(_rec(type=F.lit("text"), text=text)))
    return _rec(type=F.lit("doc"), version=F.lit(1), content=F.array(para))


def _item(field: str, from_s: str, to_s: str) -> Column:
    return _rec(field=F.lit(field), fieldtype=F.lit("system"), fromString=F.lit(from_s), toString=F.lit(to_s))


def issue_histories() -> Column:
    """Change history built from the order's own columns (bounded by construction).

    * ``5-LOW`` orders: no history at all (the issue keeps NULL durations);
    * status ``P``: one priority change only (no status item -> synthetic No-Change row);
    * status ``O``: ``Open -> In Progress`` after 1 day + up to 23 hours;
    * status ``F``: as ``O``, then an assignee change and ``in progress -> Done`` at 3 days
      (lower-case spelling, merged by title case); where the key is divisible by 4 also, at 5 days
      and written first, ``Resolved -> In Review`` and ``in review -> Closed`` in one history (more
      statuses, a tie, histories out of order, and a status called like a report column).
    """
    created = F.col("o_orderdate").cast("timestamp")
    hours = F.least(F.lit(23), F.floor(F.col("o_totalprice") / 25000)).cast("int")
    t1 = created + F.make_dt_interval(F.lit(1), hours)
    t2 = created + F.make_dt_interval(F.lit(3))
    h_prio = _rec(id=F.lit("1"), created=_iso(created + F.make_dt_interval(F.lit(2))),
                  items=F.array(_item("priority", "Low", "High")))
    h1 = _rec(id=F.lit("1"), created=_iso(t1), items=F.array(_item("status", "Open", "In Progress")))
    h2 = _rec(id=F.lit("2"), created=_iso(t2),
              items=F.array(_item("assignee", "Ann", "Bob"), _item("status", "in progress", "Done")))
    h3 = _rec(id=F.lit("3"), created=_iso(created + F.make_dt_interval(F.lit(5))),
              items=F.array(_item("status", "Resolved", "In Review"), _item("status", "in review", "Closed")))
    status = F.col("o_orderstatus")
    return (F.when(F.col("o_orderpriority") == "5-LOW", F.slice(F.array(h1), 1, 0))
            .when(status == "P", F.array(h_prio))
            .when(status == "O", F.array(h1))
            .when(F.col("o_orderkey") % 4 == 0, F.array(h3, h1, h2))
            .otherwise(F.array(h1, h2)))


def _options(*values: Column) -> Column:
    """A multi-select value: ``[{"value": v}, ...]`` (a NULL value is written as null)."""
    return F.array(*[F.struct(v.alias("value")) for v in values])


def _no_options() -> Column:
    return F.slice(_options(F.lit("")), 1, 0)


# Options that Spark cannot tell apart from another, or not address by their text: order keys
# divisible by the number have the option (the first that applies).
AWKWARD_OPTIONS = [(11, "email"), (13, ""), (17, "Paper `A4`"), (19, "IssueKeyNumber")]


def multi_select_tactics() -> Column:
    """Tactics: empty for ``5-LOW``; first slot from the priority (``4-NOT SPECIFIED`` is an
    unset option), second slot from the status when it has one, and on some issues a third whose
    text makes an awkward column name."""
    prio, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    t1 = (F.when(prio == "1-URGENT", F.lit("Social Media")).when(prio == "2-HIGH", F.lit("Email"))
          .when(prio == "3-MEDIUM", F.lit("Newsletter")))
    t2 = F.when(status == "F", F.lit("Email")).when(status == "O", F.lit("Poster"))
    t3 = None
    for modulus, option in AWKWARD_OPTIONS:
        rule = F.col("o_orderkey") % modulus == 0
        t3 = F.when(rule, F.lit(option)) if t3 is None else t3.when(rule, F.lit(option))
    return (F.when(prio == "5-LOW", _no_options())
            .when(t3.isNotNull(), _options(t1, t2, t3))
            .when(t2.isNull(), _options(t1))
            .otherwise(_options(t1, t2)))


def multi_select_audiences() -> Column:
    """First audience field: empty for open orders, else one option from the segment."""
    seg = F.col("c_mktsegment")
    a = (F.when(seg == "BUILDING", F.lit("All Employees")).when(seg == "AUTOMOBILE", F.lit("Executive"))
         .when(seg == "MACHINERY", F.lit("Managers")).otherwise(F.lit("Other")))
    return F.when(F.col("o_orderstatus") == "O", _no_options()).otherwise(_options(a))


def multi_select_audiences_2() -> Column:
    """Second audience field: two options for urgent and high priority, on some issues one more that
    differs from the first by its case only; else JSON null."""
    two = [F.lit("Executive"), F.lit("Other")]
    some = F.when(F.col("o_orderkey") % 11 == 0, _options(*two, F.lit("executive"))).otherwise(_options(*two))
    return F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), some)


def time_to_resolution() -> Column:
    """SLA field: an ongoing cycle whose elapsed milliseconds grow with the order value;
    orders without a price band above zero have no cycle."""
    millis = (F.floor(F.col("o_totalprice") / 1000) * 60000).cast("bigint")
    cycle = _rec(ongoingCycle=_rec(elapsedTime=_rec(millis=millis)))
    return F.when(F.col("o_totalprice") >= 1000, cycle)


def issue_rows(spark: SparkSession, sf_dir: str, heavy_rows: bool = True) -> DataFrame:
    """One narrow row per order, with the columns that its issue document is made of."""
    o = load(spark, sf_dir, "orders", heavy_rows=heavy_rows) \
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey, "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def issue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON issue document per order: (o_orderkey, o_orderstatus, doc)."""
    return issue_rows(spark, sf_dir).select("o_orderkey", "o_orderstatus", issue_document().alias("doc"))


def issue_document() -> Column:
    """The JSON issue document of an ``issue_rows`` row.

    Every member is serialised once (NULL members written as JSON null); the assignee, which is an
    object, a bare string or null depending on the customer's segment, is put in as text between
    the members before it and those after it.
    """
    created = F.col("o_orderdate").cast("timestamp")
    resolved = F.when(F.col("o_orderstatus") == "F", _iso(created + F.make_dt_interval(F.lit(3))))
    segment = F.col("c_mktsegment")
    assignee = (F.when(segment == "BUILDING", F.lit("null"))
                .when(segment == "AUTOMOBILE", _json_text(F.col("c_name")))
                .otherwise(F.to_json(_rec(displayName=F.col("c_name")))))
    participants = F.array(_rec(displayName=F.col("c_name")), _rec(displayName=F.col("n_name")))
    first = _rec(status=_rec(name=F.col("o_orderstatus")), priority=_rec(name=F.col("o_orderpriority")))
    fields = _rec(**{
        "customfield_10010": _rec(requestType=_rec(name=segment)),
        "customfield_10020": _rec(value=F.col("n_name")),
        "customfield_10021": F.lit(None).cast("string"),
        "customfield_10030": participants,
        "created": _iso(created),
        "resolutiondate": resolved,
        "customfield_10040": _rec(value=F.concat(F.lit(" "), F.col("n_name"), F.lit(", Branch "))),
        "description": _rich_text(F.col("c_name")),
        "customfield_10050": multi_select_tactics(),
        "customfield_10060": multi_select_audiences(),
        "customfield_10061": multi_select_audiences_2(),
        "customfield_10070": time_to_resolution(),
        "updated": _iso(created + F.make_dt_interval(F.lit(4))),
        "statuscategorychangedate": F.when(F.col("o_orderstatus") != "P", _iso(created + F.make_dt_interval(F.lit(5)))),
        "customfield_10080": F.when(F.col("o_orderkey") % 3 != 0, F.date_format(created + F.make_dt_interval(F.lit(6)), "yyyy-MM-dd")),
        "customfield_10081": F.when(F.col("o_orderkey") % 4 != 0, F.date_format(created + F.make_dt_interval(F.lit(7)), "yyyy-MM-dd")),
        "duedate": F.when(F.col("o_orderkey") % 5 != 0, F.date_format(created + F.make_dt_interval(F.lit(8)), "yyyy-MM-dd")),
        "customfield_10082": F.when(F.col("o_orderkey") % 6 != 0, F.date_format(created + F.make_dt_interval(F.lit(9)), "yyyy-MM-dd")),
        "customfield_10123": F.array(F.struct(segment.alias("value"))),
        "progress": _rec(progress=(F.col("o_orderkey") % 101).cast("int")),
        "aggregateprogress": _rec(progress=(F.col("o_orderkey") % 102).cast("int")),
        **plain_fields(),
    })
    whole = {"ignoreNullFields": "false"}
    head = F.to_json(_rec(id=F.col("o_orderkey").cast("string"), key=F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")), fields=first), whole)
    return F.concat(head.substr(F.lit(1), F.length(head) - 2), F.lit(',"assignee":'), assignee, F.lit(","), F.ltrim(F.to_json(fields, whole), F.lit("{")),
                    F.lit(',"changelog":'), F.to_json(_rec(startAt=F.lit(0), histories=issue_histories()), whole), F.lit("}"))


def _names_json() -> str:
    import json
    return json.dumps(dict(FIELD_NAMES))


def landed_pages(spark: SparkSession, sf_dir: str, by_project: bool = False,
                 page_size: int = PAGE_SIZE) -> DataFrame:
    """Issue documents gathered into page texts of at most ``PAGE_SIZE`` issues.

    Columns: project, page_no, raw (the page JSON).  Pages carry ``startAt``,
    ``maxResults``, ``names`` and, except on each project's last page, ``nextPageToken``;
    ``total`` is the project's issue count.  With ``by_project`` the order status is the
    project, so pages are of different sizes, and every project also gets one trailing empty page.
    """
    o = load(spark, sf_dir, "orders")
    project = F.col("o_orderstatus") if by_project else F.lit("ORD")
    page_no = F.floor(F.col("o_orderkey") / page_size).cast("bigint")
    # The narrow rows are shuffled to their pages, and become documents there: no document is ever shuffled
    # or sorted, and a task holds the documents of about ``ORDERS_PER_TASK`` orders.
    tasks = max(spark.sparkContext.defaultParallelism, -(-o.count() // ORDERS_PER_TASK))
    rows = issue_rows(spark, sf_dir, heavy_rows=False).withColumns({"project": project, "page_no": page_no})
    totals = o.groupBy(project.alias("project")).agg(F.count(F.lit(1)).alias("total"), F.max(page_no).alias("last_page"))
    if by_project:
        # Offsets count the project's issues on the pages before: a window over page counts (one row a
        # page, from the orders alone), which a page's narrow rows look up by its number.
        counts = o.groupBy(project.alias("project"), page_no.alias("page_no")).agg(F.count(F.lit(1)).alias("n"))
        whole = Window.partitionBy("project")
        placed = counts.select("project", "page_no", F.sum("n").over(whole).alias("total"), F.max("page_no").over(whole).alias("last_page"),
                               (F.sum("n").over(whole.orderBy("page_no")) - F.col("n")).alias("start_at"))
        rows = rows.join(placed, ["project", "page_no"])
    of_page = ["total", "last_page", "start_at"] if by_project else []
    pages = (rows.repartition(tasks, "page_no").select("project", "page_no", *of_page, "o_orderkey", issue_document().alias("doc"))
             .groupBy("project", "page_no", *of_page)
             .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "doc"))).alias("_issues")))
    if not by_project:
        # One project, whose order keys are its offsets: the total and last page are scalar subqueries
        # over the orders (one issue per order), not a join.
        pages = pages.withColumns({"total": o.select(F.count(F.lit(1))).scalar(), "start_at": F.col("page_no") * page_size,
                                   "last_page": o.select(F.max(page_no)).scalar()})
    token = F.when(F.col("page_no") < F.col("last_page"),
                   F.concat(F.lit("tok-"), (F.col("page_no") + 1).cast("string")))
    body = F.concat(
        F.lit('{"startAt":'), F.col("start_at").cast("string"),
        F.lit(f',"maxResults":{page_size},"total":'), F.col("total").cast("string"),
        F.coalesce(F.concat(F.lit(',"nextPageToken":"'), token, F.lit('"')), F.lit("")),
        F.lit(',"names":'), F.lit(_names_json()),
        F.lit(',"issues":['), F.array_join(F.transform("_issues", lambda x: x["doc"]), ","), F.lit("]}"))
    out = pages.select("project", "page_no", body.alias("raw"))
    if by_project:
        empty = totals.select(
            "project", (F.col("last_page") + 1).alias("page_no"),
            F.concat(F.lit('{"startAt":'), F.col("total").cast("string"),
                     F.lit(f',"maxResults":{page_size},"total":'), F.col("total").cast("string"),
                     F.lit(',"issues":[]}')).alias("raw"))
        out = out.unionByName(empty)
    return out


_LANDED: dict[tuple, str] = {}


def landed_once(spark: SparkSession, name: str, sf_dir: str, write: Callable[[str], None]) -> DataFrame:
    """A table that an application writes the first time it is asked for (and again, should its folder be gone)."""
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key in _LANDED:
        try:
            return spark.read.parquet(_LANDED[key])
        except AnalysisException:
            pass
    path = shared_dir(spark, name)
    with small_methods(spark):
        write(path)
    _LANDED[key] = path
    return spark.read.parquet(path)


def landed_table(spark: SparkSession, sf_dir: str, by_project: bool = False) -> DataFrame:
    """``landed_pages`` as a table, written once by an application: pages lie landed before any report runs."""
    return spread(landed_once(spark, "landed-by-project" if by_project else "landed", sf_dir,
                              lambda path: landed_pages(spark, sf_dir, by_project).write.options(**LANDED).parquet(path)))
