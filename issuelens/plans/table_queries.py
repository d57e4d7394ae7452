"""Queries over the provided tables, one per operator group, each with a DuckDB oracle.

Every query reads whole tables (or data Spark derives from them) and returns flat,
aliased columns; doubles are rounded to 6 places, instants are formatted as UTC text.
The oracle for query ``q`` is ``ORACLE[q]``: plain SQL over the same tables, written
independently of the operator under test (windows where we aggregate, CASE where we
walk VARIANT paths, list lambdas where we use higher-order functions).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from issuelens.functions import (as_character, as_numeric, days_between, hours_between, millis_to_minutes, nan_if_null,
                                 paste0, r_date, r_timestamp, strip_commas, title_case, trim_ws)
from issuelens.functions.titlecase import ALONE_WORDS, EITHER_WORDS, SMALL_WORDS
from issuelens.operators.columns import (SUFFIX_PATTERN, across, column_range, drop_all_null, drop_nested,
                                         matching, mutate_after, rename_regex, select_renamed, string_columns)
from issuelens.operators.explode import keyed_to_record, parallel_unnest, unnest_keyed
from issuelens.operators.extract import collapse_strict, ensure_columns, hoist, hoist_all, numbered_columns, page_width
from issuelens.operators.fields import disambiguate
from issuelens.operators.history import status_durations, status_transitions
from issuelens.operators.sequence import SkewPolicy, lag_in_order, row_number_in_order, running_max_in_order
from issuelens.operators.tables import (indicator_matrix, left_enrich, natural_full_join,
                                        row_sum, unpivot_long)
from issuelens.fixtures import _rec, issue_documents, landed_table, load
from issuelens.sources.pages import explode_issues, page_audit, pages_from_text, read_pages
from issuelens.sources.sinks import read_csv, write_with_summary
from issuelens.session import shared_dir, unsorted_writes

TS_FMT_SPARK = "yyyy-MM-dd HH:mm:ss"
TS_FMT_DUCK = "%Y-%m-%d %H:%M:%S"
AS_OF = "2025-01-01 00:00:00"            # F11: the run's "now", fixed for reproducibility
EVENTS_CREATED = "2024-01-01 00:00:00"   # creation time of every events "issue"
CUSTOMER_CREATED = "1995-01-01 00:00:00"
EVENT_STATUSES = ["Click", "Error", "Purchase", "Signup", "View"]
EXCLUDED_KEYS = ["CUST-1", "CUST-2", "CUST-3", "CUST-4", "CUST-5", "CUST-6"]

Query = Callable[[SparkSession, str], DataFrame]


def _r6(c):
    return F.round(c, 6)


def _fmt(ts):
    return F.date_format(ts, TS_FMT_SPARK)


# --------------------------------------------------------------------------------------
# W3 F8 A1 R3 W5 F3 -- time in status on the events stream (user = issue, type = status)
# --------------------------------------------------------------------------------------
def q_status_durations(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events")
    transitions = ev.select(
        F.col("user_id").alias("IssueKey"),
        F.lit(EVENTS_CREATED).cast("timestamp").alias("ticket_created"),
        F.col("ts").cast("timestamp").alias("changed_at"),
        F.lit("status").alias("field"),
        F.col("event_type").alias("from_status"),
        F.lit(None).cast("string").alias("to_status"),
        F.col("event_id").alias("_o0"))
    wide = status_durations(transitions, key="IssueKey")        # the statuses come from the data
    return wide.select(F.col("IssueKey").alias("user_id"), *[_r6(F.col(s)).alias(s) for s in EVENT_STATUSES])


_SQL_STATUS_DURATIONS = f"""
WITH t AS (
  SELECT user_id, event_type, ts,
         lag(ts, 1, TIMESTAMP '{EVENTS_CREATED}') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
  FROM events)
SELECT user_id,
""" + ",\n".join(
    f"  round(sum((epoch_us(ts) - epoch_us(prev_ts)) / 86400000000.0) FILTER (WHERE event_type = '{s.lower()}'), 6) AS {s}"
    for s in EVENT_STATUSES) + "\nFROM t GROUP BY user_id"


# --------------------------------------------------------------------------------------
# W1 W2 P12 P10 -- the synthetic "Open -> No-Change" rule (customer = issue, orders = items)
# --------------------------------------------------------------------------------------
def _customer_items(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    field = (F.when(F.col("o_orderstatus") == "F", F.lit("status"))
             .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P"), F.lit(None))
             .otherwise(F.lit("priority")))
    return o.select(F.col("o_custkey").alias("IssueKey"),
                    F.lit(CUSTOMER_CREATED).alias("TicketCreated"),
                    F.col("o_orderdate").alias("created"),
                    field.cast("string").alias("item_field"),
                    F.col("o_orderpriority").alias("item_fromString"),
                    F.col("o_orderstatus").alias("item_toString"),
                    F.col("o_orderkey").alias("history_pos"),
                    F.lit(0).alias("item_pos"))


def q_status_no_change(spark: SparkSession, sf: str) -> DataFrame:
    t = status_transitions(_customer_items(spark, sf), as_of=AS_OF)
    return t.select("IssueKey", _fmt("changed_at").alias("changed_at"), "from_status", "to_status")


_SQL_STATUS_NO_CHANGE = f"""
WITH items AS (
  SELECT o_custkey AS IssueKey, o_orderkey, o_orderdate AS changed_at,
         CASE WHEN o_orderstatus = 'F' THEN 'status'
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
              ELSE 'priority' END AS field,
         o_orderpriority AS from_status, o_orderstatus AS to_status
  FROM orders),
ranked AS (
  SELECT *,
         row_number() OVER (PARTITION BY IssueKey ORDER BY o_orderkey) AS rn,
         bool_or(field = 'status') OVER (PARTITION BY IssueKey) AS any_status,
         count(*) FILTER (WHERE field IS NULL) OVER (PARTITION BY IssueKey) AS n_unnamed
  FROM items),
rewritten AS (
  SELECT IssueKey,
         (rn = 1 AND NOT coalesce(any_status, false) AND n_unnamed = 0) AS synth,
         changed_at, field, from_status, to_status
  FROM ranked)
SELECT IssueKey,
       strftime(CASE WHEN synth THEN TIMESTAMP '{AS_OF}' ELSE changed_at END, '{TS_FMT_DUCK}') AS changed_at,
       CASE WHEN synth THEN 'Open' ELSE from_status END AS from_status,
       CASE WHEN synth THEN 'No-Change' ELSE to_status END AS to_status
FROM rewritten
WHERE (CASE WHEN synth THEN 'status' ELSE field END) = 'status'
"""


# --------------------------------------------------------------------------------------
# N9 N4 P1 P2 F14 -- safe hoist of nested fields from issue documents
# --------------------------------------------------------------------------------------
def q_hoist_fields(spark: SparkSession, sf: str) -> DataFrame:
    docs = issue_documents(spark, sf)
    issues = docs.select(F.parse_json("doc").alias("issue"))
    flat = issues.select(
        F.try_variant_get("issue", "$.id", "bigint").alias("IssueID"),
        F.try_variant_get("issue", "$.key", "string").alias("IssueKey"),
        *[F.try_variant_get("issue", f"$.fields.{f}", "variant").alias(n) for f, n in [
            ("assignee", "Assignee"), ("priority", "Priority"), ("status", "Status"),
            ("customfield_10010", "RequestType"), ("description", "Description"),
            ("resolutiondate", "Resolved")]])
    flat = hoist(flat, "Assignee", {"Assignee": "displayName"})
    flat = hoist(flat, "Priority", {"Priority": "name"})
    flat = hoist(flat, "Status", {"Status": "name"})
    flat = hoist(flat, "RequestType", {"RequestType": ("requestType", "name")})
    flat = hoist(flat, "Description", {"DescriptionText": ("content", 1, "content", 1, "text")}, remove=True)
    flat = hoist(flat, "Resolved", {"ResolvedDate": ((), "string")}, remove=True)
    return flat.withColumn("ResolvedDate", F.date_format(r_date(F.col("ResolvedDate")), "yyyy-MM-dd"))


_SQL_HOIST_FIELDS = """
SELECT o.o_orderkey AS IssueID,
       'ORD-' || CAST(o.o_orderkey AS VARCHAR) AS IssueKey,
       CASE WHEN c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN NULL ELSE c.c_name END AS Assignee,
       o.o_orderpriority AS Priority,
       o.o_orderstatus AS Status,
       c.c_mktsegment AS RequestType,
       c.c_name AS DescriptionText,
       CASE WHEN o.o_orderstatus = 'F' THEN strftime(o.o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d') END AS ResolvedDate
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""


# --------------------------------------------------------------------------------------
# N10 A5 N5 -- safe hoist all / strict collapse / numbered columns over record arrays
# --------------------------------------------------------------------------------------
def _participants(li: DataFrame) -> DataFrame:
    """A participants list per line item: records, one without ``displayName``, sometimes
    a JSON null element (-> NULL result) or an empty list (-> NULL result)."""
    none = F.lit(None).cast("string")
    e1 = _rec(displayName=F.col("l_returnflag"), other=none)
    e2 = _rec(displayName=F.col("l_linestatus"), other=none)
    e3 = F.when(F.col("l_discount") > 0.05, _rec(displayName=none, other=F.col("l_linenumber").cast("string"))) \
        .otherwise(_rec(displayName=F.col("l_linenumber").cast("string"), other=none))
    null_elem = F.when(F.lit(False), e1)
    arr = (F.when(F.col("l_quantity") <= 2, F.slice(F.array(e1), 1, 0))
           .when(F.col("l_tax") == 0, F.array(e1, e2, e3, null_elem))
           .otherwise(F.array(e1, e2, e3)))
    # Land as text and parse back, as pages arrive.
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.parse_json(F.to_json(arr)).alias("RequestParticipants"))


def q_hoist_all_join(spark: SparkSession, sf: str) -> DataFrame:
    """An order is a page and its line items the page's issues: the strict collapse wants every issue's list to
    be as long as the page's longest, which is worked out in the page's array before it is exploded."""
    keys = ["l_linenumber", "l_partkey", "l_suppkey"]
    lines = _participants(load(spark, sf, "lineitem", heavy_rows=True))
    pages = lines.groupBy("l_orderkey") \
        .agg(F.collect_list(F.struct(*keys, "RequestParticipants")).alias("issues"))
    width = page_width(F.transform("issues", lambda i: i["RequestParticipants"]), ())
    li = pages.withColumn("page_width", width).select("l_orderkey", "page_width", F.explode("issues").alias("i")) \
        .select("l_orderkey", "page_width", "i.*")
    out = hoist_all(li, "RequestParticipants", ["displayName"])
    out = out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.col("RequestParticipants_displayName").alias("participants"),
                     collapse_strict(F.col("RequestParticipants"), "displayName", width=F.col("page_width")).alias("participants_strict"),
                     # as wide as the longest list of the lines, which the pages hold all of: counted where they are scanned, not after the shuffle
                     *numbered_columns(lines, "RequestParticipants", "displayName", "part"))
    return out


_SQL_HOIST_ALL_JOIN = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_quantity <= 2 OR l_tax = 0 THEN NULL
            ELSE concat_ws(';', l_returnflag, l_linestatus,
                           CASE WHEN l_discount > 0.05 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END)
       END AS participants,
       -- slots of a page: the longest list of any of its issues
       CASE max(n) OVER (PARTITION BY l_orderkey) WHEN 0 THEN '' WHEN n THEN list_reduce(cells, lambda a, b: a || ';' || b) END AS participants_strict,
       CASE WHEN l_quantity <= 2 THEN NULL ELSE l_returnflag END AS part_1_displayName,
       CASE WHEN l_quantity <= 2 THEN NULL ELSE l_linestatus END AS part_2_displayName,
       CASE WHEN l_quantity <= 2 OR l_discount > 0.05 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS part_3_displayName,
       CAST(NULL AS VARCHAR) AS part_4_displayName
FROM (
  SELECT *, CASE WHEN l_quantity <= 2 THEN 0 WHEN l_tax = 0 THEN 4 ELSE 3 END AS n,
         [l_returnflag, l_linestatus, CASE WHEN l_discount <= 0.05 THEN CAST(l_linenumber AS VARCHAR) END,
          CASE WHEN l_tax <> 0 THEN '' END][1:CASE WHEN l_tax = 0 THEN 4 ELSE 3 END] AS cells
  FROM lineitem)
"""


# --------------------------------------------------------------------------------------
# S1 N1 N2 N6 -- landed pages -> one row per issue, page order kept
# --------------------------------------------------------------------------------------
def q_unnest_long(spark: SparkSession, sf: str) -> DataFrame:
    pages = pages_from_text(landed_table(spark, sf), "raw")
    issues = explode_issues(pages)
    issues = hoist(issues, "fields", {"Status": ("status", "name"), "Priority": ("priority", "name")})
    return issues.select("page_no", F.col("issue_pos").cast("bigint").alias("issue_pos"),
                         F.col("id").cast("bigint").alias("IssueID"), F.col("key").alias("IssueKey"),
                         "Status", "Priority")


_SQL_UNNEST_LONG = """
SELECT o_orderkey // 100 AS page_no,
       row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS issue_pos,
       o_orderkey AS IssueID,
       'ORD-' || CAST(o_orderkey AS VARCHAR) AS IssueKey,
       o_orderstatus AS Status,
       o_orderpriority AS Priority
FROM orders
"""


# --------------------------------------------------------------------------------------
# N7 P8 R4 A2 -- record -> key/value rows -> membership filter -> back to a record
# --------------------------------------------------------------------------------------
def q_unnest_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Histories arrive as key/value rows here (one per member), which is what the keyed unnest and
    its way back are for; a record that sits in its row is read by path instead."""
    ev = load(spark, sf, "events", heavy_rows=True)
    item = _rec(field=F.col("event_type"), k=F.get_json_object("props", "$.k").cast("bigint"))
    extra = _rec(field=F.lit("value"), k=F.lit(0).cast("bigint"))
    items = F.when(F.col("value") > 50, F.array(item, extra)).otherwise(F.array(item))
    history = _rec(created=F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+0000'"), items=items,
                   author=_rec(displayName=F.concat(F.lit("user-"), F.col("user_id").cast("string"))),
                   id=F.col("event_id").cast("string"))
    h = ev.select("event_id", F.parse_json(F.to_json(history)).alias("values"))
    kv = unnest_keyed(h, "values", key_to="column", values_to="values")
    kv = kv.where(F.col("column").isin("created", "items"))                       # P8
    rec = keyed_to_record(kv, ["event_id"], "column", "values", ["created", "items"])  # R4 + A2
    first_item = F.try_variant_get(F.element_at("items", 1), "$[0].field", "string")
    created = r_timestamp(F.try_variant_get(F.element_at("created", 1), "$", "string"))
    return rec.select("event_id", _fmt(created).alias("created"),
                      F.array_size(F.try_variant_get(F.element_at("items", 1), "$", "array<variant>"))
                      .cast("bigint").alias("n_items"),
                      first_item.alias("item_field"),
                      F.try_variant_get(F.element_at("items", 1), "$[0].k", "bigint").alias("k"))


_SQL_UNNEST_KEYED = f"""
SELECT event_id,
       strftime(ts, '{TS_FMT_DUCK}') AS created,
       CAST(CASE WHEN value > 50 THEN 2 ELSE 1 END AS BIGINT) AS n_items,
       event_type AS item_field,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
"""


# --------------------------------------------------------------------------------------
# N8 -- lock-step unnest of two arrays of different lengths
# --------------------------------------------------------------------------------------
def q_parallel_unnest(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem", heavy_rows=True)
    ship = F.col("l_shipdate").cast("timestamp")
    created = F.array(F.date_format(ship, "yyyy-MM-dd"), F.date_format(ship + F.make_dt_interval(F.lit(1)), "yyyy-MM-dd"))
    i1 = _rec(fromString=F.col("l_linestatus"))
    i2 = _rec(fromString=F.col("l_returnflag"))
    i3 = _rec(fromString=F.col("l_linenumber").cast("string"))
    items = F.when(F.col("l_returnflag") == "R", F.array(i1, i2, i3)).otherwise(F.array(i1))
    df = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                   F.parse_json(F.to_json(created)).alias("created"), F.parse_json(F.to_json(items)).alias("items"))
    z = parallel_unnest(df, ["created", "items"], pos_to="pos")
    return z.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("pos").cast("bigint").alias("pos"),
                    F.try_variant_get("created", "$", "string").alias("created"),
                    F.try_variant_get("items", "$.fromString", "string").alias("item_from"))


_SQL_PARALLEL_UNNEST = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(0 AS BIGINT) AS pos,
       strftime(l_shipdate, '%Y-%m-%d') AS created, l_linestatus AS item_from FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(1 AS BIGINT),
       strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d'),
       CASE WHEN l_returnflag = 'R' THEN l_returnflag END FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(2 AS BIGINT), NULL,
       CAST(l_linenumber AS VARCHAR) FROM lineitem WHERE l_returnflag = 'R'
"""


# --------------------------------------------------------------------------------------
# N12 A6 N3 -- field dictionary with duplicate display names numbered in key order
# --------------------------------------------------------------------------------------
def q_dedup_names(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer")
    entries = c.select(F.col("c_nationkey").cast("bigint").alias("project"),
                       F.concat(F.lit("customfield_"), F.col("c_custkey").cast("string")).alias("field_id"),
                       F.col("c_mktsegment").alias("display"),
                       F.col("c_custkey").alias("pos"))
    named = disambiguate(entries, group_cols=["project"], name_col="display", order_col="pos", out="name")
    return named.select("project", "field_id", "name")


_SQL_DEDUP_NAMES = """
SELECT CAST(c_nationkey AS BIGINT) AS project,
       'customfield_' || CAST(c_custkey AS VARCHAR) AS field_id,
       CASE WHEN count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) > 1
            THEN c_mktsegment || '-' || CAST(row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS VARCHAR)
            ELSE c_mktsegment END AS name
FROM customer
"""


# --------------------------------------------------------------------------------------
# J1 -- page append as a natural full join (NULL matches NULL, extra column on page 2)
# --------------------------------------------------------------------------------------
def _order_slices(spark: SparkSession, sf: str):
    o = load(spark, sf, "orders")
    prio = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("prio")
    a = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_custkey", "o_orderstatus", prio)
    b_status = F.when(F.col("o_orderstatus") == "P", F.lit("p")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    b = o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_custkey", b_status, prio, F.round("o_totalprice", 2).alias("o_totalprice"))
    return a, b


def q_natural_full_join(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _order_slices(spark, sf)
    return natural_full_join(a, b)


_SQL_NATURAL_FULL_JOIN = """
WITH a AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED') AS prio
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
b AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'p' ELSE o_orderstatus END AS o_orderstatus,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS prio, round(o_totalprice, 2) AS o_totalprice
  FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       coalesce(a.o_custkey, b.o_custkey) AS o_custkey,
       coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
       coalesce(a.prio, b.prio) AS prio,
       b.o_totalprice AS o_totalprice
FROM a FULL JOIN b
  ON a.o_orderkey IS NOT DISTINCT FROM b.o_orderkey AND a.o_custkey IS NOT DISTINCT FROM b.o_custkey
 AND a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus AND a.prio IS NOT DISTINCT FROM b.prio
"""


# --------------------------------------------------------------------------------------
# R2 J2 F15 A3 F13 P11 A4 -- multi-select -> long -> Blank rule -> indicator matrix
# --------------------------------------------------------------------------------------
def _return_options(spark: SparkSession, sf: str) -> DataFrame:
    """Orders x return-flag options; a flag ``N`` is an unset option (NULL).

    Line items are reduced per order *before* meeting the orders, in one partial
    aggregate: the first slot (``min_by``) and the set of distinct options -- at most the
    option vocabulary, whatever the order's size.  One left join then gives every order
    its options, plus ``Blank`` when its first slot is missing (or it has no lines);
    the conditional aggregate that follows groups by the join key, so it reuses that exchange.
    """
    o = load(spark, sf, "orders").select("o_orderkey")
    li = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("slot"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("opt"))
    per_order = li.groupBy("o_orderkey").agg(F.min_by(F.col("opt"), F.col("slot")).alias("first"),
                                             F.collect_set("opt").alias("opts"),
                                             F.lit(True).alias("has_lines"))
    joined = o.join(per_order, "o_orderkey", "left")
    blank = F.when(F.col("has_lines").isNull() | F.col("first").isNull(), F.array(F.lit("Blank")))
    values = F.concat(F.coalesce(F.col("opts"), F.array().cast("array<string>")),
                      F.coalesce(blank, F.array().cast("array<string>")))
    return joined.select("o_orderkey", F.explode(values).alias("Value"))


def q_indicator_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The option columns come from the data."""
    m = indicator_matrix(_return_options(spark, sf), "o_orderkey")
    return m.withColumnRenamed("o_orderkey", "IssueKeyNumber")


def q_row_sum(spark: SparkSession, sf: str) -> DataFrame:
    m = q_indicator_matrix(spark, sf)
    return row_sum(m, [c for c in m.columns if c != "IssueKeyNumber"], "Count").select("IssueKeyNumber", "Count")


_SQL_OPTION_VALUES = """
WITH opts AS (
  SELECT o.o_orderkey AS k, nullif(l.l_returnflag, 'N') AS v,
         row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey) AS rn
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey),
vals AS (
  SELECT DISTINCT k, CASE WHEN rn = 1 AND v IS NULL THEN 'Blank' ELSE v END AS val FROM opts),
matrix AS (
  SELECT k AS IssueKeyNumber,
         CAST(max(CASE WHEN val = 'A' THEN 1 ELSE 0 END) AS DOUBLE) AS A,
         CAST(max(CASE WHEN val = 'Blank' THEN 1 ELSE 0 END) AS DOUBLE) AS Blank,
         CAST(max(CASE WHEN val = 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS R
  FROM vals GROUP BY k)
"""
_SQL_INDICATOR_MATRIX = _SQL_OPTION_VALUES + "SELECT * FROM matrix"
_SQL_ROW_SUM = _SQL_OPTION_VALUES + "SELECT IssueKeyNumber, A + Blank + R AS Count FROM matrix"


# --------------------------------------------------------------------------------------
# R1 P6 -- columns to long, NULLs kept
# --------------------------------------------------------------------------------------
def q_unpivot_long(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment"),
        "c_nationkey", "c_acctbal")
    cols = matching(c, starts_with="C_", exclude=lambda n: n in ("c_custkey", "c_acctbal"))   # P6
    return unpivot_long(c, ["c_custkey"], cols, "aud_names", "aud_val")


_SQL_UNPIVOT_LONG = """
SELECT c_custkey, 'c_name' AS aud_names, c_name AS aud_val FROM customer
UNION ALL
SELECT c_custkey, 'c_mktsegment', nullif(c_mktsegment, 'BUILDING') FROM customer
UNION ALL
SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
"""


# --------------------------------------------------------------------------------------
# J3 -- left join of a per-key aggregate
# --------------------------------------------------------------------------------------
def q_left_enrich(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    o = load(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    agg = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("open_orders"), F.round(F.sum("o_totalprice"), 2).alias("open_value"))
    return left_enrich(c, agg, "c_custkey")


_SQL_LEFT_ENRICH = """
SELECT c.c_custkey, c.c_name, a.open_orders, a.open_value
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS open_orders, round(sum(o_totalprice), 2) AS open_value
           FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey) a
  ON c.c_custkey = a.o_custkey
"""


# --------------------------------------------------------------------------------------
# P9 -- exclusion list; NULL keys are kept (R's %in% never yields NA)
# --------------------------------------------------------------------------------------
def q_exclude_keys(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer")
    key = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string")))
    df = c.select("c_custkey", key.alias("IssueKey"))
    return df.where(~F.coalesce(F.col("IssueKey").isin(EXCLUDED_KEYS), F.lit(False)))


_SQL_EXCLUDE_KEYS = """
SELECT c_custkey, IssueKey FROM (
  SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'CUST-' || CAST(c_custkey AS VARCHAR) END AS IssueKey
  FROM customer)
WHERE NOT coalesce(IssueKey IN ('CUST-1', 'CUST-2', 'CUST-3', 'CUST-4', 'CUST-5', 'CUST-6'), false)
"""


# --------------------------------------------------------------------------------------
# F1 F2 F3 F4 P13 -- string clean-up across all text columns, title case of whole texts
# --------------------------------------------------------------------------------------
def q_clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents", heavy_rows=True).select("doc_id", "text", "lang", "source")
    d = across(d, strip_commas, string_columns(d))     # P13 + F1
    d = across(d, trim_ws, string_columns(d))          # P13 + F2
    return d.select("doc_id", "text", "lang", "source",
                    title_case(F.col("text")).alias("title"),
                    paste0(F.col("source"), F.lit("-"), F.col("lang")).alias("label"))


def _duck_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_SQL_CLEAN_STRINGS = r"""
WITH c AS (
  SELECT doc_id,
         regexp_replace(replace(text, ',', ''), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS text,
         regexp_replace(replace(lang, ',', ''), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS lang,
         regexp_replace(replace(source, ',', ''), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS source
  FROM documents),
t AS (
  SELECT *, regexp_extract_all(text, '[ \-/"()\n\t]|[^ \-/"()\n\t]+') AS toks FROM c)
SELECT doc_id, text, lang, source,
  array_to_string(list_transform(toks, lambda w, i:
    CASE
      WHEN i > 1 AND regexp_matches(w, '^(__SMALL__)$', 'i')
           AND NOT coalesce(i >= 3 AND regexp_matches(toks[i - 2], '[-:]$') AND toks[i - 1] = ' '
                            AND regexp_matches(w, '^[''\p{L}\p{Nd}]'), false)
           AND NOT coalesce(toks[i - 1] = '"', false)
        THEN lower(w)
      WHEN regexp_matches(w, '^\p{L}.*\p{Lu}') OR length(w) = 1 OR w IN (__ALONE__)
           OR regexp_matches(w, '^''.*''$')
        THEN w
      WHEN length(w) >= 3 AND substr(w, 1, 1) IN ('''', '"')
        THEN substr(w, 1, 1) || (CASE WHEN substr(w, 2, 1) = 'ß' THEN 'ß' ELSE upper(substr(w, 2, 1)) END) || substr(w, 3)
      -- one character to one character, as R's toupper: sharp s has no one-letter upper case
      WHEN substr(w, 1, 1) = 'ß' THEN w
      ELSE upper(substr(w, 1, 1)) || substr(w, 2)
    END), '') AS title,
  source || '-' || lang AS label
FROM t
""".replace("__SMALL__", SMALL_WORDS).replace("__ALONE__", _duck_list(ALONE_WORDS + EITHER_WORDS))


# --------------------------------------------------------------------------------------
# F5 F6 F7 F9 F10 F11 F12 -- offset timestamps, dates as written, hours and minutes
# --------------------------------------------------------------------------------------
def q_dates_hours(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = load(spark, sf, "lineitem", heavy_rows=True).select("l_orderkey", "l_linenumber", "l_partkey",
                                                             "l_suppkey", "l_shipdate", "l_linestatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    created_text = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss.SSS'-0700'")
    resolved_text = F.when(F.col("l_linestatus") == "F",
                           F.date_format(F.col("l_shipdate"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'"))
    t = j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                 created_text.alias("created_text"), resolved_text.alias("resolved_text"))
    created, resolved = r_timestamp(F.col("created_text")), r_timestamp(F.col("resolved_text"))
    millis = F.unix_millis(resolved) - F.unix_millis(created)
    hours = F.when(resolved.isNotNull(), hours_between(resolved, created))     # F12: NA when unresolved
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.date_format(r_date(F.col("created_text")), "yyyy-MM-dd").alias("created_date"),
                    _fmt(created).alias("created_utc"),
                    _r6(hours).alias("hours"),
                    _r6(millis_to_minutes(millis)).alias("minutes"),
                    _r6(days_between(F.lit(AS_OF).cast("timestamp"), created)).alias("age_days"))


_SQL_DATES_HOURS = f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       strftime(o.o_orderdate, '%Y-%m-%d') AS created_date,
       strftime(o.o_orderdate + INTERVAL 7 HOUR, '{TS_FMT_DUCK}') AS created_utc,
       CASE WHEN l.l_linestatus = 'F'
            THEN round((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate + INTERVAL 7 HOUR)) / 3600000000.0, 6) END AS hours,
       CASE WHEN l.l_linestatus = 'F'
            THEN round((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate + INTERVAL 7 HOUR)) / 60000000.0, 6) END AS minutes,
       round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(o.o_orderdate + INTERVAL 7 HOUR)) / 86400000000.0, 6) AS age_days
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


# --------------------------------------------------------------------------------------
# F13 -- missing measure after a left join becomes NaN
# --------------------------------------------------------------------------------------
def q_nan_fill(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").select("o_orderkey")
    li = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")) \
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("line_total"))
    return o.join(li, "o_orderkey", "left").withColumn("line_total", nan_if_null("line_total"))


_SQL_NAN_FILL = """
SELECT o.o_orderkey, coalesce(a.line_total, 'NaN'::DOUBLE) AS line_total
FROM orders o
LEFT JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS line_total FROM lineitem GROUP BY l_orderkey) a
  ON o.o_orderkey = a.l_orderkey
"""


# --------------------------------------------------------------------------------------
# P3 P4 P5 P7 F16 N11 -- schema clean-up: nested, all-NULL, suffixes, optional columns
# --------------------------------------------------------------------------------------
def q_drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "embeddings").select(
        "vec_id", "embedding", F.col("label").alias("label_value"), F.lit(None).cast("string").alias("Note_text"))
    e = ensure_columns(e, {"Parent": "string"})                                         # N11
    e = mutate_after(e, "dim", F.size("embedding").cast("bigint"), after="vec_id")      # P7
    e = drop_nested(e)                                                                  # P3 + F16
    e = drop_all_null(e)                                                                # P4
    return rename_regex(e, SUFFIX_PATTERN, "")                                          # P5


_SQL_DROP_COLUMNS = """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dim, label FROM embeddings
"""


# --------------------------------------------------------------------------------------
# S1 S2 A7 -- completeness audit of landed page sets per project
# --------------------------------------------------------------------------------------
PAGES_PER_FILE = 500           # some 250 MB of page texts
LANDED_SETS = 100              # more than there are projects and sets


def q_page_audit(spark: SparkSession, sf: str) -> DataFrame:
    """S1 + S2: pages written as ``project=`` files, read back and audited; beside each good set, project
    F's pages with one page cut short, one left out, the first left out, one landed twice, and one that
    begins an issue too soon."""
    pages = landed_table(spark, sf, by_project=True)
    final = pages.where("project = 'F'")
    at = F.col("page_no") - final.select(F.min("page_no")).scalar()
    second, others = final.where(at == 1), final.where(at != 1)
    named = lambda df, name: df.withColumn("project", F.lit(name))
    start = F.get_json_object("raw", "$.startAt").cast("bigint")
    early = second.withColumn("raw", F.concat(F.lit('{"startAt":'), (start - 1).cast("string"), F.substring("raw", F.instr("raw", ","), F.length("raw"))))
    sets = (pages.unionByName(named(others, "cut")).unionByName(named(second, "cut").withColumn("raw", F.substring("raw", 1, 200)))
            .unionByName(named(others, "gap")).unionByName(named(final, "twice")).unionByName(named(second, "twice"))
            .unionByName(named(final.where(at != 0), "head")).unionByName(named(others, "overlap")).unionByName(named(early, "overlap")))
    path = shared_dir(spark, "landing")
    # Page texts pack to a tenth and less; packed files are read whole, so they are kept small.
    with unsorted_writes(spark, LANDED_SETS):
        sets.select("project", F.col("raw").alias("value")).write.partitionBy("project") \
            .options(compression="gzip", maxRecordsPerFile=PAGES_PER_FILE).text(path)
    audit = page_audit(read_pages(spark, path, one_page_per_line=True))
    one = page_audit(read_pages(spark, path, project="P", one_page_per_line=True))       # prunes the other folders
    return audit.unionByName(named(one, "only P"))


_SQL_PAGE_AUDIT = """
WITH p AS (SELECT o_orderstatus AS project, o_orderkey // 100 AS page_no, count(*) AS n FROM orders GROUP BY 1, 2),
f AS (SELECT * FROM p WHERE project = 'F'),
first AS (SELECT n FROM f WHERE page_no = (SELECT min(page_no) FROM f)),
second AS (SELECT n FROM f WHERE page_no = (SELECT min(page_no) + 1 FROM f)),
good AS (
  SELECT project, count(*) + 1 AS pages, count(*) AS nonempty_pages, CAST(sum(n) AS BIGINT) AS issues,
         CAST(sum(n) AS BIGINT) AS announced_total, CAST(1 AS BIGINT) AS last_pages, CAST(0 AS BIGINT) AS broken_pages,
         CAST(0 AS BIGINT) AS repeated_pages, CAST(0 AS BIGINT) AS missing_pages, CAST(0 AS BIGINT) AS missing_issues,
         CAST(0 AS BIGINT) AS overlapping_issues FROM p GROUP BY project),
g AS (SELECT * FROM good WHERE project = 'F')
SELECT *, true AS complete FROM good
UNION ALL SELECT 'only P', * EXCLUDE (project), true FROM good WHERE project = 'P'
UNION ALL SELECT 'cut', pages, nonempty_pages - 1, issues - s.n, announced_total, last_pages, 1, 0, 0, s.n, 0, false FROM g, second s
UNION ALL SELECT 'gap', pages - 1, nonempty_pages - 1, issues - s.n, announced_total, last_pages, 0, 0, 0, s.n, 0, false FROM g, second s
UNION ALL SELECT 'head', pages - 1, nonempty_pages - 1, issues - s.n, announced_total, last_pages, 0, 0, 0, s.n, 0, false FROM g, first s
UNION ALL SELECT 'twice', pages + 1, nonempty_pages + 1, issues, announced_total, last_pages, 0, 1, 0, 0, s.n, false FROM g, second s
UNION ALL SELECT 'overlap', pages, nonempty_pages, issues, announced_total, last_pages, 0, 0, 0, 1, 1, false FROM g
"""


# --------------------------------------------------------------------------------------
# W1 W3 A6 -- hot groups split into ranges: NULL keys, ties, missing ordering values
# --------------------------------------------------------------------------------------
FEW_ROWS = SkewPolicy(rows_per_task=400, sample_per_range=20)


def q_hot_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A few users (one of them missing) have all the events; days are missing or shared by many.  Every group
    is cut into ranges of some 400 rows, whose numbers, lags and running maxima must join up."""
    ev = load(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 5).alias("user"), F.col("value"),
        F.when(F.col("event_id") % 7 != 0, F.date_trunc("day", F.col("ts").cast("timestamp"))).alias("day"))
    order = ["day", "event_id"]
    out = row_number_in_order(ev, ["user"], order, "row_no", "n_rows", policy=FEW_ROWS)
    out = lag_in_order(out, ["user"], order, "value", F.lit(-1.0), "value_before", policy=FEW_ROWS)
    out = running_max_in_order(out, ["user"], order, "value", "most_before", policy=FEW_ROWS)
    return out.select("event_id", F.col("row_no").cast("bigint").alias("row_no"), F.col("n_rows").cast("bigint").alias("n_rows"),
                      _r6(F.col("value_before")).alias("value_before"), _r6(F.col("most_before")).alias("most_before"))


_SQL_HOT_RANGES = """
WITH e AS (
  SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN user_id % 5 END AS u, value,
         CASE WHEN event_id % 7 <> 0 THEN date_trunc('day', ts) END AS day FROM events)
SELECT event_id, row_number() OVER w AS row_no, count(*) OVER (PARTITION BY u) AS n_rows,
       round(lag(value, 1, -1.0) OVER w, 6) AS value_before,
       round(max(value) OVER (PARTITION BY u ORDER BY day NULLS LAST, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS most_before
FROM e WINDOW w AS (PARTITION BY u ORDER BY day NULLS LAST, event_id)
"""


# --------------------------------------------------------------------------------------
# S3 S4 -- CSV sink round trip of whole texts (commas, quotes, newlines)
# --------------------------------------------------------------------------------------
DOC_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                         StructField("lang", StringType()), StructField("source", StringType())])


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S3 + S4: write whole documents as CSV with a run-summary row, read the CSV back."""
    base = shared_dir(spark, "csv")
    docs = load(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    info = write_with_summary(docs, f"{base}/report", f"{base}/runs", "tracker", "DOCS")
    if info["rows"] != spark.read.parquet(f"{base}/runs").first()["rows"]:
        raise RuntimeError("run summary does not match the rows written")
    return read_csv(spark, f"{base}/report", DOC_SCHEMA)


_SQL_CSV_ROUNDTRIP = "SELECT doc_id, text, lang, source FROM documents"


# --------------------------------------------------------------------------------------
# P6 A3 F14 -- columns by name pattern and range, text to number, distinct rows
# --------------------------------------------------------------------------------------
def q_select_patterns(spark: SparkSession, sf: str) -> DataFrame:
    s = load(spark, sf, "supplier")
    keys = matching(s, ends_with="key")                                     # s_suppkey, s_nationkey
    named = matching(s, regex="^s_(name|acct)")
    ranged = column_range(s, keys[0], keys[-1])                             # s_suppkey:s_nationkey, s_name between them
    both = s.select(*[c for c in ranged if c in keys or c in named])
    renamed = select_renamed(both, {"name": "s_name", "nation": keys[-1], "id": keys[0]})      # P1
    out = renamed.select(as_numeric(F.regexp_extract("name", r"(\d+)$", 1)).alias("number"),
                         as_numeric(F.col("name")).alias("not_a_number"),
                         as_character(F.col("nation")).alias("nation"))
    return out.select(F.pmod(F.col("number"), F.lit(10)).alias("last_digit"), "not_a_number", "nation").distinct()


_SQL_SELECT_PATTERNS = r"""
SELECT DISTINCT CAST(regexp_extract(s_name, '(\d+)$', 1) AS DOUBLE) % 10 AS last_digit,
       CAST(NULL AS DOUBLE) AS not_a_number, CAST(s_nationkey AS VARCHAR) AS nation
FROM supplier
"""


QUERIES: dict[str, Query] = {
    "select_patterns": q_select_patterns,
    "status_durations": q_status_durations,
    "status_no_change": q_status_no_change,
    "hoist_fields": q_hoist_fields,
    "hoist_all_join": q_hoist_all_join,
    "unnest_long": q_unnest_long,
    "unnest_keyed": q_unnest_keyed,
    "parallel_unnest": q_parallel_unnest,
    "dedup_names": q_dedup_names,
    "natural_full_join": q_natural_full_join,
    "indicator_matrix": q_indicator_matrix,
    "row_sum": q_row_sum,
    "unpivot_long": q_unpivot_long,
    "left_enrich": q_left_enrich,
    "exclude_keys": q_exclude_keys,
    "clean_strings": q_clean_strings,
    "dates_hours": q_dates_hours,
    "nan_fill": q_nan_fill,
    "drop_columns": q_drop_columns,
    "page_audit": q_page_audit,
    "hot_ranges": q_hot_ranges,
    "csv_roundtrip": q_csv_roundtrip,
}

ORACLE: dict[str, str] = {
    "status_durations": _SQL_STATUS_DURATIONS,
    "status_no_change": _SQL_STATUS_NO_CHANGE,
    "hoist_fields": _SQL_HOIST_FIELDS,
    "hoist_all_join": _SQL_HOIST_ALL_JOIN,
    "unnest_long": _SQL_UNNEST_LONG,
    "unnest_keyed": _SQL_UNNEST_KEYED,
    "parallel_unnest": _SQL_PARALLEL_UNNEST,
    "dedup_names": _SQL_DEDUP_NAMES,
    "natural_full_join": _SQL_NATURAL_FULL_JOIN,
    "select_patterns": _SQL_SELECT_PATTERNS,
    "indicator_matrix": _SQL_INDICATOR_MATRIX,
    "row_sum": _SQL_ROW_SUM,
    "unpivot_long": _SQL_UNPIVOT_LONG,
    "left_enrich": _SQL_LEFT_ENRICH,
    "exclude_keys": _SQL_EXCLUDE_KEYS,
    "clean_strings": _SQL_CLEAN_STRINGS,
    "dates_hours": _SQL_DATES_HOURS,
    "nan_fill": _SQL_NAN_FILL,
    "drop_columns": _SQL_DROP_COLUMNS,
    "page_audit": _SQL_PAGE_AUDIT,
    "hot_ranges": _SQL_HOT_RANGES,
    "csv_roundtrip": _SQL_CSV_ROUNDTRIP,
}
