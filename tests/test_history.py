"""Time in status: the worked example of FIXTURES.md A.5 through the whole page pipeline,
plus the hot-issue split path against the plain window."""

import pytest
from pyspark.sql import functions as F

from issuelens.operators.history import status_durations, status_transitions, time_in_status
from issuelens.operators.sequence import SkewPolicy
from issuelens.plans.reports import field_catalog, history_items, sbp_report
from issuelens.sources.pages import explode_issues, read_pages

AS_OF = "2025-01-11 00:00:00"
EXPECTED = {
    "X-1": {"Open": 2.0, "InProgress": 3.5, "WaitingforCustomer": None},
    "X-2": {"Open": 10.0, "InProgress": None, "WaitingforCustomer": None},
    "X-3": {"Open": None, "InProgress": None, "WaitingforCustomer": None},
    "X-4": {"Open": 2.0, "InProgress": None, "WaitingforCustomer": 2.0},
}
STATUSES = ["InProgress", "Open", "WaitingforCustomer"]


def test_worked_example_from_pages(spark, pages_dir):
    pages = read_pages(spark, pages_dir)
    rep = sbp_report(pages, as_of=AS_OF)
    got = {r.IssueKey: {s: r[s] for s in STATUSES} for r in rep.collect()}
    assert got == EXPECTED


def test_report_columns_and_cleaning(spark, pages_dir):
    pages = read_pages(spark, pages_dir)
    rep = {r.IssueKey: r for r in sbp_report(pages, as_of=AS_OF).collect()}
    assert rep["X-1"].Summary == "Move desks"               # commas deleted, ends trimmed
    assert rep["X-1"].Department == "Finance"               # Department-1 of two "Department"s
    assert rep["X-2"].Department is None                    # JSON null
    assert rep["X-2"].Assignee is None                      # scalar where an object is expected
    assert rep["X-1"].RequestParticipants == "Ann;Bob"
    assert rep["X-2"].RequestParticipants == "Cy"
    assert rep["X-3"].RequestParticipants is None           # empty list
    assert rep["X-4"].RequestParticipants is None           # JSON null element
    assert rep["X-3"].Parent == "X-1" and rep["X-1"].Parent is None   # field only on page 2
    assert rep["X-1"].Organization == "Health"


def test_synthetic_row_rules(spark):
    rows = [
        ("A", "2025-01-01", "2025-01-02", "assignee", "x", "y", 0, 0),   # no status item -> synthetic
        ("B", "2025-01-01", "2025-01-02", "status", "Open", "Done", 0, 0),
        ("B", "2025-01-01", "2025-01-03", "assignee", "x", "y", 1, 0),
        ("C", "2025-01-01", "2025-01-02", None, "x", "y", 0, 0),          # unnamed item: R's NA -> no row
        ("C", "2025-01-01", "2025-01-03", "priority", "x", "y", 1, 0),
    ]
    items = spark.createDataFrame(rows, "IssueKey string, TicketCreated string, created string, item_field string, "
                                        "item_fromString string, item_toString string, history_pos int, item_pos int")
    t = status_transitions(items, as_of=AS_OF).collect()
    got = sorted((r.IssueKey, r.from_status, r.to_status) for r in t)
    assert got == [("A", "Open", "No-Change"), ("B", "Open", "Done")]


def test_ties_follow_document_order(spark):
    # Two status changes at the same instant: the first (by history then item position)
    # takes the elapsed time, the second gets zero -- and still appears as a column.
    rows = [("K", "2025-01-01", "2025-01-03", "status", "Open", "Review", 0, 0),
            ("K", "2025-01-01", "2025-01-03", "status", "Review", "Done", 0, 1)]
    items = spark.createDataFrame(rows, "IssueKey string, TicketCreated string, created string, item_field string, "
                                        "item_fromString string, item_toString string, history_pos int, item_pos int")
    r = time_in_status(items, as_of=AS_OF, statuses=["Open", "Review"]).first()
    assert (r.Open, r.Review) == (2.0, 0.0)


def test_hot_issue_split_matches_plain_window(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    t = ev.select(F.col("user_id").alias("IssueKey"), F.lit("2024-01-01").cast("timestamp").alias("ticket_created"),
                  F.col("ts").cast("timestamp").alias("changed_at"), F.lit("status").alias("field"),
                  F.col("event_type").alias("from_status"), F.lit(None).cast("string").alias("to_status"),
                  F.col("event_id").alias("_o0"))
    statuses = ["Click", "Error", "Purchase", "Signup", "View"]
    plain = status_durations(t, statuses=statuses).collect()
    policy = SkewPolicy(rows_per_task=7)
    split = status_durations(t, statuses=statuses, policy=policy).collect()

    def norm(rows):
        return sorted(tuple([r[0]] + [None if r[s] is None else round(r[s], 6) for s in statuses]) for r in rows)
    assert norm(plain) == norm(split)


def test_history_items_positions(spark, pages_dir):
    pages = read_pages(spark, pages_dir)
    catalog = field_catalog(pages)
    assert catalog.ids(["Department-1", "Department-2"]) == {"Department-1": "customfield_1",
                                                             "Department-2": "customfield_2"}
    issues = explode_issues(pages)
    items = history_items(issues.select("key", "changelog", F.lit("2025-01-01").alias("Created")))
    got = sorted((r.IssueKey, r.history_pos, r.item_pos, r.item_field) for r in items.collect())
    assert ("X-1", 1, 0, "status") in got and len([g for g in got if g[0] == "X-4"]) == 3
    assert not [g for g in got if g[0] == "X-3"]


def test_include_open_counts_current_status(spark, pages_dir):
    pages = read_pages(spark, pages_dir)
    statuses = ["Done", "InProgress", "No-Change", "Open", "WaitingforCustomer"]
    rep = {r.IssueKey: r for r in sbp_report(pages, as_of=AS_OF, statuses=statuses, include_open=True).collect()}
    assert rep["X-1"].Done == 4.5 and rep["X-1"].Open == 2.0      # Done since Jan 6 12:00
    assert rep["X-4"].Done == 6.0                                 # Done since Jan 5
    assert rep["X-2"]["No-Change"] == 0.0 and rep["X-2"].Open == 10.0


def test_spec_can_name_a_field_id(spark, pages_dir):
    from issuelens.plans.reports import Col, ReportSpec, build_report, field_catalog, settle_issues
    issues = settle_issues(read_pages(spark, pages_dir))
    spec = ReportSpec("ids", (Col("IssueKey", "key"), Col("Dept2", "id:customfield_2", ("value",)),
                              Col("Dept1", "Department-1", ("value",))), strip_name_spaces=False)
    got = {r.IssueKey: (r.Dept1, r.Dept2) for r in build_report(issues, field_catalog(issues), spec).collect()}
    assert got["X-1"] == ("Finance", "Legal")


def test_statuses_come_from_the_data_and_an_unlisted_one_is_an_error(spark, pages_dir):
    pages = read_pages(spark, pages_dir)
    found = sbp_report(pages, as_of=AS_OF)
    assert {"NoChange", "No-Change", "Open", "InProgress"} & set(found.columns)
    with pytest.raises(Exception, match="not listed"):
        sbp_report(pages, as_of=AS_OF, statuses=["Done"]).collect()


def test_days_in_the_row_equal_the_window_form(spark):
    """Three or more statuses, entries out of order, ties, unnamed items, no items: both forms agree."""
    import json
    import random
    from issuelens.operators.history import days_by_status
    rng = random.Random(5)
    docs = []
    for k in range(60):
        histories = []
        for _ in range(rng.randrange(0, 7)):
            items = [{"field": rng.choice(["status", "status", "priority", None]), "fromString": rng.choice(["open", "In progress", "WAITING for x", None]),
                      "toString": rng.choice(["Done", "open"])} for _ in range(rng.randrange(0, 3))]
            histories.append({"created": rng.choice([f"2025-01-0{rng.randrange(2, 9)}T0{rng.randrange(3)}:00:00.000+0000", "2025-01-05T00:00:00.000+0000"]),
                              "items": items})
        docs.append((f"K-{k}", json.dumps({"histories": histories}), "2025-01-01T00:00:00.000+0000"))
    log = spark.createDataFrame(docs, "key string, raw string, Created string").withColumn("changelog", F.parse_json("raw"))
    wide = time_in_status(history_items(log), as_of=AS_OF).collect()
    want = {r.IssueKey: {k: round(v, 9) for k, v in r.asDict().items() if k != "IssueKey" and v is not None} for r in wide}
    histories = F.try_variant_get("changelog", "$.histories", "array<variant>")
    from issuelens.functions.scalars import r_timestamp
    got = {r.key: {k: round(v, 9) for k, v in (r.d or {}).items()} for r in
           log.select("key", days_by_status(histories, r_timestamp(F.col("Created")), AS_OF).alias("d")).collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    assert len({s for v in got.values() for s in v}) >= 4
