"""Metamorphic checks."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from issuelens.functions import days_between
from issuelens.operators.history import status_transitions
from issuelens.fixtures import landed_pages
from issuelens.operators.tables import option_values, spread
from issuelens.operators.names import q
from issuelens.plans.reports import SBP, AUDIENCES, field_catalog, history_items, option_matrix, sbp_report, settle_issues
from issuelens.sources.pages import pages_from_text

AS_OF = "2025-01-01 00:00:00"
STATUSES = ["InProgress", "Open"]


def _issues(spark, page_size):
    return settle_issues(pages_from_text(landed_pages(spark, SF_SMALL, page_size=page_size), "raw"))


def _report(spark, page_size):
    rep = sbp_report(_issues(spark, page_size), as_of=AS_OF)
    return sorted(tuple(r) for r in rep.select("IssueKey", "Status", "RequestParticipants", *STATUSES).collect())


def test_paging_does_not_change_the_report(spark):
    assert _report(spark, 100) == _report(spark, 37)


def test_durations_sum_to_last_transition(spark):
    issues = _issues(spark, 100)
    created = F.try_variant_get("fields", "$.created", "string")
    t = status_transitions(history_items(issues.select("key", "changelog", created.alias("Created"))), as_of=AS_OF)
    span = t.groupBy("IssueKey").agg(days_between(F.max("changed_at"), F.min("ticket_created")).alias("span"))
    rep = sbp_report(issues, as_of=AS_OF)
    statuses = rep.columns[len(SBP.columns):]
    assert len(statuses) == 4
    total = rep.select("IssueKey", sum(F.coalesce(q(c), F.lit(0.0)) for c in statuses))
    got = {r[0]: r[1] for r in total.collect()}
    want = {r.IssueKey: r.span for r in span.collect()}
    assert want and all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    assert all(got[k] == 0.0 for k in got if k not in want)         # no history: nothing counted


def test_row_wise_matrix_equals_the_exploded_form(spark):
    """The options read off the row against the reference's route: long rows, Blank rule, distinct, pivot."""
    issues = _issues(spark, 100).withColumnRenamed("id", "IssueKeyNumber")
    wide = option_matrix(issues, field_catalog(issues), "IssueKeyNumber", AUDIENCES)
    slots = None
    for n, field in enumerate(("customfield_10060", "customfield_10061")):
        values = F.try_variant_get("fields", f"$.{field}", "array<variant>")
        rows = issues.select("IssueKeyNumber", F.posexplode_outer(values).alias("at", "o")).select(
            "IssueKeyNumber", (F.coalesce("at", F.lit(0)) + 100 * n).alias("pos"), F.try_variant_get("o", "$.value", "string").alias("v"))
        slots = rows if slots is None else slots.unionByName(rows)
    long = option_values(slots, "IssueKeyNumber", "pos", "v")
    want = spread(long, "IssueKeyNumber", "Value", F.lit(1.0)).fillna(0.0)
    assert wide.columns == want.columns
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, want.collect()))
