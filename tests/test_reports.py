"""Report specs of the other projects on small landed pages."""

import datetime as dt
import os

from conftest import FIXTURES

from issuelens.plans.reports import (CSR, GPOPR, RBAS, build_report, field_catalog, finish_csr, finish_gpopr,
                                     finish_rbas, settle_issues)
from issuelens.sources.pages import read_pages

REPORTS = os.path.join(FIXTURES, "reports")
EXCLUDED = ["RBAS-1", "RBAS-2", "RBAS-3", "RBAS-4", "RBAS-5", "RBAS-6"]


def _issues(spark, project):
    return settle_issues(read_pages(spark, REPORTS, project=project))


def test_rbas_minutes_exclusion_and_instants(spark):
    issues = _issues(spark, "RBAS")
    rep = finish_rbas(build_report(issues, field_catalog(issues), RBAS), excluded=EXCLUDED)
    rows = {r.IssueKey: r for r in rep.collect()}
    assert set(rows) == {"RBAS-7", "RBAS-8"}                     # test ticket removed
    r7 = rows["RBAS-7"]
    assert r7.MinutesToResolution == 1.5 and rows["RBAS-8"].MinutesToResolution is None
    assert r7.Created == dt.datetime(2025, 8, 18, 16, 12, 33, 123000)   # offset kept as an instant (UTC)
    assert (r7.Organization, r7.RequestType, r7.Status, r7.StatusCategory) == ("Health", "Relocation", "Closed", "Done")
    assert (r7.RPDBranch, r7.MYSCReq, r7.Assignee, r7.Reporter) == ("Leasing", "MY-12", "Ann", "Bob")
    cols = rep.columns
    assert "TimeToResolution" not in cols and cols.index("MinutesToResolution") == cols.index("Resolution") + 1


def test_gpopr_participants_and_dates(spark):
    issues = _issues(spark, "GPOPR")
    rep = {r.IssueKey: r for r in finish_gpopr(build_report(issues, field_catalog(issues), GPOPR)).collect()}
    g1, g2 = rep["GPOPR-1"], rep["GPOPR-2"]
    assert g1.RequestParticipants == "Ann;Bob" and g2.RequestParticipants is None
    assert g1.Created == dt.date(2025, 3, 4)                  # the date as written, not the UTC date
    assert g2.Created == dt.date(2025, 3, 6) and g1.Duedate == dt.date(2025, 4, 1)
    assert (g1.GPOPackageApprover, g1.GPOSubtype, g1.City, g1.RequestType) == ("Cy", "Lease", "Victoria", "Package")


def test_csr_intended_report(spark):
    issues = _issues(spark, "CSR")
    r = finish_csr(build_report(issues, field_catalog(issues), CSR)).first()
    assert (r.Description, r.PIN, r.TotalProgress, r.CSM, r.CSRIssueSubtype) == ("Renew, please", "ARE-9", 3.0, "Eve", "Renewal")
    assert r.ProjectEffectiveDate == dt.date(2025, 6, 1)
    assert r.Resolved - r.Created == dt.timedelta(days=1)
    assert r.Organization is None                               # field not in this project


def test_com_issues_header_cleanup(spark):
    from issuelens.plans.reports import COM, finish_com
    issues = _issues(spark, "COM")
    rep = finish_com(build_report(issues, field_catalog(issues), COM))
    assert rep.columns == ["IssueKeyNumber", "IssueKey", "Priority", "AssigneeName", "Resolved", "Frequency",
                           "Initial Target Date", "RequestType", "Summary", "IssueType", "Reporter", "CreatorName",
                           "Created", "Description", "RPD Branch", "RequireCommsPlan", "CommunicationLead",
                           "TopicOfCommunication", "Status"]
    rows = {r.IssueKey: r for r in rep.collect()}
    c1, c2 = rows["COM-1"], rows["COM-2"]
    assert (c1.Priority, c1.Frequency, c1.Description, c1["RPD Branch"], c1.Status) == \
        ("High", "Weekly", "Plan it", "Leasing", "Done")
    assert c1.Created == dt.date(2025, 1, 15) and c1["Initial Target Date"] == dt.date(2025, 3, 1)
    assert c2.Frequency is None and c2.Created == dt.date(2025, 1, 20)
