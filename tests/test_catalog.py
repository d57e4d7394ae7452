"""Dictionary versions, unresolved names, field presence and the strict collapse on small pages."""

import json
import warnings

import pytest

from issuelens.plans.reports import (CSR, Col, ReportSpec, build_report, csr_columns, field_catalog, settle_issues, unresolved_columns)
from issuelens.sources.pages import pages_from_text


def bronze(spark, pages):
    rows = [(project, no, json.dumps({"names": names, "issues": [{"id": f"{project}{no}{i}", "key": f"{project}-{no}-{i}", "fields": f}
                                                                 for i, f in enumerate(fields)]})) for project, no, names, fields in pages]
    return settle_issues(pages_from_text(spark.createDataFrame(rows, "project string, page_no long, raw string"), page_col="page_no"))


def report(issues, *cols, project=None):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        rep = build_report(issues, field_catalog(issues), ReportSpec("r", (Col("k", "key"), *cols)), project)
    return {r[0]: tuple(r)[1:] if len(cols) > 1 else r[1] for r in rep.collect()}


def test_a_field_renamed_on_a_later_page_is_found_on_both(spark):
    issues = bronze(spark, [("P", 0, {"a": "Branch/Division", "b": "Other"}, [{"a": "a0", "b": "b0"}]),
                            ("P", 1, {"a": "Branch", "b": "Other"}, [{"a": "a1", "b": "b1"}])])
    assert report(issues, Col("B", "Branch/Division")) == {"P-0-0": "a0", "P-1-0": "a1"}
    assert report(issues, Col("B", "Branch")) == {"P-0-0": "a0", "P-1-0": "a1"}


def test_fields_that_swap_names_are_read_by_their_page(spark):
    issues = bronze(spark, [("P", 0, {"a": "X", "b": "Y"}, [{"a": "a0", "b": "b0"}]), ("P", 1, {"a": "Y", "b": "X"}, [{"a": "a1", "b": "b1"}]),
                            ("P", 2, {"c": "Z"}, [{"a": "a2", "b": "b2"}]), ("Q", 0, {"q": "X"}, [{"q": "q0", "a": "no"}])])
    assert report(issues, Col("X", "X"), Col("Y", "Y")) == {
        "P-0-0": ("a0", "b0"), "P-1-0": ("b1", "a1"), "P-2-0": ("b2", "a2"), "Q-0-0": ("q0", None)}      # a page without the name: as it was last


def test_duplicate_names_are_numbered_page_by_page(spark):
    issues = bronze(spark, [("P", 0, {"z": "Department", "a": "Department"}, [{"z": "z0", "a": "a0"}]), ("P", 1, {"a": "Department"}, [{"a": "a1"}])])
    assert report(issues, Col("D1", "Department-1"), Col("D2", "Department-2"), Col("D", "Department")) == {
        "P-0-0": ("z0", "a0", "a0"), "P-1-0": (None, "a1", "a1")}


def test_two_fields_of_one_page_that_read_alike_are_an_error(spark):
    issues = bronze(spark, [("P", 0, {"a": "Due date", "b": "Duedate"}, [{}])])
    with pytest.raises(ValueError, match="more than one field"):
        build_report(issues, field_catalog(issues), ReportSpec("r", (Col("D", "Duedate"),)))


def test_names_that_are_not_found_are_listed(spark):
    issues = bronze(spark, [("P", 0, {"a": "A"}, [{"a": "1"}]), ("Q", 0, {"b": "B"}, [{"b": "2"}])])
    spec = ReportSpec("r", (Col("a", "A"), Col("b", "B"), Col("c", "C")))
    catalog = field_catalog(issues)
    with pytest.warns(UserWarning, match="no field is called C"):
        build_report(issues, catalog, spec)
    assert sorted(map(tuple, unresolved_columns(catalog, spec).collect())) == [("P", "B"), ("P", "C"), ("Q", "A"), ("Q", "C")]
    assert [r.name for r in unresolved_columns(catalog, spec, "P").orderBy("name").collect()] == ["B", "C"]


def test_presence_and_columns_without_any_value(spark):
    issues = bronze(spark, [("P", 0, {"s": "Summary", "p": "Priority", "c": "CSM"}, [{"s": "x", "p": None, "c": {"displayName": None}}, {"s": None, "p": None}]),
                            ("Q", 0, {"s": "Summary", "p": "Priority"}, [{"s": ["l"], "p": {"name": "High"}}])])
    catalog = field_catalog(issues)
    got = {(r.project, r.field_id): (r.n, list(r.kinds)) for r in catalog.presence.collect()}
    assert got == {("P", "s"): (1, ["STRING"]), ("P", "c"): (1, ["OBJECT"]), ("Q", "s"): (1, ["ARRAY"]), ("Q", "p"): (1, ["OBJECT"])}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert set(csr_columns(issues, catalog, "P").columns) == {"IssueID", "IssueKey", "CSM", "Summary", "Changelog"}
        assert set(csr_columns(issues, catalog).columns) == {"IssueID", "IssueKey", "CSM", "Summary", "Priority", "Changelog"}
    assert {c.out for c in CSR.columns} > {"CSM"}


def test_strict_collapse_takes_the_width_of_the_page(spark):
    people = lambda *names: [{"displayName": n} for n in names]
    names = {"p": "People"}
    issues = bronze(spark, [("P", 0, names, [{"p": people("A", "B")}, {"p": people("A")}, {"p": []}, {"p": None}, {}, {"p": people("A", None)}, {"p": "text"}]),
                            ("P", 1, names, [{"p": people("C")}, {"p": []}]), ("P", 2, names, [{"p": []}, {"p": None}])])
    col = Col("s", "People", ("displayName",), how="strict")
    assert report(issues, col) == {"P-0-0": "A;B", "P-0-1": None, "P-0-2": None, "P-0-3": None, "P-0-4": None, "P-0-5": None, "P-0-6": None,
                                   "P-1-0": "C", "P-1-1": None, "P-2-0": "", "P-2-1": ""}
