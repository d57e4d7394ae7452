import json

from pyspark.sql import functions as F

from issuelens.sources.pages import explode_issues, latest_issue_version, page_audit, read_pages


def test_read_pages_and_explode(spark, pages_dir):
    pages = read_pages(spark, pages_dir)
    got = sorted((r.project, r.page_no) for r in pages.select("project", "page_no").collect())
    assert got == [("SBP", 0), ("SBP", 1), ("SBP", 2)]
    issues = explode_issues(pages)
    keys = sorted((r.page_no, r.issue_pos, r.key) for r in issues.collect())
    assert keys == [(0, 0, "X-1"), (0, 1, "X-2"), (1, 0, "X-3"), (1, 1, "X-4")]


def test_project_predicate_prunes_directories(spark, pages_dir):
    pages = read_pages(spark, pages_dir, project="SBP")
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "SBP" in plan
    assert read_pages(spark, pages_dir, project="NONE").count() == 0


def test_page_audit(spark, pages_dir):
    a = page_audit(read_pages(spark, pages_dir)).first()
    assert (a.pages, a.nonempty_pages, a.issues, a.last_pages, a.complete) == (3, 2, 4, 1, True)


def test_page_audit_sees_every_defect(spark, pages_dir):
    raw = read_pages(spark, pages_dir).select("project", "page_no", "raw")
    token = '{"nextPageToken":"t","issues":[{"id":"%s"}]}'
    rows = [("cut", 0, token % 1), ("cut", 1, (token % 2)[:20]), ("cut", 2, '{"issues":[{"id":"3"}]}'),
            ("gap", 0, token % 1), ("gap", 2, '{"issues":[{"id":"3"}]}'),
            ("twice", 0, token % 1), ("twice", 0, token % 1), ("twice", 1, '{"issues":[{"id":"3"}]}'),
            ("good", 0, token % 1), ("good", 1, '{"issues":[{"id":"3"}]}')]
    from issuelens.sources.pages import pages_from_text
    pages = pages_from_text(spark.createDataFrame(rows, raw.schema), page_col="page_no")
    got = {r.project: (r.issues, r.broken_pages, r.repeated_pages, r.missing_pages, r.complete) for r in page_audit(pages).collect()}
    assert got == {"cut": (2, 1, 0, 0, False), "gap": (2, 0, 0, 1, False), "twice": (2, 0, 1, 0, False), "good": (2, 0, 0, 0, True)}


def test_two_pulls_of_one_page_give_the_new_copy(spark):
    import json
    import os
    from issuelens.plans.reports import (Col, ReportSpec, build_report, field_catalog, read_bronze, settle_issues,
                                         write_bronze)
    from issuelens.session import shared_dir
    base = shared_dir(spark, "pulls")
    for pull, names, text in (("2025-01-01", {"s": "Summary"}, "old"), ("2025-01-02", {"s": "Summary", "t": "Topic"}, "new")):
        folder = os.path.join(base, "project=P", f"pull={pull}")
        os.makedirs(folder)
        issues = [{"id": str(i), "key": f"P-{i}", "fields": {"s": f"{text} {i}", "t": text}} for i in (1, 2)]
        with open(os.path.join(folder, "page-00001.json"), "w") as f:
            json.dump({"names": names, "issues": issues}, f)
    spec = ReportSpec("s", (Col("IssueKey", "key"), Col("Summary", "Summary"), Col("Topic", "Topic")))
    pages = read_pages(spark, base)
    want = [("P-1", "new 1", "new"), ("P-2", "new 2", "new")]
    issues = settle_issues(pages, overlapping_pulls=True)
    assert sorted(map(tuple, build_report(issues, field_catalog(issues), spec).collect())) == want
    write_bronze(pages, os.path.join(base, "bronze"))
    bronze = read_bronze(spark, os.path.join(base, "bronze"))
    assert sorted(map(tuple, build_report(bronze, field_catalog(bronze), spec).collect())) == want


def test_report_without_any_of_its_fields_fails(spark, pages_dir):
    import pytest
    from issuelens.plans.reports import Col, ReportSpec, build_report, field_catalog, settle_issues
    issues = settle_issues(read_pages(spark, pages_dir))
    with pytest.raises(ValueError, match="none of its fields"):
        build_report(issues, field_catalog(issues), ReportSpec("x", (Col("K", "key"), Col("N", "No such field"))))


def test_latest_issue_version(spark, pages_dir):
    issues = explode_issues(read_pages(spark, pages_dir))
    twice = issues.unionByName(issues.where(F.col("key") == "X-1").withColumn("page_no", F.lit(9).cast("bigint")))
    latest = latest_issue_version(twice)
    assert latest.count() == 4
    assert latest.where(F.col("key") == "X-1").first().page_no == 9


def test_overlapping_pulls_keep_the_latest_copy(spark):
    import os
    from conftest import FIXTURES
    from issuelens.plans.reports import sbp_report, settle_issues
    pages = read_pages(spark, os.path.join(FIXTURES, "repull"))
    assert explode_issues(pages).count() == 5                      # X-1 landed twice
    issues = settle_issues(pages, overlapping_pulls=True)
    rep = {r.IssueKey: r for r in sbp_report(issues, as_of="2025-01-11 00:00:00").collect()}
    assert len(rep) == 4 and rep["X-1"].Summary == "Move desks again" and rep["X-1"].Open == 2.0


def test_json_lines_landing_reads_the_same_pages(spark, pages_dir):
    import glob
    import json
    import os
    from issuelens.session import shared_dir
    base = os.path.join(shared_dir(spark, "lines"), "project=SBP")
    os.makedirs(base)
    with open(os.path.join(base, "pages.jsonl"), "w") as out:
        for f in sorted(glob.glob(os.path.join(pages_dir, "project=SBP", "*.json"))):
            out.write(json.dumps(json.load(open(f))) + "\n")
    lines = read_pages(spark, os.path.dirname(base), one_page_per_line=True)
    whole = read_pages(spark, pages_dir)
    key = lambda df: sorted((r.project, r.page_no, r.issue_pos, r.key) for r in explode_issues(df).collect())
    assert key(lines) == key(whole) and lines.count() == 3


def audited(spark, rows, **kwargs):
    from issuelens.sources.pages import pages_from_text
    pages = pages_from_text(spark.createDataFrame(rows, "project string, page_no long, raw string"), page_col="page_no")
    return {r.project: r for r in page_audit(pages, **kwargs).collect()}


def offset_page(start, ids, total=9):
    import json
    return json.dumps({"startAt": start, "maxResults": 4, "total": total, "issues": [{"id": str(i)} for i in ids]})


def test_audit_sees_a_lost_first_page(spark):
    token, last = '{"nextPageToken":"t","issues":[{"id":"%s"}]}', '{"issues":[{"id":"%s"}]}'
    rows = [("tokens", 1, token % 1), ("tokens", 2, last % 2), ("offsets", None, offset_page(4, range(4, 9)))]
    got = audited(spark, rows)
    assert (got["tokens"].missing_pages, got["tokens"].complete) == (1, False)
    assert (got["offsets"].missing_issues, got["offsets"].missing_pages, got["offsets"].complete) == (4, 0, False)
    assert audited(spark, rows[:2], first_page=1)["tokens"].complete
    assert audited(spark, [("o", 0, offset_page(1, range(8), 9))], first_offset=1)["o"].missing_issues == 0


def test_audit_of_pages_whose_sizes_change(spark):
    pages = {"good": [(0, range(4)), (4, range(4, 6)), (6, range(6, 9))], "hole": [(0, range(4)), (5, range(5, 9))],
             "overlap": [(0, range(4)), (3, range(3, 9))], "inside": [(0, range(9)), (2, range(2, 4))], "tail": [(0, range(4))],
             "empty end": [(0, range(9)), (9, [])], "too many": [(0, range(10))]}
    got = audited(spark, [(name, None, offset_page(a, ids)) for name, of in pages.items() for a, ids in of])
    found = {n: (r.missing_issues, r.overlapping_issues, r.repeated_pages, r.last_pages, r.complete) for n, r in got.items()}
    assert found == {"good": (0, 0, 0, 1, True), "hole": (1, 0, 0, 1, False), "overlap": (0, 1, 0, 1, False), "inside": (0, 2, 1, 1, False),
                     "tail": (5, 0, 0, 0, False), "empty end": (0, 0, 0, 1, True), "too many": (0, 0, 0, 1, False)}


def test_audit_is_the_same_where_projects_are_split_into_ranges(spark):
    import random
    from issuelens.operators.sequence import SkewPolicy
    rng = random.Random(3)
    starts = [s for s in range(0, 400, 4) if rng.random() < 0.8] + [rng.randrange(400) for _ in range(20)]
    rows = [("P", None, offset_page(s, range(s, s + 4), 400)) for s in starts] + [(None, None, offset_page(s, range(s, s + 3), 400)) for s in starts]
    plain = audited(spark, rows)
    assert plain == audited(spark, rows, policy=SkewPolicy(rows_per_task=10, sample_per_range=20))
    covered = {i for s in starts for i in range(s, s + 4)}
    assert plain["P"].missing_issues == len(set(range(400)) - covered) and plain["P"].issues == len(covered)


def test_a_page_is_parsed_once(spark):
    from issuelens.sources.pages import pages_from_text
    pages = spark.createDataFrame([("P", '{"startAt":0,"maxResults":2,"issues":[{"id":"1","fields":{"a":[1,2],"b":{"c":1},"d":null,"e":"x","f":1.5,"g":true}},'
                                         '{"id":"2","fields":{"a":[],"h":[3]}}]}')], "project string, raw string")
    issues = explode_issues(pages_from_text(pages), keep_names=True)
    plan = issues._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1
    first, second = issues.orderBy("id").collect()
    assert {e.id: e.kind for e in first.present} == {"a": "ARRAY", "b": "OBJECT", "e": "STRING", "f": "DECIMAL", "g": "BOOLEAN"}
    assert first.widths == second.widths == {"a": 2, "h": 1} and {e.id: e.kind for e in second.present} == {"a": "ARRAY", "h": "ARRAY"}


def test_landing_shuffles_rows_and_not_documents(spark):
    from issuelens.fixtures import landed_pages
    for by_project in (False, True):
        plan = landed_pages(spark, "/root/testdata/sf0.001", by_project)._jdf.queryExecution().sparkPlan().toString().split("\n")
        made = [i for i, line in enumerate(plan) if "to_json" in line.lower() or "structstojson" in line.lower()]
        dealt = [i for i, line in enumerate(plan) if "REPARTITION_BY_NUM" in line]
        assert made and dealt and max(made) < min(dealt)


def test_kinds_are_worked_out_issue_by_issue_and_widths_on_the_page(spark):
    """Before, every issue's kinds were worked out in the page's row, which copied the whole page several times."""
    from issuelens.sources.pages import pages_from_text

    def page(*fields):
        return json.dumps({"startAt": 0, "maxResults": 9, "names": {"a": "A"},
                           "issues": [{"id": str(n), "key": f"K-{n}", **({} if f is None else {"fields": f})} for n, f in enumerate(fields)]})

    raw = [("P", page({"a": [1, {"x": 2}, None], "b": [], "c": None, "d": {}, "e": "t", "f": 1, "g": 1.5, "h": True, "i": 1e300},
                      {"a": [1], "b": [[1], [2]], "d": [{}]}, None, {})),
           ("Q", page()), ("R", page(None)), ("S", "not json")]
    issues = explode_issues(pages_from_text(spark.createDataFrame(raw, "project string, raw string"), "raw"), keep_names=True)
    got = {(r["project"], r["id"]): (dict(tuple(e) for e in r["present"]), r["widths"], r["names"]) for r in issues.collect()}
    widths = {"a": 3, "b": 2, "d": 1}
    names = '{"a":"A"}'
    assert {k: v[1] for k, v in got.items()} == {**{("P", str(n)): widths for n in range(4)}, ("R", "0"): {}}
    assert {k: v[2] for k, v in got.items()} == {("P", "0"): names, ("P", "1"): None, ("P", "2"): None, ("P", "3"): None, ("R", "0"): names}
    assert got[("P", "0")][0] == {"a": "ARRAY", "b": "ARRAY", "d": "OBJECT", "e": "STRING", "f": "BIGINT", "g": "DECIMAL", "h": "BOOLEAN", "i": "DOUBLE"}
    assert got[("P", "1")][0] == {"a": "ARRAY", "b": "ARRAY", "d": "ARRAY"}
    assert got[("P", "2")][0] == got[("P", "3")][0] == got[("R", "0")][0] == {}
    plan = issues._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.lower().split("generate posexplode")
    assert "schemaofvariant" in above and "schemaofvariant" not in below


def test_the_bronze_table_holds_variants_whole_and_no_kinds(spark):
    """Before, every issue was taken apart and built again when it was written, and its kinds were stored."""
    import pyarrow.parquet as pq

    from issuelens.operators.fields import field_presence
    from issuelens.plans.reports import settle_issues
    from issuelens.sources.pages import pages_from_text
    fields = [{"a": [1], "b": {"x": 1}, "c": None}, {"a": "t", "b": {"x": 2}}, None, {}]
    pages = [json.dumps({"startAt": 4 * n, "maxResults": 4, "names": {"a": "A"}, "issues": [
        {"id": 4 * n + i, "key": f"K-{i}", "fields": f, "changelog": {"histories": []}} for i, f in enumerate(fields)] + [None, 7]}) for n in range(3)]
    exploded = explode_issues(pages_from_text(spark.createDataFrame([("P", p) for p in pages], "project string, raw string")), keep_names=True)
    bronze = settle_issues(pages_from_text(spark.createDataFrame([("P", p) for p in pages], "project string, raw string")))
    written = {c.name for f in bronze.inputFiles() for c in pq.read_schema(f.removeprefix("file://")).field("fields").type}
    assert written == {"value", "metadata"} and "present" not in bronze.columns
    want = {"a": (6, ["ARRAY", "STRING"]), "b": (6, ["OBJECT"])}
    for rows in (bronze, exploded, exploded.withColumn("present", F.when(F.col("issue_pos") > 0, F.col("present")))):
        assert {r.field_id: (r.n, r.kinds) for r in field_presence(rows).collect()} == want
    got = sorted((r.page_no, r.issue_pos, r.id, r.key) for r in bronze.collect())
    assert got[:6] == [(0, 0, "0", "K-0"), (0, 1, "1", "K-1"), (0, 2, "2", "K-2"), (0, 3, "3", "K-3"), (0, 4, None, None), (0, 5, None, None)] and len(got) == 18
