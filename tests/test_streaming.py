import os
import shutil

from issuelens.plans.reports import sbp_report
from issuelens.session import shared_dir
from issuelens.streaming.ingest import ingest_issues

AS_OF = "2025-01-11 00:00:00"


def test_incremental_ingest_then_batch_report(spark, pages_dir):
    base = shared_dir(spark, "stream")
    landing = os.path.join(base, "landing", "project=SBP")
    os.makedirs(landing)
    src = os.path.join(pages_dir, "project=SBP")
    bronze, ckpt = os.path.join(base, "bronze"), os.path.join(base, "ckpt")

    shutil.copy(os.path.join(src, "page-00001.json"), landing)
    ingest_issues(spark, os.path.join(base, "landing"), bronze, ckpt).awaitTermination()
    assert spark.read.parquet(bronze).count() == 2

    for name in ("page-00002.json", "page-00003.json"):      # later pages land
        shutil.copy(os.path.join(src, name), landing)
    ingest_issues(spark, os.path.join(base, "landing"), bronze, ckpt).awaitTermination()
    issues = spark.read.parquet(bronze)
    assert sorted(r.key for r in issues.collect()) == ["X-1", "X-2", "X-3", "X-4"]   # each page once

    rep = {r.IssueKey: (r.Open, r.InProgress) for r in
           sbp_report(issues, as_of=AS_OF).collect()}
    assert rep["X-1"] == (2.0, 3.5) and rep["X-2"] == (10.0, None) and rep["X-3"] == (None, None)


def _page(path, ids, text, names=None):
    import json
    os.makedirs(os.path.dirname(path), exist_ok=True)
    issues = [{"id": str(i), "key": f"P-{i}", "fields": {"s": f"{text} {i}", "t": f"topic {i}"}} for i in ids]
    with open(path, "w") as f:
        json.dump({"names": names or {"s": "Summary", "t": "Topic"}, "issues": issues}, f)


def test_batches_keep_one_row_an_issue_and_reports_scan_it(spark):
    from issuelens.plans.reports import Col, ReportSpec, build_report, field_catalog
    from issuelens.streaming.compact import ingest_latest, published, read_compacted
    base = shared_dir(spark, "compact")
    landing, table, ckpt = (os.path.join(base, x) for x in ("landing", "table", "ckpt"))
    pull = lambda n: os.path.join(landing, "project=P", f"pull={n}", "page-00000.json")
    _page(pull("2025-01-01"), range(40), "old")
    ingest_latest(spark, landing, table, ckpt, buckets=8).awaitTermination()
    first = published(spark, table)
    assert first[0] == 8 and set(first[1].values()) == {0} and read_compacted(spark, table).count() == 40
    _page(pull("2025-01-02"), [3, 4, 40], "new", {"s": "Title", "t": "Summary"})
    ingest_latest(spark, landing, table, ckpt, buckets=8).awaitTermination()
    touched = {b for b, v in published(spark, table)[1].items() if v == 1}
    assert 0 < len(touched) <= 3                                   # the other buckets are as they were
    issues = read_compacted(spark, table)
    spec = ReportSpec("s", (Col("IssueKey", "key"), Col("Summary", "Summary")))
    report = build_report(issues, field_catalog(issues), spec)
    assert "Exchange" not in report._jdf.queryExecution().executedPlan().toString()
    got = {r.IssueKey: r.Summary for r in report.collect()}
    assert len(got) == 41 and report.count() == 41
    assert got["P-5"] == "old 5" and got["P-3"] == "topic 3" and got["P-40"] == "topic 40"    # each row by its page's names


def test_a_batch_run_again_gives_the_same_table(spark, pages_dir):
    from issuelens.sources.pages import explode_issues, read_pages
    from issuelens.streaming.compact import compact_batch, published, read_compacted
    import pytest
    table = os.path.join(shared_dir(spark, "again"), "table")
    issues = explode_issues(read_pages(spark, pages_dir), keep_names=True)
    with pytest.raises(ValueError, match="nothing is published"):
        read_compacted(spark, table)
    for version in (0, 1, 1):
        compact_batch(issues.where("page_no = 0" if version == 0 else "page_no >= 0"), table, version, buckets=2)
    compact_batch(issues.where("false"), table, 2, buckets=2)
    assert sorted(r.key for r in read_compacted(spark, table).collect()) == ["X-1", "X-2", "X-3", "X-4"]
    assert max(published(spark, table)[1].values()) == 1
