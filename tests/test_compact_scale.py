"""What the merge of overlapping pulls keeps, and what it leaves on disk."""

import json
import os

from pyspark.sql import functions as F

from issuelens.session import shared_dir


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path.removeprefix("file://").removeprefix("file:")) for f in names if f.startswith("part-")]


def pages(spark, rows):
    """(pull, page_no, [(id, text)]) -> landed pages."""
    raw = [(p, n, json.dumps({"startAt": n * 10, "maxResults": 10, "names": {"s": "Summary"},
                              "issues": [{"id": i, "key": f"K-{i}", "fields": {"s": t}} for i, t in issues]})) for p, n, issues in rows]
    return spark.createDataFrame([("P", *r) for r in raw], "project string, pull string, page_no int, raw string")


def test_a_merge_keeps_one_copy_and_stores_it_packed(spark, monkeypatch):
    from issuelens.sources.pages import explode_issues, pages_from_text
    from issuelens.streaming import compact
    monkeypatch.setattr(compact, "OLDER_AT_ONCE", 1)            # buckets with replaced copies are merged one after the other
    made = []
    monkeypatch.setattr(compact, "shared_dir", lambda s, name: made.append(shared_dir(s, name)) or made[-1])
    table = shared_dir(spark, "packed")
    issues = lambda rows: explode_issues(pages_from_text(pages(spark, rows), "raw", page_col="page_no"), keep_names=True)
    # ids twice in a page, on two pages and in two pulls of one batch, and without an id
    compact.compact_batch(issues([("1", 0, [(str(i), f"old {i}") for i in range(20)] + [("3", "again 3"), (None, "none"), (None, "none 2")]),
                                  ("1", 1, [("4", "page 4")]), ("0", 2, [("5", "before 5")])]), table, 0, buckets=4)
    got = lambda: {r.id: r.s for r in compact.read_compacted(spark, table)
                   .select("id", F.try_variant_get("fields", "$.s", "string").alias("s")).collect()}
    want = {str(i): f"old {i}" for i in range(20)} | {"3": "again 3", "4": "page 4", None: "none 2"}
    assert got() == want and compact.read_compacted(spark, table).count() == 21
    compact.compact_batch(issues([("2", 0, [(str(i), f"new {i}") for i in range(15, 30)]), ("0", 1, [("6", "late 6"), (None, "late")])]), table, 1, buckets=4)
    want |= {str(i): f"new {i}" for i in range(15, 30)}
    assert got() == want and compact.read_compacted(spark, table).count() == 31
    assert not {"present", "_row"} & set(compact.read_compacted(spark, table).columns)
    live = compact.published(spark, table)[1]
    assert all(f.endswith(".zstd.parquet") for folder in compact.folders(table, live) for f in files(folder))
    assert made and not any(files(m) for m in made)             # a batch is not kept


def test_buckets_are_merged_in_groups():
    from issuelens.streaming.compact import groups_of
    assert groups_of([3, 1, 2, 0], {0: 5, 1: 5, 3: 20}, 10) == [[0, 1, 2], [3]]
    assert groups_of([0, 1], {}, 10) == [[0, 1]] and groups_of([0, 1], {0: 11, 1: 1}, 10) == [[0], [1]]


def test_rows_are_not_sorted_by_bucket_before_they_are_written(spark):
    """Spark falls back to a sort once as many files are open as the setting says."""
    from issuelens.session import unsorted_writes
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with unsorted_writes(spark, 16):
        assert int(spark.conf.get(key)) > 16
    assert spark.conf.get(key) == before
