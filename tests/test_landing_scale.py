"""What landed pages and their audit shuffle and keep on disk."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from issuelens.session import shared_dir


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path.removeprefix("file://").removeprefix("file:")) for f in names if f.startswith("part-")]


def test_landed_documents_are_gathered_where_they_are_made(spark):
    """Page offsets are looked up by the narrow rows: joined to the pages, they made the documents be shuffled."""
    from issuelens.fixtures import landed_pages
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")           # as for a table of many pages
    try:
        plan = landed_pages(spark, SF_SMALL, by_project=True)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set(key, before)
    gathered = max(i for i, line in enumerate(plan) if "collect_list" in line)
    assert not [line for line in plan[:gathered] if "Exchange" in line or "Join" in line]
    assert [line for line in plan[gathered:] if "Join" in line]


def test_audited_page_files_are_packed(spark, monkeypatch):
    from issuelens.plans import table_queries
    made = []
    monkeypatch.setattr(table_queries, "shared_dir", lambda s, name: made.append(shared_dir(s, name)) or made[-1])
    monkeypatch.setattr(table_queries, "PAGES_PER_FILE", 1)
    audit = table_queries.q_page_audit(spark, SF_SMALL).collect()
    assert len(audit) == 9 and len(made) == 1
    found = files(made[0])
    text = spark.read.text(made[0]).agg(F.sum(F.octet_length("value"))).first()[0]
    assert all(f.endswith(".txt.gz") for f in found) and sum(map(os.path.getsize, found)) < text / 5
    assert len(found) == spark.read.text(made[0]).count()       # a file is never more than PAGES_PER_FILE pages
