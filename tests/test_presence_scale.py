"""Which fields have values, asked for a few of them."""

import json

from pyspark.sql import functions as F


def test_empty_fields_are_found_without_the_kinds_of_all_fields(spark):
    from issuelens.operators.fields import fields_with_values
    from issuelens.plans.reports import field_catalog, settle_issues
    from issuelens.sources.pages import explode_issues, pages_from_text
    raw = json.dumps({"startAt": 0, "maxResults": 9, "names": {"a.b": "A", "n": "N", "e": "E", "x": "X"},
                      "issues": [{"id": "1", "fields": {"a.b": None, "n": None, "e": []}}, {"id": "2", "fields": {"a.b": "v", "n": None}}, {"id": "3"}]})
    text = spark.createDataFrame([("P", raw), ("Q", raw.replace('"v"', "null"))], "project string, raw string")
    bronze = settle_issues(pages_from_text(text, "raw"))
    exploded = explode_issues(pages_from_text(text, "raw"), keep_names=True)
    for issues in (bronze, exploded, exploded.withColumn("present", F.when(F.col("id") == "1", F.col("present")))):
        catalog = field_catalog(issues)
        listed = {r.field_id for r in catalog.presence.collect()}
        assert fields_with_values(issues, ["a.b", "e", "n", "x"]) == listed == {"a.b", "e"} and fields_with_values(issues, []) == set()
        catalog.presence = None         # nothing is looked up there
        assert catalog.empty_fields(["a.b", "e", "n", "x"]) == {"n", "x"}
        assert catalog.empty_fields(["a.b", "e"], project="Q") == {"a.b"} and catalog.empty_fields(["e"], project="none") == {"e"}
