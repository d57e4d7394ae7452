import pytest
from pyspark.sql import functions as F

from issuelens.operators.columns import (SUFFIX_PATTERN, across, column_range, drop_all_null, drop_nested,
                                         matching, mutate_after, rename_regex, select_renamed)
from issuelens.operators.explode import keyed_to_record, parallel_unnest, unnest_keyed, unnest_longer
from issuelens.operators.fields import disambiguate
from issuelens.operators.sequence import SkewPolicy
from issuelens.operators.tables import (indicator_matrix, natural_full_join, option_values, row_sum,
                                        unpivot_long)


def test_natural_full_join_null_matches_null(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "p", "y")], "k int, n string, a string")
    b = spark.createDataFrame([(1, None, 10.0), (3, "q", 30.0)], "k int, n string, extra double")
    out = natural_full_join(a.select("k", "n"), b)
    got = sorted((r.k, r.n, r.extra) for r in out.collect())
    assert got == [(1, None, 10.0), (2, "p", None), (3, "q", 30.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_multiselect_indicator_matrix(spark):
    docs = [("I1", '[{"value": "A"}, {"value": "B"}]'), ("I2", '[]'), ("I3", '[{"other": 1}, {"value": "A"}]'),
            ("I4", '[{"value": "A"}, {"value": "A"}]'), ("I5", 'null')]
    df = spark.createDataFrame(docs, "k string, j string").select("k", F.parse_json("j").alias("v"))
    long = unnest_longer(df, "v", values_to="opt", pos_to="pos", keep_empty=True) \
        .select("k", F.coalesce(F.col("pos"), F.lit(0)).alias("pos"),
                F.try_variant_get("opt", "$.value", "string").alias("val"))
    m = indicator_matrix(option_values(long, "k", "pos", "val"), "k", ["A", "B", "Blank"])
    got = {r.k: (r.A, r.B, r.Blank) for r in m.collect()}
    assert got == {"I1": (1.0, 1.0, 0.0), "I2": (0.0, 0.0, 1.0), "I3": (1.0, 0.0, 1.0),
                   "I4": (1.0, 0.0, 0.0), "I5": (0.0, 0.0, 1.0)}
    s = {r.k: r.Count for r in row_sum(m, ["A", "B", "Blank"]).collect()}
    assert s == {"I1": 2.0, "I2": 1.0, "I3": 2.0, "I4": 1.0, "I5": 1.0}


def test_row_sum_null_propagates(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    assert [r.Count for r in row_sum(df, ["a", "b"]).collect()] == [None, 3.0]


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "x", None)], "id int, a string, b string")
    got = sorted([(r.name, r.value) for r in unpivot_long(df, ["id"], ["a", "b"]).collect()], key=str)
    assert got == [("a", "x"), ("b", None)]


def test_keyed_unnest_and_back(spark):
    df = spark.createDataFrame([(1, '{"created": "t1", "items": [1, 2], "author": "z"}')], "id int, j string") \
        .select("id", F.parse_json("j").alias("h"))
    kv = unnest_keyed(df, "h", "column", "values")
    assert sorted(r.column for r in kv.collect()) == ["author", "created", "items"]
    rec = keyed_to_record(kv.where(F.col("column").isin("created", "items")), ["id"], "column", "values",
                          ["created", "items"]).first()
    assert len(rec.created) == 1 and len(rec["items"]) == 1


def test_parallel_unnest_pads_shorter(spark):
    df = spark.createDataFrame([(1, '["a", "b", "c"]', '[10]')], "id int, x string, y string") \
        .select("id", F.parse_json("x").alias("x"), F.parse_json("y").alias("y"))
    out = parallel_unnest(df, ["x", "y"]).select("pos", F.try_variant_get("x", "$", "string").alias("x"),
                                                   F.try_variant_get("y", "$", "int").alias("y"))
    assert [tuple(r) for r in out.orderBy("pos").collect()] == [(0, "a", 10), (1, "b", None), (2, "c", None)]


def test_disambiguate_in_key_order_and_split(spark):
    rows = [("P", "f9", "Department", 0), ("P", "f1", "Department", 1), ("P", "f2", "Team", 2),
            ("Q", "f3", "Department", 0)]
    d = spark.createDataFrame(rows, "project string, field_id string, display string, pos int")
    for policy in (SkewPolicy(), SkewPolicy(rows_per_task=1)):
        got = {r.field_id: r.name for r in disambiguate(d, policy=policy).collect()}
        assert got == {"f9": "Department-1", "f1": "Department-2", "f2": "Team", "f3": "Department"}


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, [1.0], "x", None, "v")], "id int, emb array<double>, label_value string, "
                                                            "note_text string, Status_val string")
    assert matching(df, starts_with="LABEL") == ["label_value"]
    assert column_range(df, "emb", "note_text") == ["emb", "label_value", "note_text"]
    out = mutate_after(df, "dim", F.size("emb"), after="id")
    assert out.columns[:2] == ["id", "dim"]
    out = rename_regex(drop_all_null(drop_nested(out)), SUFFIX_PATTERN, "")
    assert out.columns == ["id", "dim", "label", "Status"]
    up = across(out, F.upper, ["label"]).first()
    assert up.label == "X"


def test_select_renamed_odd_names(spark):
    df = spark.createDataFrame([(1, "a", "b")], "`Ministry/BPS Organization` int, `Do you have a floor plan?` string, `ΣProgress` string")
    out = select_renamed(df, {"Organization": "Ministry/BPS Organization", "FloorPlan": "Do you have a floor plan?",
                              "TotalProgress": "ΣProgress", "Organization ": "Ministry/BPS Organization"})
    assert out.columns == ["Organization", "FloorPlan", "TotalProgress", "Organization "]
    assert tuple(out.first()) == (1, "a", "b", 1)


def test_indicator_columns_come_from_the_data(spark):
    from issuelens.operators.tables import indicator_matrix
    options = spark.createDataFrame([(1, "A"), (2, "NEW"), (2, "A")], "k int, Value string")
    assert sorted(map(tuple, indicator_matrix(options, "k").collect())) == [(1, 1.0, 0.0), (2, 1.0, 1.0)]
    with pytest.raises(Exception, match="not listed: NEW"):
        indicator_matrix(options, "k", ["A"]).collect()
    assert indicator_matrix(options.limit(0), "k").count() == 0


def test_missing_duplicate_names_are_numbered_as_NA(spark):
    rows = [("P", "f1", None, 0), ("P", "f2", None, 1), ("P", "f3", "Only", 2)]
    d = spark.createDataFrame(rows, "project string, field_id string, display string, pos int")
    assert {r.field_id: r.name for r in disambiguate(d).collect()} == {"f1": "NA-1", "f2": "NA-2", "f3": "Only"}


def test_dictionary_survives_missing_page_numbers_and_orders_by_pull(spark):
    from issuelens.operators.fields import project_dictionary
    rows = [("P", None, None, 0, "f1", "Old"), ("P", "2", 0, 0, "f1", "New"), ("P", "1", 9, 0, "f1", "Older"), ("P", None, None, 1, "f2", "Kept")]
    e = spark.createDataFrame(rows, "project string, pull string, page_no long, pos int, field_id string, display string")
    assert {r.field_id: r.display for r in project_dictionary(e).collect()} == {"f1": "New", "f2": "Kept"}


def test_catalog_clashes_and_projects(spark):
    from issuelens.operators.fields import FieldCatalog
    rows = [("P", "cf1", "Summary"), ("Q", "cf2", "Summary"), ("P", "a", "Due date"), ("P", "b", "Duedate")]
    catalog = FieldCatalog(spark.createDataFrame(rows, "project string, field_id string, name string"))
    assert catalog.ids(["Summary"], project="P") == {"Summary": "cf1"}
    assert catalog.sources(["Summary"]) == {"Summary": {"cf1": ["P"], "cf2": ["Q"]}}
    with pytest.raises(ValueError, match="different field"):
        catalog.ids(["Summary"])
    with pytest.raises(ValueError, match="more than one field"):
        catalog.ids(["Duedate"], strip_spaces=True)
