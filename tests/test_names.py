"""Names that come from data: every label has a column of its own, found by its exact text."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from issuelens.operators.names import by_place, column_named, distinct_names, join_labels, labels, q
from issuelens.operators.tables import indicator_matrix, left_enrich, natural_full_join, row_sum
from issuelens.plans.reports import SBP, sbp_report
from issuelens.session import shared_dir
from issuelens.sources.pages import pages_from_text
from issuelens.sources.sinks import read_csv, write_csv, write_with_summary


def test_distinct_names_are_distinct_without_case_and_keep_what_they_can():
    assert distinct_names(["Email", "email", "", "a.b", "x`y"], ["KEY"]) == ["Email", "email.2", "(empty)", "a.b", "x`y"]
    assert distinct_names(["a", "A", "a.2", ""], ["(EMPTY)"]) == ["a", "A.3", "a.2", "(empty).2"]
    assert distinct_names(["key", "Key"], ["key"]) == ["key.2", "Key.3"]
    assert distinct_names([]) == []


def test_join_labels_take_suffixes_until_they_are_free():
    assert join_labels(["k"], ["k", "v", "w"], ["v", "z"]) == (["k", "v.x", "w"], ["v.y", "z"])
    assert join_labels(["k"], ["k", "v", "v.x"], ["v"]) == (["k", "v.x", "v.x.x"], ["v.y"])
    assert join_labels(["k"], ["k"], ["k"]) == (["k"], ["k.y"])


def test_left_join_names_and_missing_keys(spark):
    a = spark.createDataFrame([(1, "a", "q"), (None, "b", "q"), (3, "c", "q")], "k int, v string, V2 string")
    b = spark.createDataFrame([(1, "x", 1), (None, "y", 2), (3, "z", 3), (3, "zz", 4)], "k int, v string, v2 int")
    out = left_enrich(a, b, "k")
    assert out.columns == ["k", "v.x", "V2", "v.y", "v2.2"] and labels(out) == ["k", "v.x", "V2", "v.y", "v2"]
    assert column_named(out, "v2") == "v2.2"
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "a", "q", "x", 1), (None, "b", "q", None, None), (3, "c", "q", "z", 3), (3, "c", "q", "zz", 4)], key=str)
    assert (None, "b", "q", "y", 2) in [tuple(r) for r in left_enrich(a, b, "k", na_matches=True).collect()]


def test_natural_join_of_labels_that_differ_by_case(spark):
    a = by_place(spark.createDataFrame([(1, 2)], "a int, b int")).toDF("id", "Id")
    b = spark.createDataFrame([(1, 9)], "id int, c int")
    out = natural_full_join(a, b)
    assert labels(out) == ["id", "Id", "c"] and [tuple(r) for r in out.collect()] == [(1, 2, 9)]


AWKWARD = ["Email", "email", "", "Paper `A4`", "k"]


def test_matrix_sum_and_csv_of_awkward_options(spark):
    rows = [(str(i), o) for i, o in enumerate(AWKWARD)] + [("0", "email")]
    matrix = indicator_matrix(spark.createDataFrame(rows, "k string, Value string"), "k")
    assert sorted(labels(matrix)[1:]) == sorted(AWKWARD)
    for i, option in enumerate(AWKWARD):
        cell = q([n for n, f in zip(matrix.columns[1:], labels(matrix)[1:]) if f == option][0])
        assert sorted(r.k for r in matrix.where(cell == 1.0).collect()) == sorted({str(i), "0"} if option == "email" else {str(i)})
    assert {r.k: r.Count for r in row_sum(matrix, matrix.columns[1:]).collect()} == {"0": 2.0, "1": 1.0, "2": 1.0, "3": 1.0, "4": 1.0}
    path = shared_dir(spark, "awkward")
    write_csv(matrix.coalesce(1), path)
    first = [open(f).readline().rstrip("\n") for f in glob.glob(os.path.join(path, "part-*"))][0]
    assert first == ",".join(f'"{c}"' for c in labels(matrix))
    assert sorted(map(tuple, read_csv(spark, path, matrix.schema).collect())) == sorted(map(tuple, matrix.collect()))


def test_columns_that_no_name_tells_apart_are_written_by_place(spark):
    df = spark.range(1).select(F.lit(1).alias("v"), F.lit("a").alias("V"), F.lit("b").alias("v"))
    path = shared_dir(spark, "same")
    write_csv(df, path)
    assert "".join(open(f).read() for f in glob.glob(os.path.join(path, "part-*"))) == '"v","V","v"\n1,"a","b"\n'


def test_a_report_without_rows_is_its_header(spark):
    df = spark.range(10).select("id", F.lit("x").alias("Text `q`")).where("id > 100")
    path = shared_dir(spark, "empty")
    write_csv(df, path)
    assert "".join(open(f).read() for f in glob.glob(os.path.join(path, "part-*"))) == '"id","Text `q`"\n'
    assert read_csv(spark, path, df.schema).count() == 0
    base = shared_dir(spark, "empty-summary")
    assert write_with_summary(df, f"{base}/out", f"{base}/runs", "tracker", "NONE")["rows"] == 0


def test_a_status_called_like_a_report_column(spark):
    changes = [("Open", "Resolved", 2), ("Resolved", "Done", 5), ("Done", "IssueKey", 6), ("IssueKey", "Open", 7)]
    histories = ",".join(f'{{"created":"2025-01-0{d}T00:00:00.000+0000","items":[{{"field":"status","fromString":"{a}","toString":"{b}"}}]}}'
                         for a, b, d in changes)
    page = ('{"names":{"created":"Created","resolutiondate":"Resolved"},"issues":[{"id":"1","key":"K-1","fields":{"created":"2025-01-01T00:00:00.000+0000",'
            f'"resolutiondate":"2025-01-05"}},"changelog":{{"histories":[{histories}]}}}}]}}')
    pages = pages_from_text(spark.createDataFrame([("P", 0, page)], "project string, page_no long, raw string"), page_col="page_no")
    report = sbp_report(pages, as_of="2025-02-01 00:00:00")
    assert report.columns[0] == "IssueKey" and "Resolved.x" in report.columns and len(report.columns) == len(SBP.columns) + 4
    row = report.first().asDict()
    assert (row["Resolved.x"], row["Resolved.y"], row["Open"], row["Done"], row["IssueKey.y"]) == ("2025-01-05", 3.0, 1.0, 1.0, 1.0)
    path = shared_dir(spark, "sbp")
    write_csv(report, path)
    assert tuple(read_csv(spark, path, report.schema).first()) == tuple(report.first())


def test_an_exact_label_that_is_not_there_is_an_error(spark):
    with pytest.raises(ValueError, match="0 columns"):
        column_named(spark.range(1), "ID")
