import os

from pyspark.sql.types import LongType, StringType, StructField, StructType

from issuelens.session import shared_dir
from issuelens.sources.sinks import read_csv, write_csv, write_with_summary

SCHEMA = StructType([StructField("id", LongType()), StructField("text", StringType())])


def test_csv_round_trip_keeps_commas_quotes_newlines(spark):
    rows = [(1, 'a, "quoted"\nsecond line'), (2, ""), (3, None), (4, "  padded  ")]
    df = spark.createDataFrame(rows, SCHEMA)
    path = shared_dir(spark, "csv-test")
    write_csv(df, path)
    back = sorted(tuple(r) for r in read_csv(spark, path, SCHEMA).collect())
    assert back == [(1, 'a, "quoted"\nsecond line'), (2, ""), (3, None), (4, "  padded  ")]


def test_nested_columns_are_written_as_json(spark):
    df = spark.sql("select 1L as id, named_struct('a', 1) as s")
    path = shared_dir(spark, "csv-nested")
    write_csv(df, path)
    back = read_csv(spark, path, SCHEMA).first()
    assert back.text == '{"a":1}'


def test_run_summary_appends_one_row(spark):
    df = spark.range(5).selectExpr("id", "cast(id as string) as text")
    base = shared_dir(spark, "summary")
    info = write_with_summary(df, os.path.join(base, "out"), os.path.join(base, "runs"), "tracker", "SBP")
    assert info["rows"] == 5
    runs = spark.read.parquet(os.path.join(base, "runs")).collect()
    assert len(runs) == 1 and runs[0].rows == 5 and runs[0].project == "SBP"


def test_text_is_quoted_and_missing_is_not(spark):
    import glob
    df = spark.createDataFrame([(1, "NA"), (2, None), (3, ""), (4, 'a "b"')], SCHEMA).coalesce(1)
    path = shared_dir(spark, "csv-quotes")
    write_csv(df, path)
    text = "".join(open(f).read() for f in glob.glob(os.path.join(path, "part-*")))
    assert text == '"id","text"\n1,"NA"\n2,NA\n3,""\n4,"a ""b"""\n'
