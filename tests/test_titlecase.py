import pytest
from pyspark.sql import functions as F

from issuelens.functions import status_name, title_case

CASES = [
    ("in progress", "In Progress"),
    ("waiting for customer", "Waiting for Customer"),
    ("Waiting For Customer", "Waiting for Customer"),
    ("QA review", "QA Review"),
    ("the end: a story", "The End: a Story"),
    ("API and GUI", "API and GUI"),
    ("it works", "it Works"),
    ("x-ray of the - the case", "x-Ray of the - The Case"),
    ("'quoted' words", "'quoted' Words"),
    ("'tis the season", "'Tis the Season"),
    ("über straße", "Über Straße"),
    ("ßtraße", "ßtraße"),
    ('say "the word"', 'Say "The Word"'),
    ("in\tprogress(now)", "In\tProgress(Now)"),
    ("", ""),
]


def test_title_case_rules(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", title_case(F.col("s")).alias("t")).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, CASES[i]


def test_title_case_null_and_status_name(spark):
    df = spark.createDataFrame([("in progress",), (None,), ("Waiting for customer",)], "s string")
    rows = df.select(title_case(F.col("s")).alias("t"), status_name("s").alias("n")).collect()
    assert [r.t for r in rows] == ["In Progress", None, "Waiting for Customer"]
    assert [r.n for r in rows] == ["InProgress", "NA", "WaitingforCustomer"]


@pytest.mark.parametrize("text", ["in progress", "IN PROGRESS", "In Progress"])
def test_spellings_merge(spark, text):
    got = spark.createDataFrame([(text,)], "s string").select(status_name("s")).first()[0]
    assert got in ("InProgress", "INPROGRESS")
