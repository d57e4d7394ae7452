import datetime as dt
import math

from pyspark.sql import functions as F

from issuelens.functions import (days_between, hours_between, millis_to_minutes, nan_if_null, paste0, r_date,
                                 r_timestamp, strip_commas, trim_ws)
from issuelens.session import shared_dir, spread


def test_dates_and_instants(spark):
    rows = [("2025-08-18T09:12:33.123-0700",), ("2025-8-1",), ("not a date",), (None,), (" 2025-03-04 extra",)]
    df = spark.createDataFrame(rows, "s string")
    got = [(r.d, r.t) for r in df.select(r_date("s").alias("d"), r_timestamp("s").alias("t")).collect()]
    assert got[0] == (dt.date(2025, 8, 18), dt.datetime(2025, 8, 18, 16, 12, 33, 123000))   # date as written
    assert got[1][0] == dt.date(2025, 8, 1)
    assert got[2] == (None, None) and got[3] == (None, None)
    assert got[4][0] == dt.date(2025, 3, 4)


def test_durations(spark):
    df = spark.createDataFrame([("2025-01-01T00:00:00.000+0000", "2025-01-02T12:00:00.000+0000", 90000)],
                               "a string, b string, ms long")
    r = df.select(days_between(r_timestamp("b"), r_timestamp("a")).alias("d"),
                  hours_between(r_timestamp("b"), r_timestamp("a")).alias("h"),
                  hours_between(r_timestamp(F.lit(None).cast("string")), r_timestamp("a")).alias("open"),
                  millis_to_minutes("ms").alias("m")).first()
    assert (r.d, r.h, r.open, r.m) == (1.5, 36.0, None, 1.5)


def test_text_and_nan(spark):
    df = spark.createDataFrame([(" a,b \n", None)], "s string, x double")
    r = df.select(trim_ws(strip_commas("s")).alias("t"), nan_if_null("x").alias("n"),
                  paste0(F.lit("a"), F.lit("-"), F.col("s")).alias("p")).first()
    assert r.t == "ab" and math.isnan(r.n) and r.p == "a- a,b \n"


def test_shared_dir_follows_checkpoint_dir(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = shared_dir(spark, "x")
    assert base and path.startswith(base.rstrip("/")) and path != shared_dir(spark, "x")


def test_spread_only_widens_narrow_inputs(spark):
    cores = spark.sparkContext.defaultParallelism
    narrow = spark.range(100).coalesce(1)
    assert spread(narrow).rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores * 2)
    assert spread(wide) is wide


def test_paste0_prints_missing_parts_as_NA(spark):
    df = spark.createDataFrame([("a", None)], "s string, x string")
    assert df.select(paste0("s", F.lit("-"), "x").alias("p")).first().p == "a-NA"
