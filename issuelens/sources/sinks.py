"""Report sinks: CSV for the BI tool, and a run-summary row."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType, StructField, StructType,
                               TimestampType)

from issuelens.operators.columns import NESTED_TYPES
from issuelens.operators.names import by_place, label_of, labels, named

# As R's write.csv: text is quoted (quotes doubled), numbers, dates and missing values are not;
# a missing value is NA.  A reader that, like R's, takes NA for missing cannot tell the text
# NA from a missing value; the file can, by its quotes.
READ_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "nullValue": "NA",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def flat_for_csv(df: DataFrame) -> DataFrame:
    """CSV cannot hold nested columns: nested ones are written as JSON text.  Columns are taken by place."""
    placed = by_place(df)
    cols = []
    for f, c in zip(df.schema.fields, placed.columns):
        text = F.to_json(c) if isinstance(f.dataType, NESTED_TYPES) else F.col(c)
        cols.append(named(text, f.name, label_of(f)))
    return placed.select(*cols)


def csv_header(df: DataFrame) -> str:
    """The header record: the columns' exact labels, quoted."""
    return ",".join('"' + c.replace('"', '""') + '"' for c in labels(df))


def csv_lines(df: DataFrame) -> DataFrame:
    """One text column: the CSV records, the first of each partition led by the header."""
    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    cells, placed = [], by_place(df)
    for f, name in zip(df.schema.fields, placed.columns):
        c = F.col(name)
        if isinstance(f.dataType, BooleanType):
            c = F.upper(c.cast("string"))
        cells.append(F.coalesce(quoted(c) if isinstance(f.dataType, StringType) else c.cast("string"), F.lit("NA")))
    # the lower 33 bits of this id number the rows of a partition from 0
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    record = F.concat_ws(",", *cells)
    return placed.select(F.when(first, F.concat(F.lit(csv_header(df) + "\n"), record)).otherwise(record).alias("value"))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S3 ``write.csv(x, path, row.names = FALSE)``: header, quoted text, NA for missing, ``"``
    doubled, embedded newlines allowed.  One file per task; the folder is the report.  A report
    without rows is its header."""
    flat = flat_for_csv(df)
    csv_lines(flat).write.mode(mode).text(path)
    spark = df.sparkSession
    if spark.read.text(path).isEmpty():      # reads no further than the first line
        spark.createDataFrame([(csv_header(flat),)], "value string").coalesce(1).write.mode("append").text(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a report written by :func:`write_csv` back with its schema."""
    reader = spark.read.schema(schema)
    for k, v in READ_OPTIONS.items():
        reader = reader.option(k, v)
    return reader.csv(path)


SUMMARY_SCHEMA = StructType([
    StructField("api", StringType()), StructField("project", StringType()),
    StructField("event", StringType()), StructField("rows", LongType()),
    StructField("seconds", DoubleType()), StructField("at", TimestampType()),
])


def write_with_summary(df: DataFrame, path: str, summary_path: str, api: str, project: str,
                       mode: str = "errorifexists") -> dict:
    """S3 + S4: write the report and append one run-summary row.

    The row count comes from an ``Observation`` on the written DataFrame, so counting
    costs no second pass over the data.
    """
    obs = Observation(f"rows_{project}")
    started = time.time()
    write_csv(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, mode=mode)
    rows = int(obs.get["rows"])
    seconds = round(time.time() - started, 2)
    spark = df.sparkSession
    summary = spark.createDataFrame(
        [(api, project, "success", rows, float(seconds), datetime.now(timezone.utc))], SUMMARY_SCHEMA)
    summary.write.mode("append").parquet(summary_path)
    return {"rows": rows, "seconds": seconds}
