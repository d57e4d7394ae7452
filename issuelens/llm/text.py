"""Small helpers shared by the operators: words, hashing inside tasks, written tables, hot keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from issuelens.session import shared_dir

# The contracts' word: a maximal run of bytes other than space and 0x09-0x0D.  In tasks,
# ``bytes.split()`` cuts at exactly these bytes (``str.split`` would cut at more).
WORD_REGEX = r"[^\x20\x09-\x0D]+"
# Rows per Arrow batch handed to Python.  Spark also ends a batch at 64 MB
# (spark.sql.execution.arrow.maxBytesPerBatch), so long texts do not pile up in a task.
ARROW_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with batches small enough for tables of texts."""
    spark = df.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return df.mapInArrow(fn, schema)


def written(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write a table into the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class WordHash(dict):
    """64-bit hash of a word, remembered; forgotten as a whole when the memory is full."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def hash_words(words: list[bytes], memory: WordHash) -> np.ndarray:
    return np.fromiter(map(memory.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and xor-shift), so that sums of hashes become hashes."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


ODD = 0x9E3779B97F4A7C15


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, from the words' hashes; empty with fewer words.

    A polynomial in an odd multiplier modulo 2^64, put together from grams of 1, 2, 4, ...
    words, so that long grams cost a few array operations.
    """
    size = len(h)
    if size < n:
        return h[:0]
    out, have, part, step = None, 0, h, 1
    while step <= n:
        if n & step:
            if out is None:
                out, have = part, step
            else:
                k = size - have - step + 1
                out, have = out[:k] * np.uint64(pow(ODD, step, 1 << 64)) + part[have : have + k], have + step
        if step * 2 <= n:
            k = size - 2 * step + 1
            part = part[:k] * np.uint64(pow(ODD, step, 1 << 64)) + part[step : step + k]
        step *= 2
    return mix(out)


def schema_of(spark_type: str | T.StructType) -> pa.Schema:
    """The Arrow schema of a Spark schema (DDL text or StructType)."""
    kind = T.StructType.fromDDL(spark_type) if isinstance(spark_type, str) else spark_type
    return to_arrow_schema(kind)


def with_id(docs: DataFrame, doc_id: str, ddl: str) -> T.StructType:
    """``doc_id`` of the input's own type, then the columns of ``ddl``."""
    return T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *T.StructType.fromDDL(ddl).fields])


def count_floor(df: DataFrame, count: str, most: int) -> int | None:
    """The least step of a logarithmic scale of ``count`` such that at most ``most`` rows reach it.

    ``steps_of(count) >= floor`` then picks the rows of the highest counts, whole steps at a
    time; None when even the highest step has too many rows, or there are none.
    """
    sizes = sorted(df.groupBy(steps_of(count).alias("s")).agg(F.count("*").alias("n")).collect(), reverse=True)   # a few thousand steps
    total, floor = 0, None
    for step, n in sizes:
        total += n
        if total > most:
            break
        floor = step
    return floor


def steps_of(count: str) -> Column:
    return F.floor(F.log2(count) * 64)


def held_out(doc_id: Column, modulus: int) -> Column:
    """The contracts' split: crc32 of doc_id as text leaves 2."""
    return F.crc32(doc_id.cast("string")) % modulus == 2


def hot_split(left: DataFrame, keys: list[str], right: DataFrame, how: str = "inner", share: int = 1000) -> DataFrame:
    """Join ``left`` to ``right`` (one row per key) where a few keys may hold most of ``left``.

    Keys with more than 1/``share`` of the rows of ``left`` are at most ``share`` many, so their
    rows of ``right`` are broadcast; every other key joins by shuffle, where no partition can
    get more than 1/``share`` of the rows from one key.  ``right`` must have a column
    ``n_left`` with the rows each key has in ``left`` (a sum its maker already knows).
    """
    total = right.agg(F.sum("n_left")).first()[0] or 0
    limit = max(1, total // share)
    hot = F.broadcast(right.filter(F.col("n_left") > limit).withColumn("is_hot", F.lit(True)))
    marked = left.join(hot.select(*keys, "is_hot"), keys, "left")
    to_hot = marked.filter("is_hot").drop("is_hot").join(hot.drop("is_hot", "n_left"), keys, "inner")
    rest = marked.filter("is_hot is null").drop("is_hot").join(
        right.filter(F.col("n_left") <= limit).drop("n_left"), keys, how)
    return to_hot.unionByName(rest)


def sql_crc32(number: str) -> str:
    """DuckDB SQL for the crc32 of a number's decimal text, which it has no function for (tests and oracles)."""
    byte = "list_reduce(list_prepend(xor(a, b) & 255, range(8)), lambda k, i: CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384::BIGINT) ELSE k >> 1 END)"
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: xor(a >> 8, {byte})), 4294967295::BIGINT)"
