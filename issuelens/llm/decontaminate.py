"""Benchmark decontamination: short test items found inside long documents, DataFrame functions only.

Words are runs of letters and digits, lower-cased; shingles are five consecutive words, as a
set.  An item is in a document when at least ``least`` of its shingles are in the document.

*Size-partitioned MinHash search.*  A document is far larger than an item, so a signature of
the document says little about the item; the search therefore is one-sided.  Items are
partitioned by their number of shingles into classes [2^j, 2^(j+1)), and the sketch of an item
is its k smallest shingle hashes (a bottom-k MinHash), with k = u - ceil(least * u) + 1 for the
largest size u of the class.  A document that holds ``least`` of the item misses fewer than k of
its shingles, so it holds one of the sketch: the search loses nothing.  Documents are
partitioned by size as well: those with fewer shingles than the smallest item of a class would
need never meet that class.

*Verification.*  The shingles, as text, of the documents that have a candidate are joined with
the shingles of the items; the count against the item's size is the exact containment.

Defined results: items or documents with fewer than five words, empty or NULL text have no
shingles and no hits.  Rows with the same item_id are one item, their shingles pooled.  Rows
with the same doc_id are searched text by text and reported once, with the best containment.
Rows without an id are neither searched nor found.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.llm.text import read_table, written

SHINGLE_WORDS = 5
LEAST = 0.8
TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def grams(words: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` every five consecutive words, as an array.

    The words are bound to a lambda variable by the outer ``transform``: an expression named
    inside a lambda would be evaluated anew for each of its elements.
    """
    def each(w: Column) -> Column:
        starts = F.when(F.size(w) >= SHINGLE_WORDS, F.sequence(F.lit(1), F.size(w) - (SHINGLE_WORDS - 1))) \
            .otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: of(F.slice(w, i, SHINGLE_WORDS)))

    return F.element_at(F.transform(F.array(words), each), 1)


def joined(gram: Column) -> Column:
    return F.array_join(gram, " ")


def item_shingles(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, shingle) of the items."""
    named = items.filter(F.col(item_id).isNotNull() & F.col(text).isNotNull()) \
        .select(F.col(item_id).alias("item_id"), tokens(F.col(text)).alias("w"))
    return named.select("item_id", F.explode(grams(F.col("w"), joined)).alias("shingle")).distinct()


def sketches(shingles: DataFrame, least: float = LEAST) -> DataFrame:
    """(item_id, hash, needs): the bottom-k sketch of every item, and the shingles a document must have."""
    sized = shingles.groupBy("item_id").agg(
        F.array_sort(F.collect_set(F.xxhash64(F.split("shingle", " ")))).alias("hashes"), F.count("*").alias("n_item"))
    low = F.pow(F.lit(2), F.floor(F.log2("n_item"))).cast("int")
    high = low * 2 - 1
    k = high - F.ceil(F.lit(least) * high).cast("int") + 1
    return sized.select("item_id", F.ceil(F.lit(least) * low).alias("needs"),
                        F.explode(F.slice("hashes", F.lit(1), k)).alias("hash"))


def searchable(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, copy, words): copy tells texts under one doc_id apart."""
    named = docs.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
    return named.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text"))


def candidates(docs: DataFrame, sketch: DataFrame) -> DataFrame:
    """Distinct (doc_id, copy, item_id) where the document is large enough and holds a sketch value."""
    hashes = docs.select("doc_id", "copy", tokens(F.col("text")).alias("w")) \
        .select("doc_id", "copy", (F.size("w") - (SHINGLE_WORDS - 1)).alias("n_grams"),
                F.explode(grams(F.col("w"), F.xxhash64)).alias("hash"))
    return hashes.join(sketch, (hashes["hash"] == sketch["hash"]) & (F.col("n_grams") >= F.col("needs"))) \
        .select("doc_id", "copy", "item_id").distinct()


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, n_item, n_found, containment) of every item found in a document."""
    shingles = item_shingles(items)
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("n_item"))
    named = searchable(docs, doc_id, text)
    pairs = written(candidates(named, sketches(shingles, least)), "candidates")
    found = named.join(pairs.select("doc_id", "copy").distinct(), ["doc_id", "copy"], "left_semi") \
        .select("doc_id", "copy", F.explode(grams(tokens(F.col("text")), joined)).alias("shingle")) \
        .join(shingles, "shingle").distinct() \
        .groupBy("doc_id", "copy", "item_id").agg(F.count("*").alias("n_found"))
    return found.join(pairs, ["doc_id", "copy", "item_id"]).join(sizes, "item_id").filter(F.col("n_found") >= least * F.col("n_item")) \
        .groupBy("doc_id", "item_id", "n_item").agg(F.max("n_found").alias("n_found")) \
        .withColumn("containment", F.col("n_found") / F.col("n_item"))


def op8_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains."""
    return contained(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that contain no benchmark item."""
    hits = contained(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(hits, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


OP8_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM benchmark WHERE text IS NOT NULL),
item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(words[p:p+4], ' ') AS s
  FROM (SELECT item_id, words, unnest(range(1, len(words) - 3)) AS p FROM i WHERE len(words) >= 5)),
doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p+4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM w WHERE len(words) >= 5)),
sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY 1),
found AS (SELECT doc_id, item_id, count(*) AS n_found FROM doc_shingles JOIN item_shingles USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment
FROM found JOIN sizes USING (item_id) WHERE n_found >= 0.8 * n_item
"""
