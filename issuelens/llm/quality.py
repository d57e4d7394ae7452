"""Quality rules: lines that many documents of a host share are removed, depleted documents rejected.

A task reads every text once and keeps one row per document: the base figures, and for each
distinct normalised line (A-Z lower-cased, white space runs to one space) its 64-bit hash and
how many words of the text stand in such lines.  That small table is written to the shared
folder; the lines are counted per host by a map-side combined aggregate (a line is counted once
a row, so the count is the number of distinct documents), and only lines that more than
``max_docs`` documents of the host have go on, whatever the size of the host.  A hot line or host
is never gathered: the join back is split by ``hot_split``.

A document is depleted when fewer than ``min_words`` words or less than ``min_left`` of its
words are left after the removal.

Defined results: every row of the input is a document of its own, repeated rows and NULL
doc_id included (rows are told apart by a row number, not by doc_id).  NULL text counts as
empty: zeros, ``base_failed``.  A NULL host is a host.  Lines without a word are never removed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens.llm.text import WordHash, gram_hashes, hash_words, hot_split, in_arrow, read_table, schema_of, with_id, written

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
MAX_DOCS = 20
MIN_LEFT = 0.5
SYMBOL = re.compile(rb"[#*$%&|<>]")


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found at least twice in the text."""
    grams = gram_hashes(hashes, window)
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(grams, twice))
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((edges.cumsum()[:-1] > 0).sum())


def figures(text: bytes, memory: WordHash) -> tuple:
    """The base figures of a text, and per distinct normalised line its hash and words."""
    lines = text.split(b"\n")
    lines_words: Counter = Counter()
    seen: set[bytes] = set()
    words: list[bytes] = []
    duplicates = 0
    for line in lines:
        of_line = line.split()
        if not of_line:
            continue
        words += of_line
        duplicates += line in seen
        seen.add(line)
        lines_words[b" ".join(of_line).lower()] += len(of_line)
    # code points: every byte but the continuation bytes of UTF-8
    joined = np.frombuffer(b"".join(words), np.uint8)
    chars = int(((joined & 0xC0) != 0x80).sum())
    keys = [xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in lines_words]
    return (len(words), chars, len(SYMBOL.findall(text)), duplicates,
            repeated_words(hash_words(words, memory)), keys, list(lines_words.values()))


FIGURES = ("host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "line_keys array<long>, line_words array<long>")


def measured(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: row_no, doc_id, host, base figures, distinct line hashes and their words."""
    out = with_id(docs, doc_id, FIGURES)
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHash()
        for b in batches:
            rows = list(zip(*[figures(t.as_py() or b"", memory) for t in b.column(2)])) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(r, f.type) for r, f in zip(rows, list(schema)[2:])]], schema=schema)

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).cast("binary").alias("text"))
    return in_arrow(narrow, run, out).withColumn("row_no", F.monotonically_increasing_id())


def shared_lines(rows: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, line, n_left): lines above the limit, with the number of documents that have them."""
    lines = rows.select("host", F.explode("line_keys").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n_left"))
    return lines.filter(F.col("n_left") > max_docs)


def judged(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id", max_docs: int = MAX_DOCS,
           min_words: int = MIN_WORDS, min_left: float = MIN_LEFT) -> DataFrame:
    """Figures and verdict per row of ``docs``, with the hashes of the lines to remove."""
    rows = written(measured(docs, text, host, doc_id), "lines")
    named = rows.withColumn("host", F.coalesce(F.concat(F.lit("="), "host"), F.lit("null")))   # joins need a value
    shared = written(shared_lines(named, max_docs), "shared")
    each = named.select("row_no", "host", F.explode(F.arrays_zip(F.col("line_keys").alias("line"), F.col("line_words").alias("words"))).alias("x")) \
        .select("row_no", "host", "x.line", "x.words")
    removed = hot_split(each, ["host", "line"], shared) \
        .groupBy("row_no").agg(F.sum("words").alias("n_removed"), F.collect_list("line").alias("removed_lines"))
    both = rows.drop("line_keys", "line_words").join(removed, "row_no", "left")
    left = F.col("n_words") - F.coalesce("n_removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    depleted = (left < min_words) | (left < min_left * F.col("n_words"))
    return both.select("row_no", "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
                       F.coalesce("n_removed", F.lit(0)).alias("n_removed_words"),
                       F.coalesce("removed_lines", F.array().cast("array<long>")).alias("removed_lines"))


def without_lines(text: bytes | None, removed: set[int]) -> bytes | None:
    """A text less the lines whose normalised hash is in ``removed``."""
    if text is None or not removed:
        return text
    return b"\n".join(x for x in text.split(b"\n")
                      if not x.split() or xxhash.xxh3_64_intdigest(normal_line(x)) - (1 << 63) not in removed)


def cleaned(docs: DataFrame, shared: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` with the shared lines (host, line) taken out of their texts; all columns kept.

    A row travels as one struct, so no column of the input can clash.  Each row gets the removed
    hashes of its host's lines through one join by row; texts are cut in Arrow batches.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = written(docs.select(row, F.monotonically_increasing_id().alias("row_no")), "numbered")
    flat = rows.select("row_no", F.col("row")[text].alias("text"), F.col("row")[host].alias("host"))
    keys = measured(flat, "text", "host", "row_no").select(F.col("doc_id").alias("row_no"), "host", F.explode("line_keys").alias("line"))
    named = keys.withColumn("host", F.coalesce(F.concat(F.lit("="), "host"), F.lit("null")))
    hit = hot_split(named, ["host", "line"], shared).groupBy("row_no").agg(F.collect_list("line").alias("removed"))
    out = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("cut", T.StringType())])
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [without_lines(t.as_py(), set(r.as_py() or ())) for t, r in zip(b.column(1), b.column(2))]
            cut = [None if t is None else t.decode(errors="replace") for t in cut]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cut, pa.string())], schema=schema)

    both = rows.join(hit, "row_no", "left").select("row", F.col("row")[text].cast("binary").alias("text"), "removed")
    return in_arrow(both, run, out).select(*[(F.col("cut") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


def op2_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures, and the line-frequency verdict, of every document."""
    found = judged(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "n_removed_words")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, 'null') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, words FROM d WHERE len(words) >= 8),
w AS (SELECT doc_id, i, array_to_string(words[i:i+7], ' ') AS gram FROM windows),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM w) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY 1),
lines AS (
  SELECT doc_id, host, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d)),
full_lines AS (
  SELECT doc_id, host, line, len(lw) AS n,
         translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM lines WHERE len(lw) > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY 1),
shared AS (SELECT host, norm FROM full_lines GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > 20),
removed AS (SELECT doc_id, sum(n) AS n FROM full_lines JOIN shared USING (host, norm) GROUP BY 1),
base AS (
  SELECT d.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, coalesce(removed.n, 0) AS n_removed
  FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND n_words - n_removed >= 20 AND n_words - n_removed >= 0.5 * n_words AS kept,
       n_removed::BIGINT AS n_removed_words
FROM judged
"""
