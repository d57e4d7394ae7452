"""Substring deduplication: words under a long passage that an earlier document has, too.

A window is ``window`` consecutive words.  Every window whose word sequence also stands in a
document with a smaller doc_id is removed, judged on the input; the union of such windows are
the maximal spans of matching statistic ``window`` or more.

Broadcasting a suffix automaton of every reference shard would make each document meet each
shard (work: shards x documents) although most share nothing; the README has the figures.
This operator finds the same spans in work that follows the input:

1. *Anchors.*  Of the grams of ``GRAM`` words inside a window the one with the smallest hash is
   its anchor, so equal windows have equal anchors at equal places.  Neighbouring windows with
   one anchor occurrence make a *run*; a task sends about one row (anchor, hash of the run's
   content, place) for 18 words.
2. *Runs.*  An aggregate, combined before the shuffle, gets for each (anchor, run) the smallest
   doc_id.  Documents after it lose the whole run.  An anchor whose documents all have one run
   is settled by that; only where an anchor has several runs, each run's first document sends
   the hashes of its windows.
3. *Windows.*  A second combined aggregate gets each window's smallest doc_id.
4. *Spans* go back to their documents by key and the words are cut there.

No group is ever gathered: hot runs and windows are summed map-side, and the joins back are
split by ``hot_split``.  Equality is equality of 64-bit hashes of the word sequences.

Defined results: rows with equal doc_id and text are one document, so a repeated row never
removes words from its twin; different texts under one doc_id are each compared with the
documents before that id.  Rows without a doc_id are neither compared nor cut.  NULL text
counts as empty; fewer than ``window`` words are never cut.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens.llm.text import ODD, WordHash, gram_hashes, hash_words, hot_split, in_arrow, mix, read_table, schema_of, with_id, written

WINDOW = 50
GRAM = 16
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ODD_INVERSE = pow(ODD, -1, 1 << 64)


class Spans:
    """Hashes of any span of a text's words in constant time: prefix sums in an odd base modulo 2^64."""

    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    def __init__(self, h: np.ndarray):
        if len(self.powers) <= len(h):
            n = 2 * len(h) + 1
            for name, base in (("powers", ODD), ("inverses", ODD_INVERSE)):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(type(self), name, np.cumprod(factors))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.inverses[: len(h)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.powers[start])


def runs(h: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Per run: anchor hash, content hash, first window, number of windows."""
    grams = gram_hashes(h, gram)
    inside = window - gram + 1
    n = len(h) - window + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, inside).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    size = np.diff(np.concatenate([first, [n]]))
    place = at[first]
    content = Spans(h).of(first, first + size + window - 1)
    content = mix(content + mix((place - first).astype(np.uint64) * np.uint64(1 << 20) + size.astype(np.uint64)))
    return grams[place], content, first, size


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind.value_type)).cast(kind)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, copy, text): copy tells texts under one doc_id apart."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).cast("binary").alias("text"))


def run_table(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, copy, anchor, run, first, size), one row per run of every document."""
    out = with_id(docs, "doc_id", "copy long, anchors array<long>, runs array<long>, firsts array<int>, sizes array<int>")
    schema = schema_of(out)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHash()
        none = (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
        for b in batches:
            made = []
            for t in b.column(2):
                words = (t.as_py() or b"").split()
                made.append(runs(hash_words(words, memory), window) if len(words) >= window else none)
            cols = [[m[i].view(np.int64) for m in made] for i in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[lists(c, f.type) for c, f in zip(cols, list(schema)[2:])]], schema=schema)

    made = in_arrow(docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()), go, out)
    return made.filter(F.size("runs") > 0)


def spans_of_runs(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans settled by whole runs, and the runs whose windows must be looked at."""
    each = table.select("doc_id", "copy", F.explode(F.arrays_zip(F.col("anchors").alias("anchor"), F.col("runs").alias("run"),
                                                                 F.col("firsts").alias("first"), F.col("sizes").alias("size"))).alias("x")) \
        .select("doc_id", "copy", "x.anchor", "x.run", "x.first", "x.size")
    by_run = each.groupBy("anchor", "run").agg(F.min("doc_id").alias("own"), F.max("doc_id").alias("last"), F.count("*").alias("n_left"))
    by_run = by_run.filter("own is not null")
    by_anchor = by_run.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("own").alias("lowest"), F.max("last").alias("highest")) \
        .filter("lowest < highest")
    wanted = written(by_run.join(by_anchor, "anchor").filter("own < last or kinds > 1")
                     .select("anchor", "run", "own", (F.col("kinds") > 1).alias("mixed"), "n_left"), "runs")
    found = written(hot_split(each, ["anchor", "run"], wanted)
                    .filter("own < doc_id or mixed").select("doc_id", "copy", "first", "size", (F.col("own") < F.col("doc_id")).alias("gone")), "found")
    return found.filter("gone").drop("gone"), found.filter(~F.col("gone")).drop("gone")


def spans_of_windows(docs: DataFrame, open_runs: DataFrame, window: int) -> DataFrame:
    """Spans (first, size 1) of single windows that an earlier document has."""
    out = with_id(docs, "doc_id", "copy long, firsts array<int>, windows array<long>")
    schema = schema_of(out)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHash()
        for b in batches:
            places, hashes = [], []
            for t, spans in zip(b.column(2), b.column(3)):
                h = hash_words(t.as_py().split(), memory)
                starts = np.unique(np.concatenate([np.arange(s["first"], s["first"] + s["size"]) for s in spans.as_py()]))
                places.append(starts)
                hashes.append(Spans(h).of(starts, starts + window).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists(places, schema.field(2).type), lists(hashes, schema.field(3).type)],
                                             schema=schema)

    todo = open_runs.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("first", "size")).alias("spans"))
    made = in_arrow(docs.join(todo, ["doc_id", "copy"]).select("doc_id", "copy", "text", "spans"), go, out)
    each = written(made, "windows").select("doc_id", "copy", F.explode(F.arrays_zip(F.col("firsts").alias("first"), F.col("windows").alias("window"))).alias("x")) \
        .select("doc_id", "copy", "x.first", "x.window")
    owners = written(each.groupBy("window").agg(F.min("doc_id").alias("own"), F.max("doc_id").alias("last"), F.count("*").alias("n_left"))
                     .filter("own < last").drop("last"), "owners")
    return hot_split(each, ["window"], owners).filter("own < doc_id").select("doc_id", "copy", "first", F.lit(1).alias("size"))


def removed_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, copy, spans) of a ``keyed`` table; a span is (first word, words)."""
    whole, open_runs = spans_of_runs(written(run_table(docs, window), "anchors"))
    every = whole.unionByName(spans_of_windows(docs, open_runs, window))
    return every.groupBy("doc_id", "copy").agg(
        F.collect_list(F.struct("first", (F.col("size") + (window - 1)).alias("size"))).alias("spans"))


def kept_mask(n: int, spans: list[dict] | None) -> np.ndarray:
    edges = np.zeros(n + 1, np.int64)
    for s in spans or ():
        edges[s["first"]] += 1
        edges[s["first"] + s["size"]] -= 1
    return edges.cumsum()[:-1] == 0


def cut(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """The text without the words of the spans (its other white space stays), words, words removed."""
    words = text.split()
    if not spans:
        return text, len(words), 0
    keep = kept_mask(len(words), spans)
    out, at = [], 0
    for m, ok in zip(WORD.finditer(text), keep):
        if ok:
            out.append(text[at : m.end()])
        elif at < m.start() and out and not out[-1].endswith((b" ", b"\n")):
            out.append(text[at : m.start()])
        at = m.end()
    out.append(text[at:])
    return b"".join(out), len(words), int((~keep).sum())


def with_spans(docs: DataFrame, text: str, doc_id: str, window: int) -> DataFrame:
    """(row, text, spans): every row of ``docs`` with what is to be cut from its text."""
    spans = removed_spans(keyed(docs, doc_id, text), window)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("doc_id"),
                       F.xxhash64(text).alias("copy"), F.col(text).cast("binary").alias("text"))
    return rows.join(spans, ["doc_id", "copy"], "left").select("row", "text", "spans")


def measured_cuts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by a space) of every row."""
    rows = with_spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "doc_id", window)
    out = with_id(docs, doc_id, "n_words long, n_removed long, kept_sha256 string")
    schema = schema_of(out)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for t, spans in zip(b.column(1), b.column(2)):
                words = (t.as_py() or b"").split()
                keep = words
                if spans.is_valid:
                    keep = [w for w, ok in zip(words, kept_mask(len(words), spans.as_py())) if ok]
                made.append((len(words), len(words) - len(keep), hashlib.sha256(b" ".join(keep)).hexdigest()))
            cols = list(zip(*made)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)

    return in_arrow(rows.select("row.doc_id", "text", "spans"), go, out)


def cut_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``docs`` with the passages cut from their texts; rows that lose all their words go.

    A column ``n_chars`` is brought up to date; all other columns stay as they are.
    """
    rows = with_spans(docs, text, doc_id, window)
    kind = T.StructType([T.StructField("row", docs.schema), *T.StructType.fromDDL("new binary, n_words long, n_removed long").fields])
    schema = schema_of(kind)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [cut(t.as_py() or b"", spans.as_py()) for t, spans in zip(b.column(1), b.column(2))]
            cols = list(zip(*made)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([b.column(0).cast(schema.field(0).type), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]],
                                             schema=schema)

    found = in_arrow(rows, go, kind).filter("n_removed = 0 or n_removed < n_words")
    new = F.when(F.col("n_removed") > 0, F.decode("new", "UTF-8")).otherwise(F.col(f"row.`{text}`"))

    def column(c: str):
        if c == text:
            return new.alias(c)
        if c == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length(new).cast(docs.schema[c].dataType)).otherwise(F.col("row.n_chars")).alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return found.select(*[column(c) for c in docs.columns])


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps once the 50-word windows of earlier documents are removed."""
    return measured_cuts(read_table(spark, sf_dir, "documents"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages are cut out, the rest of each document stays."""
    return cut_texts(docs)
