"""Toxicity by two class-conditional Kneser-Ney models that share their backoff counts.

A word (A-Z lower-cased, cut at space and 0x09-0x0D) is spelt byte by byte, all of its bytes and an
end.  The model of a class c gives the next byte x after the bytes
h of a word so far

    P_c(x | h) = (max(n_c(hx) - D, 0) + back_c(h) * P_shared(x | h)) / (n_c(h) + STRENGTH)
    back_c(h)  = STRENGTH + D * (bytes seen after h in c) + (occurrences in c of rare hx)

and the mass that discounting, the strength and rare expressions leave goes to P_shared: an
interpolated Kneser-Ney model of the same context over both classes together, whose lower
orders (up to ``LOW`` bytes, anywhere in a word) are continuation counts.  An hx seen fewer than
``RARE`` times in both classes counts as rare, so a rare expression tells nothing that is not
known of its class's more frequent beginnings: after a rare beginning both classes use the
shared model, which cancels in their ratio.

A toxic text is mostly ordinary words, so its likelihood is that of ordinary words with a share
``TOXIC_SHARE`` of words from the toxic model; the ordinary likelihood has ordinary words only.
The two are compared per word (length-normalised):

    ratio(text) = mean over words of ln(1 - s + s * P_toxic(word) / P_ordinary(word))

and ``score`` is a logistic function of arcsinh(ratio / s), whose border is the value with the
best F1, and whose slope the likeliest, on labelled rows that the counts did not see.

*Fitting* takes a bounded sample of labelled rows, ``LABELLED_ROWS`` of them, picked by a hash
of doc_id (all when there are fewer); three quarters are counted in Spark, one quarter sets
border and slope.  The model that goes to the tasks holds at most ``MAX_PREFIXES`` beginnings
of words (above that, those of the highest counts).  Every document is then scored whole.

Defined results: NULL and empty texts, and texts without words, have a ratio of 0.  Every row is
scored on its own, repeated rows and NULL doc_id included; a NULL doc_id is not held out.  A
document with several labels is toxic when one says so; NULL labels are none.  Without labelled
rows of both classes in both parts every score is 0.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuelens.llm.text import count_floor, in_arrow, mix, read_table, schema_of, steps_of, with_id, written

SPELT = 12                     # lengths of prefixes that are counted in the first round; each round doubles them
CELLS = 1 << 24                # bytes of words that are looked up at once
DISCOUNT = 0.75
STRENGTH = 50.0
RARE = 5
LOW = 4
TOXIC_SHARE = 0.01
LABELLED_ROWS = 50_000
MAX_PREFIXES = 2_000_000
WORDS_KEPT = 200_000           # words whose ratio a task remembers, and words it counts before it sends them on
END = b" "
BASE = np.uint64(0x9E3779B97F4A7C15)


def spelt(word: bytes) -> bytes:
    """What the models see of a word: all of its bytes and the end."""
    return word + END


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def spellings(rows: DataFrame) -> DataFrame:
    """(spelling, n_toxic, n_ordinary) of the rows (text, toxic): map-side combined counts."""
    ddl = "spelling binary, n_toxic long, n_ordinary long"
    schema = schema_of(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def send() -> pa.RecordBatch:
            keys = list(set(seen[0]).union(seen[1]))
            got = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *[pa.array([seen[c][k] for k in keys], pa.int64()) for c in (1, 0)]],
                                             schema=schema)
            for s in seen:
                s.clear()
            return got

        for b in batches:
            for t, toxic in zip(b.column(0), b.column(1)):
                words = words_of(t.as_py())
                for at in range(0, len(words), WORDS_KEPT):
                    seen[toxic.as_py()].update(map(spelt, words[at : at + WORDS_KEPT]))
                    if len(seen[0]) + len(seen[1]) > WORDS_KEPT:
                        yield send()
        yield send()

    return in_arrow(rows.select(F.col("text").cast("binary").alias("text"), F.col("toxic").cast("int").alias("toxic")), run, ddl) \
        .groupBy("spelling").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary"))


def head(column: str, n) -> Column:
    return F.substring(F.col(column), F.lit(1), n)


def tail(column: str, n) -> Column:
    """The last ``n`` bytes."""
    return F.substring(F.col(column), F.length(column) - n + 1, n)


def prefix_counts(spelled: DataFrame, rare: int = RARE) -> DataFrame:
    """(prefix, n_toxic, n_ordinary): how often words begin with each prefix of the spellings.

    Words have any length: they are counted in rounds, of prefixes of up to ``SPELT`` bytes, twice as many and
    so on, and a spelling goes on to the next round while its longest counted prefix is not ``rare``.  What is
    left out lies after a rare prefix, where the models do not look.
    """
    sums = [F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary")]
    done, width, out = 0, SPELT, None
    while True:
        each = spelled.select("n_toxic", "n_ordinary", "spelling",
                              F.explode(F.sequence(F.lit(done + 1), F.least(F.length("spelling"), F.lit(width)))).alias("k"))
        counted = written(each.groupBy(head("spelling", F.col("k")).alias("prefix")).agg(*sums), "prefixes")
        out = counted if out is None else out.unionByName(counted)
        on = counted.filter((F.length("prefix") == width) & (F.col("n_toxic") + F.col("n_ordinary") >= rare)).select("prefix")
        spelled = written(spelled.filter(F.length("spelling") > width).withColumn("prefix", head("spelling", F.lit(width)))
                          .join(on, "prefix", "left_semi").drop("prefix"), "spellings")
        if spelled.isEmpty():
            return out
        done, width = width, 2 * width


def continuations(spelled: DataFrame, low: int = LOW, discount: float = DISCOUNT) -> DataFrame:
    """(gram, p): interpolated continuation probabilities of byte strings of 1 to ``low`` bytes.

    The count of a gram is the number of different bytes seen before it (the word's begin is one
    of them); p is that of its last byte after the others.
    """
    begun = spelled.select(F.concat(F.lit(END), "spelling").alias("s"))
    ends = begun.select("s", F.explode(F.sequence(F.lit(2), F.length("s"))).alias("i")) \
        .select(F.expr(f"substring(s, greatest(1, i - {low}), least(i, {low + 1}))").alias("ending")).distinct()
    grams = ends.select("ending", F.explode(F.sequence(F.lit(2), F.length("ending"))).alias("k")) \
        .select(tail("ending", F.col("k")).alias("g")).distinct()
    counted = grams.groupBy(F.substring("g", 2, low).alias("gram")).agg(F.count("*").alias("n")) \
        .withColumn("h", head("gram", F.length("gram") - 1)).withColumn("lower", F.substring("gram", 2, low))
    in_context = Window.partitionBy("h")       # at most 256 rows
    counted = written(counted.withColumn("total", F.sum("n").over(in_context)).withColumn("kinds", F.count("*").over(in_context)), "grams")
    out = None
    for k in range(1, low + 1):
        level = counted.filter(F.length("gram") == k)
        if k == 1:
            level = level.withColumn("p_low", F.lit(1 / 256))
        else:
            level = level.join(out.filter(F.length("gram") == k - 1).select(F.col("gram").alias("lower"), F.col("p").alias("p_low")), "lower")
        level = level.select("gram", ((F.greatest(F.col("n") - discount, F.lit(0.0)) + discount * F.col("kinds") * F.col("p_low"))
                                      / F.col("total")).alias("p"))
        out = level if out is None else out.unionByName(level)
    return out


def steps(spelled: DataFrame, rare: int = RARE, discount: float = DISCOUNT, strength: float = STRENGTH, most: int = MAX_PREFIXES) -> DataFrame:
    """(prefix, p_toxic, p_ordinary, miss): per frequent prefix hx both P_c(x | h), and for contexts what a
    rare next byte makes of the ratio: ln(toxic / ordinary) of the shares left to the shared model.

    The row with the empty prefix is the word's begin.
    """
    counts = written(prefix_counts(spelled, rare).withColumn("n", F.col("n_toxic") + F.col("n_ordinary")).withColumn(
        "h", head("prefix", F.length("prefix") - 1)), "prefixes")
    kept = F.col("n") >= rare
    if counts.filter(kept).count() > most:
        floor = count_floor(counts.filter(kept), "n", most)
        kept = kept & (steps_of("n") >= (floor if floor is not None else math.inf))

    def of(c: str) -> list[Column]:
        return [F.sum(f"n_{c}").alias(f"all_{c}"), F.count_if(kept & (F.col(f"n_{c}") > 0)).alias(f"kinds_{c}"),
                F.coalesce(F.sum(F.when(~kept, F.col(f"n_{c}"))), F.lit(0)).alias(f"rare_{c}")]

    contexts = counts.groupBy("h").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"), *of("toxic"), *of("ordinary"))
    for c in ("toxic", "ordinary"):
        contexts = contexts.withColumn(f"left_{c}", strength + discount * F.col(f"kinds_{c}") + F.col(f"rare_{c}"))
    contexts = contexts.withColumn("miss", F.ln(F.col("left_toxic") / (F.col("all_toxic") + strength))
                                   - F.ln(F.col("left_ordinary") / (F.col("all_ordinary") + strength)))
    low = continuations(spelled, discount=discount).withColumnRenamed("p", "p_low")
    shared = (F.greatest(F.col("n") - discount, F.lit(0.0)) + discount * F.col("kinds") * F.col("p_low")) / F.col("all")
    each = counts.filter(kept).withColumn("gram", tail("prefix", F.least(F.length("prefix"), F.lit(LOW)))) \
        .join(low, "gram").join(contexts, "h").withColumn("shared", shared)
    for c in ("toxic", "ordinary"):
        each = each.withColumn(f"p_{c}", (F.greatest(F.col(f"n_{c}") - discount, F.lit(0.0)) + F.col(f"left_{c}") * F.col("shared"))
                               / (F.col(f"all_{c}") + strength))
    miss = contexts.select(F.col("h").alias("prefix"), "miss")
    found = each.select("prefix", "p_toxic", "p_ordinary").join(miss, "prefix", "left")
    return found.unionByName(miss.filter(F.length("prefix") == 0).select(
        "prefix", F.lit(1.0).alias("p_toxic"), F.lit(1.0).alias("p_ordinary"), "miss"))


def spelt_matrix(spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of a matrix padded with zeros, and their lengths."""
    lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
    width = max(1, int(lengths.max(initial=0)))
    return np.array(spelled, f"S{width}").view(np.uint8).reshape(len(spelled), width), lengths


def next_hash(h: np.ndarray, column: np.ndarray) -> np.ndarray:
    return mix(h * BASE + column.astype(np.uint64) + np.uint64(1))


class Ratios:
    """ln P_toxic(word) / P_ordinary(word), read off a table of frequent prefixes by length."""

    def __init__(self, table: pa.Table):
        prefixes = table.column("prefix").to_pylist()
        matrix, lengths = spelt_matrix(prefixes)
        step = np.log(table.column("p_toxic").to_numpy()) - np.log(table.column("p_ordinary").to_numpy())
        miss = np.nan_to_num(table.column("miss").to_numpy(zero_copy_only=False).astype(float))
        self.root_miss = float(miss[lengths == 0][0])
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        above = np.zeros(len(prefixes))
        hashes = np.zeros(len(prefixes), np.uint64)
        longest = int(lengths.max(initial=0))
        for k in range(1, longest + 1):
            longer = lengths >= k
            hashes[longer] = next_hash(hashes[longer], matrix[longer, k - 1])
            rows = np.flatnonzero(lengths == k)
            order = rows[np.argsort(hashes[rows])]
            keys, total = hashes[order], above[order] + step[order]
            self.levels.append((keys, total, miss[order]))
            if len(keys):      # a prefix's own ratio is what its longer ones start from
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                above = np.where(longer & (keys[at] == hashes), total[at], above)
        # one byte more than the longest prefix: a word that goes on after it misses there
        self.levels.append((np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)))

    def of(self, spelled: list[bytes]) -> np.ndarray:
        """The ratios, looked up in parts of about ``CELLS`` bytes, words of about one length together."""
        spelled = [s[: len(self.levels)] for s in spelled]
        out = np.zeros(len(spelled))
        order = sorted(range(len(spelled)), key=lambda i: len(spelled[i]), reverse=True)
        at = 0
        while at < len(order):
            part = order[at : at + max(1, CELLS // max(1, len(spelled[order[at]])))]
            out[part] = self.looked_up([spelled[i] for i in part])
            at += len(part)
        return out

    def looked_up(self, spelled: list[bytes]) -> np.ndarray:
        matrix, lengths = spelt_matrix(spelled)
        out = np.zeros(len(spelled))
        rows = np.arange(len(spelled))
        hashes, missed = np.zeros(len(spelled), np.uint64), np.full(len(spelled), self.root_miss)
        for k, (keys, total, miss) in enumerate(self.levels, 1):
            go = lengths[rows] >= k
            rows, hashes, missed = rows[go], hashes[go], missed[go]
            if not len(rows):
                break
            hashes = next_hash(hashes, matrix[rows, k - 1])
            at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
            hit = keys[at] == hashes if len(keys) else np.zeros(len(rows), bool)
            out[rows[~hit]] += missed[~hit]
            rows, hashes, at = rows[hit], hashes[hit], at[hit]
            out[rows], missed = total[at], miss[at]
        return out


def text_ratios(docs: DataFrame, table: pa.Table, doc_id: str = "doc_id", text: str = "text", share: float = TOXIC_SHARE) -> DataFrame:
    """(doc_id, n_words, ratio) of every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(table)
    out = with_id(docs, doc_id, "n_words long, ratio double")
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, memory = None, {}
        for b in batches:
            ratios = ratios or Ratios(held.value)
            n_words, found = [], []
            for t in b.column(1):
                words, total = words_of(t.as_py()), 0.0
                for at in range(0, len(words), WORDS_KEPT // 2):       # a part always fits the memory
                    part = words[at : at + WORDS_KEPT // 2]
                    new = list(set(part).difference(memory))
                    if len(memory) + len(new) > WORDS_KEPT:
                        memory.clear()
                        new = list(set(part))
                    if new:
                        logs = np.minimum(ratios.of([spelt(w) for w in new]), 500)
                        memory.update(zip(new, np.log1p(share * np.expm1(logs)).tolist()))
                    total += math.fsum(map(memory.__getitem__, part))
                n_words.append(len(words))
                found.append(total / max(len(words), 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(found, pa.float64())], schema=schema)

    return in_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")), run, out)


def calibrated(ratio: np.ndarray, toxic: np.ndarray, share: float = TOXIC_SHARE) -> tuple[float, float]:
    """Border (best F1, in the middle of its gap) and slope (likeliest) of the logistic score."""
    z = np.arcsinh(ratio / share)
    order = np.argsort(-z, kind="stable")
    z, y = z[order], toxic[order].astype(float)
    f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(z[1:] < z[:-1], True)                     # a border lies between different values only
    best = int(np.argmax(np.where(last, f1, -1)))
    border = (z[best] + z[best + 1]) / 2 if best + 1 < len(z) else z[best] - 1e-9
    slope, away = 1.0, z - border
    for _ in range(50):                                        # Newton's method on one number, with a weak prior
        p = 1 / (1 + np.exp(-np.clip(slope * away, -30, 30)))
        move = (away @ (y - p) - 0.01 * slope) / ((away * away) @ (p * (1 - p)) + 0.01)
        slope = float(np.clip(slope + np.clip(move, -1, 1), 0.1, 20))
    return float(border), slope


def in_part(doc_id: Column, parts: list[int]) -> Column:
    return F.coalesce((F.crc32(doc_id.cast("string")) % 5).isin(parts), F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """(text, toxic, counted): at most about ``rows`` labelled documents that are not held out.

    Picked by a hash of doc_id.  The picked ids (at most about ``rows``) are broadcast, so texts
    are not shuffled.
    """
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isNotNull() & in_part(F.col("doc_id"), [1, 2, 3, 4])) \
        .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    total = known.count()
    if total > rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 24)) < int((1 << 24) * rows / total))
    picked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return written(picked.select("text", "toxic", in_part(F.col("doc_id"), [1, 2, 3]).alias("counted")), "labelled")


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> dict | None:
    """The table of prefixes and the calibration, or None without both classes."""
    sample = labelled_sample(docs, labels, rows)
    if sample.select("toxic", "counted").distinct().count() < 4:
        return None
    spelled = written(spellings(sample.filter("counted")), "spellings")
    table = steps(spelled).toArrow()
    rest = sample.filter("not counted").select(F.struct("toxic").alias("doc_id"), "text")
    found = text_ratios(rest, table).select("doc_id.toxic", "ratio").toPandas()
    if found["toxic"].nunique() < 2 or table.num_rows < 2:
        return None
    return {"table": table, "calibration": calibrated(found["ratio"].to_numpy(), found["toxic"].to_numpy())}


def score(docs: DataFrame, model: dict | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted, n_words, ratio) of every row of ``docs``."""
    if model is None:
        nothing = F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).cast("long").alias("n_words"), F.lit(0.0).alias("ratio")
        return docs.select(F.col(doc_id).alias("doc_id"), *nothing)
    border, slope = model["calibration"]
    found = text_ratios(docs, model["table"], doc_id, text)
    scored = found.withColumn("score", 1 / (1 + F.exp(-slope * (F.asinh(F.col("ratio") / TOXIC_SHARE) - border))))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_words", "ratio")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return score(docs, fit(docs, labels)).select("doc_id", in_part(F.col("doc_id"), [0]).alias("held_out"), "score", "predicted", "n_words", "ratio")
