"""Language identification by segmentation-marginalised unigrams.

Every language has one probability per piece of a fixed public vocabulary.  A word's
probability in a language is the sum over *all* ways to cut it into pieces of the product of
their probabilities; the forward algorithm gets that sum in one pass over the characters.  No
piece goes over white space, so a text's log probability is the sum over its words, and a task
scores each distinct word once.

Learning counts pieces over a bounded sample of the labelled documents: every labelled
document of a language when it has at most ``fit_docs`` of them, else a share picked by a hash
of doc_id that leaves about ``fit_docs``.  The counts start as "every occurrence of a piece
inside a word" and are refined by one expectation-maximisation pass (expected piece counts
over all segmentations).  The fitted table has at most pieces x languages numbers; a table of
more than ``MAX_LANGUAGES`` labels is refused.

Defined results: null text, or text without a letter, is ``und`` with score 0, as is every
document when nothing could be learned.  Ties go to the first language in alphabetical order.
Repeated rows each get their row.  Only the columns named here are read, so others may clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.llm.lattice import Trie
from issuelens.llm.text import held_out, in_arrow, read_table, schema_of, with_id

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
FIT_DOCS = 1000
MAX_LANGUAGES = 500
SPACE_MARK = "▁"
LETTER = re.compile(r"[^\W\d_]")
# The share of probability each language keeps for pieces it never showed, over the vocabulary.
UNSEEN = 0.01
WORDS_KEPT = 400_000


def load_pieces(model_path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model, in vocabulary order (read on the driver)."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_path, "rb") as f:
        model.ParseFromString(f.read())
    return [p.piece for p in model.pieces if p.type == 1]


class Lattice:
    """Pieces that start at each character of a word; a character that is no piece is unknown."""

    def __init__(self, pieces: list[str]):
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.unknown = len(pieces)
        self.longest = max(map(len, pieces), default=1)

    def arcs(self, word: str, start: int) -> list[tuple[int, int]]:
        """(end, piece id) of the pieces that start here."""
        get, found = self.ids.get, []
        for end in range(start + 1, min(len(word), start + self.longest) + 1):
            i = get(word[start:end])
            if i is not None:
                found.append((end, i))
        if not found or found[0][0] > start + 1:
            found.append((start + 1, self.unknown))
        return found


RESCALE = 1e-120


def forward(word: str, lattice: Lattice, prob: np.ndarray) -> np.ndarray:
    """Log probability of a word in every language: the log of the sum over all segmentations.

    ``prob`` is (pieces + 1) x languages.  The sums are kept as probabilities and scaled up
    whenever they get small, so words of any length neither underflow nor need logarithms
    inside the loop; only sums that a piece can still reach are held.  This is the plain form of
    what ``WordScorer`` does for many words at once.
    """
    n, width = len(word), lattice.longest + 1
    sums = [None] * width
    sums[0] = np.ones(prob.shape[1])
    log_scale = np.zeros(prob.shape[1])
    for i in range(n):
        here = sums[i % width]
        sums[i % width] = None
        low = here < RESCALE
        if low.any():
            factor = np.where(low, 1 / RESCALE, 1.0)
            here = here * factor
            sums = [s if s is None else s * factor for s in sums]
            log_scale -= np.log(factor)
        for end, piece in lattice.arcs(word, i):
            step = here * prob[piece]
            k = end % width
            sums[k] = step if sums[k] is None else sums[k] + step
    return np.log(sums[n % width]) + log_scale


class WordScorer:
    """Forward sums of many distinct words at once, odd ones (see ``Trie``) one by one."""

    def __init__(self, pieces: list[str], prob: np.ndarray):
        self.prob, self.lattice, self.trie = prob, Lattice(pieces), Trie(pieces)

    def logs(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), self.prob.shape[1]))
        odd, lots = self.trie.grids(words)
        for w in odd:
            out[w] = forward(words[w], self.lattice, self.prob)
        unknown = self.lattice.unknown
        for places, grid, sizes in lots:
            sums = np.zeros((grid.shape[1], len(places), self.prob.shape[1]))
            sums[0] = 1
            for start, end, rows, piece in self.trie.steps(grid, sizes):
                sums[end, rows] += sums[start, rows] * self.prob[np.where(piece < 0, unknown, piece)]
            out[places] = np.log(sums[sizes, np.arange(len(places))])
        return out


def expected_counts(word: str, lattice: Lattice, prob: np.ndarray) -> dict[int, float]:
    """Expected piece counts of a word over all its segmentations in one language."""
    n = len(word)
    arcs = [lattice.arcs(word, i) for i in range(n)]
    ahead = [0.0] * n + [1.0]
    for i in range(n - 1, -1, -1):
        ahead[i] = sum(prob[p] * ahead[e] for e, p in arcs[i])
    counts: dict[int, float] = {}
    before = [1.0] + [0.0] * n
    if ahead[0] <= 0:                  # too long for plain probabilities: left to the first counts
        return counts
    for i in range(n):
        for e, p in arcs[i]:
            w = before[i] * prob[p]
            before[e] += w
            counts[p] = counts.get(p, 0.0) + w * ahead[e] / ahead[0]
    return counts


def words_of(text: bytes) -> list[bytes]:
    return text.split()


def fit_sample(docs: DataFrame, text: str, lang: str, key: Column, fit_docs: int) -> DataFrame:
    """Labelled documents (lang, text): per language all, or a hashed share of about ``fit_docs``."""
    named = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in named.groupBy(lang).count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return named.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text")).limit(0)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, fit_docs / n))])
    drawn = F.pmod(F.xxhash64(key.cast("string")), F.lit(1_000_000)) < share[F.col(lang)] * 1_000_000
    return named.filter(drawn).select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"))


def fit(docs: DataFrame, model_path: str = PIECE_MODEL, text: str = "text", lang: str = "lang",
        doc_id: str = "doc_id", fit_docs: int = FIT_DOCS) -> dict:
    """Learn per-language piece probabilities: {"langs", "pieces", "prob"}."""
    spark = docs.sparkSession
    pieces = load_pieces(model_path)
    held = spark.sparkContext.broadcast(pieces)
    words_schema = schema_of("lang string, word binary, n long")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def flush():
            rows = [(k, w, n) for k, c in seen.items() for w, n in c.items()]
            seen.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    zip(*rows), words_schema.types)], schema=words_schema)

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                seen.setdefault(k, Counter()).update(words_of(t.as_py()))
            if sum(map(len, seen.values())) > WORDS_KEPT:
                yield from flush()
        yield from flush()

    sample = fit_sample(docs, text, lang, F.col(doc_id), fit_docs)
    words = in_arrow(sample, count_words, "lang string, word binary, n long") \
        .groupBy("lang", "word").agg(F.sum("n").alias("n")).persist()

    def gather(count_one) -> dict[str, np.ndarray]:
        """Sum piece counts by language; each task sends at most one row per piece and language."""
        counts_schema = schema_of("lang string, piece int, n double")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(held.value)
            total: dict[str, np.ndarray] = {}
            for b in batches:
                for k, w, n in zip(*[c.to_pylist() for c in b.columns]):
                    row = total.setdefault(k, np.zeros(lattice.unknown + 1))
                    count_one(k, SPACE_MARK + w.decode(errors="replace"), n, lattice, row)
            for k, row in total.items():
                ids = np.flatnonzero(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(ids)), pa.array(ids, pa.int32()), pa.array(row[ids])], schema=counts_schema)

        summed = in_arrow(words, run, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        out: dict[str, np.ndarray] = {}
        for k, piece, n in summed.collect():        # at most pieces x languages rows
            out.setdefault(k, np.zeros(len(pieces) + 1))[piece] = n
        return out

    def occurrences(_, word, n, lattice, row):
        for i in range(len(word)):
            for _, p in lattice.arcs(word, i):
                row[p] += n

    first = {k: smoothed(v) for k, v in gather(occurrences).items()}
    shared = spark.sparkContext.broadcast({k: v.tolist() for k, v in first.items()})

    def refine(k, word, n, lattice, row):
        for p, x in expected_counts(word, lattice, shared.value[k]).items():
            row[p] += n * x

    final = gather(refine)
    words.unpersist()
    langs = sorted(final)
    prob = np.stack([smoothed(final[k]) for k in langs], axis=1) if langs else np.zeros((len(pieces) + 1, 0))
    return {"langs": langs, "pieces": pieces, "prob": prob}


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Counts to probabilities; a share ``UNSEEN`` is spread evenly over all pieces and "unknown"."""
    total = counts.sum()
    return (1 - UNSEEN) * counts / (total or 1) + UNSEEN / len(counts)


def predict(docs: DataFrame, model: dict, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (the language's share of the likelihood)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    out = with_id(docs, doc_id, "lang_pred string, score double")
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prob = held.value["langs"], held.value["prob"]
        scorer = WordScorer(held.value["pieces"], prob) if langs else None
        rows: dict[bytes, int] = {}
        logs = np.empty((WORDS_KEPT, len(langs)))

        def add(total: np.ndarray, owners: list[int], words: list[bytes]) -> None:
            """Add the words' log probabilities to their documents' totals."""
            new = list(set(words).difference(rows))
            if len(rows) + len(new) > WORDS_KEPT:
                rows.clear()
                new = list(set(words))
            at = len(rows)
            logs[at : at + len(new)] = scorer.logs([SPACE_MARK + w.decode(errors="replace") for w in new])
            rows.update(zip(new, range(at, at + len(new))))
            places = np.fromiter(map(rows.__getitem__, words), np.int64, len(words))
            np.add.at(total, np.unique(owners), np.add.reduceat(logs[places], np.unique(owners, return_index=True)[1]))

        for b in batches:
            total = np.zeros((b.num_rows, len(langs)))
            lettered = np.zeros(b.num_rows, bool)
            owners, words = [], []
            for i, t in enumerate(b.column(1)):
                text = t.as_py()
                if text is None or not langs or not LETTER.search(text.decode(errors="replace")):
                    continue
                lettered[i] = True
                of_text = words_of(text)
                for k in range(0, len(of_text), WORDS_KEPT // 2):         # a part always fits the memory
                    part = of_text[k : k + WORDS_KEPT // 2]
                    if len(words) + len(part) > WORDS_KEPT // 2:
                        add(total, owners, words)
                        owners, words = [], []
                    owners += [i] * len(part)
                    words += part
            if words:
                add(total, owners, words)
            best = total.argmax(axis=1) if langs else None
            found = [langs[best[i]] if ok else "und" for i, ok in enumerate(lettered)]
            score = [float(1 / np.exp(total[i] - total[i, best[i]]).sum()) if ok else 0.0 for i, ok in enumerate(lettered)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string()), pa.array(score, pa.float64())], schema=schema)

    return in_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")), run, out)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the labelled documents not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"), 4)))
    found = predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "lang_pred", "score")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language was recognised (``und`` and coin tosses go)."""
    model = fit(docs.filter(~held_out(F.col("doc_id"), 4)))
    return filter_identified(docs, model)


def filter_identified(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is recognised with a score of at least ``least``.

    All columns are kept: a row travels through the task as one struct, so nothing is joined.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    held = predict(docs.select(row).select(F.col("row").alias("doc_id"), F.col("row.text").alias("text")), model)
    return held.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("doc_id.*")
