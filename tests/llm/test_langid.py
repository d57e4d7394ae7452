"""Language ID: forward sums against brute force, held-out accuracy, defined results."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from issuelens.llm import langid


def all_segmentations(word, lattice):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        piece = lattice.ids.get(word[:n], lattice.unknown if n == 1 else None)
        if piece is not None:
            for rest in all_segmentations(word[n:], lattice):
                yield [piece, *rest]


def test_forward_sums_all_segmentations():
    lattice = langid.Lattice(["a", "b", "ab", "ba", "aba"])
    rng = np.random.default_rng(1)
    prob = rng.random((6, 3))
    for word in map("".join, itertools.product("abx", repeat=5)):
        brute = sum(np.prod(prob[s], axis=0) for s in all_segmentations(word, lattice))
        assert np.allclose(langid.forward(word, lattice, prob), np.log(brute))


def test_forward_of_a_giant_word_neither_underflows_nor_overflows():
    lattice = langid.Lattice(["a"])
    prob = np.array([[0.5, 1e-9], [0.1, 0.1]])
    assert np.allclose(langid.forward("a" * 50_000, lattice, prob), [50_000 * math.log(0.5), 50_000 * math.log(1e-9)])


def test_many_words_at_once_equal_one_by_one():
    pieces = langid.load_pieces(langid.PIECE_MODEL)
    rng = np.random.default_rng(2)
    prob = rng.random((len(pieces) + 1, 3)) * 1e-4
    words = ["\u2581the", "\u2581", "\u2581naïve", "\u2581日本x", "\u2581" + "ab" * 60, "\u2581###", "\u2581\U0001f600a", "\u2581\x07z"] * 2
    words += ["\u2581" + "".join(rng.choice(list("theinrsoß"), rng.integers(1, 39))) for _ in range(300)]
    lattice = langid.Lattice(pieces)
    want = np.stack([langid.forward(w, lattice, prob) for w in words])
    assert np.allclose(langid.WordScorer(pieces, prob).logs(words), want)
    assert langid.WordScorer(pieces, prob).logs([]).shape == (0, 3)


def test_expected_counts_match_brute_force():
    lattice = langid.Lattice(["a", "b", "ab", "ba"])
    prob = np.array([0.3, 0.2, 0.4, 0.05, 0.01])
    got = langid.expected_counts("abab", lattice, prob)
    segs = list(all_segmentations("abab", lattice))
    weights = np.array([np.prod(prob[s]) for s in segs])
    for piece in range(5):
        want = sum(w * s.count(piece) for w, s in zip(weights, segs)) / weights.sum()
        assert got.get(piece, 0) == pytest.approx(want)


def test_held_out_accuracy(spark):
    found = langid.op7_language_id(spark, SF_SMALL).filter("held_out")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    both = found.join(docs, "doc_id")
    right, rows = both.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert rows > 20 and right / rows >= 0.95


DOCS = "doc_id long, text string, lang string, score string"


def test_defined_results(spark):
    train = spark.createDataFrame([(1, "the cat and the dog", "en", "x"), (2, "le chat et le chien", "fr", "x"),
                                   (3, None, "en", "x"), (4, "no label", None, "x")], DOCS)
    model = langid.fit(train)
    rows = [(1, None, None, None), (2, "", None, None), (3, "123 $$$", None, None), (4, "the dog and the cat", "fr", "y"),
            (4, "the dog and the cat", "fr", "y"), (5, "le chien et le chat " * 5000, None, None), (None, "le chat", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = sorted((r.doc_id or 0, r.lang_pred) for r in langid.predict(docs, model).collect())
    assert found == [(0, "fr"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "fr")]
    kept = langid.filter_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4


def test_nothing_learned_and_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    model = langid.fit(empty)
    assert langid.predict(empty, model).count() == 0
    docs = spark.createDataFrame([(1, "words", None, None)], DOCS)
    assert [tuple(r) for r in langid.predict(docs, model).collect()] == [(1, "und", 0.0)]
