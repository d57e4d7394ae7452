"""Class-conditional Kneser-Ney models against a brute-force form, distributions, held-out labels, defined results."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from issuelens.llm import toxicity as tx

DISCOUNT, STRENGTH = tx.DISCOUNT, tx.STRENGTH


class Brute:
    """The models of the docstring with plain dictionaries."""

    def __init__(self, toxic, ordinary, rare):
        n = {1: Counter(), 0: Counter()}
        endings = set()
        for c, words in ((1, toxic), (0, ordinary)):
            for w in words:
                s = tx.spelt(w)
                for k in range(len(s) + 1):
                    n[c][s[:k]] += 1
                begun = b" " + s
                endings |= {begun[max(0, i - tx.LOW) : i + 1] for i in range(1, len(begun))}
        self.n, self.rare = n, rare
        self.all = n[1] + n[0]
        self.after = defaultdict(set)
        for p in self.all:
            if p:
                self.after[p[:-1]].add(p)
        grams = {e[i:] for e in endings for i in range(len(e) - 1)}
        self.before = Counter(g[1:] for g in grams if len(g) <= tx.LOW + 1)

    def low(self, gram):
        if not gram:
            return 1 / 256
        total = sum(v for g, v in self.before.items() if len(g) == len(gram) and g[:-1] == gram[:-1])
        kinds = sum(1 for g in self.before if len(g) == len(gram) and g[:-1] == gram[:-1])
        below = self.low(gram[1:]) if len(gram) > 1 else 1 / 256
        return (max(self.before[gram] - DISCOUNT, 0) + DISCOUNT * kinds * below) / total

    def shared(self, p):
        h = p[:-1]
        return (max(self.all[p] - DISCOUNT, 0) + DISCOUNT * len(self.after[h]) * self.low(p[-tx.LOW :])) / self.all[h]

    def kept(self, h):
        return [p for p in self.after[h] if self.all[p] >= self.rare]

    def left(self, c, h):
        kept = self.kept(h)
        return STRENGTH + DISCOUNT * sum(self.n[c][p] > 0 for p in kept) + self.n[c][h] - sum(self.n[c][p] for p in kept)

    def p(self, c, p):
        h = p[:-1]
        return (max(self.n[c][p] - DISCOUNT, 0) + self.left(c, h) * self.shared(p)) / (self.n[c][h] + STRENGTH)

    def ratio(self, word):
        s, total = tx.spelt(word), 0.0
        for k in range(1, len(s) + 1):
            p, h = s[:k], s[: k - 1]
            if self.all[p] < self.rare:
                a, b = (self.left(c, h) / (self.n[c][h] + STRENGTH) for c in (1, 0))
                return total + math.log(a / b)
            total += math.log(self.p(1, p) / self.p(0, p))
        return total


def texts(seed=1, n=120):
    rng = random.Random(seed)
    common = ["the", "then", "there", "ünd", "a", "thing", "averyveryverylongword", "averyveryverylongwork", "日本"]
    bad = ["idiot", "idiots", "idle", "vile", "viler"]
    made = lambda words, k: " ".join(rng.choice(words) for _ in range(k))
    return [(made(common, 30) + " " + made(bad, 3), 1) for _ in range(n // 4)] + [(made(common, 30) + (" idle" if rng.random() < 0.3 else ""), 0) for _ in range(n)]


@pytest.fixture(scope="module")
def models(spark):
    rows = texts()
    table = tx.steps(tx.spellings(spark.createDataFrame(rows, "text string, toxic int")), rare=4).toArrow()
    words = {c: [w for t, x in rows if x == c for w in tx.words_of(t.encode())] for c in (0, 1)}
    return table, Brute(words[1], words[0], 4)


def test_steps_match_brute_force_and_sum_to_one(models):
    table, brute = models
    rows = {r["prefix"]: r for r in table.to_pylist()}
    assert set(rows) == {p for p, v in brute.all.items() if v >= 4}
    for p, r in rows.items():
        if p:
            assert r["p_toxic"] == pytest.approx(brute.p(1, p)) and r["p_ordinary"] == pytest.approx(brute.p(0, p))
    for h in [h for h in rows if brute.after[h]]:
        for c in (0, 1):
            kept = brute.kept(h)
            others = brute.left(c, h) / (brute.n[c][h] + STRENGTH) * (1 - sum(brute.shared(p) for p in kept))
            assert sum(brute.p(c, p) for p in kept) + others == pytest.approx(1)
        assert sum(brute.low(g) for g in brute.before if len(g) == 1) < 1 + 1e-9


def test_ratios_match_brute_force(models):
    table, brute = models
    words = ["the", "idiot", "idiotic", "idle", "vile", "viles", "zzz", "i", "averyveryverylongword", "averyveryverylongwork", "ünd", "日本", "日"]
    words = [w.encode() for w in words]
    got = tx.Ratios(table).of([tx.spelt(w) for w in words])
    assert got == pytest.approx([brute.ratio(w) for w in words])
    assert got[1] > 1 > abs(got[0]) and got[2] > 1
    assert len(tx.Ratios(table).of([])) == 0


def test_text_ratios_are_means_over_words_and_parts(spark, models, monkeypatch):
    table, brute = models
    docs = [(1, "The IDIOT\tthe  then"), (2, None), (3, ""), (4, " \n"), (5, "vile idiot " * 5000), (None, "the"), (1, "The IDIOT\tthe  then")]
    got = [tuple(r) for r in tx.text_ratios(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()]
    monkeypatch.setattr(tx, "WORDS_KEPT", 4)
    again = [tuple(r) for r in tx.text_ratios(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()]
    assert len(again) == len(got) == len(docs)
    for (i, t), (j, n, ratio), (_, _, ratio2) in zip(docs, got, again):
        words = tx.words_of((t or "").encode())
        want = sum(math.log(1 - tx.TOXIC_SHARE + tx.TOXIC_SHARE * math.exp(brute.ratio(w))) for w in words) / max(len(words), 1)
        assert (j, n) == (i, len(words)) and ratio == pytest.approx(want) == pytest.approx(ratio2)


def test_calibration_puts_the_border_in_the_gap():
    ratio, toxic = np.array([0.0, 0.001, 0.002, 0.2, 0.3, 0.3]), np.array([0, 0, 0, 1, 1, 1])
    border, slope = tx.calibrated(ratio, toxic)
    z = np.arcsinh(ratio / tx.TOXIC_SHARE)
    assert z[2] < border < z[3] and slope > 0
    border, _ = tx.calibrated(np.zeros(4), np.array([1, 0, 1, 0]))     # ties: no border lies inside them
    assert border < 0


def labelled(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, source string, score string"),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))


def test_defined_results(spark):
    rows = texts(2, 400)
    docs = [(i, t, "s", "clash") for i, (t, _) in enumerate(rows)] + [(None, "idiot vile", None, ""), (900, None, None, ""), (901, "", None, ""), (3, rows[3][0], "s", "")]
    labels = [(i, x, 0) for i, (_, x) in enumerate(rows)] + [(5, None, 0), (7, 1, 0), (None, 1, 0), (901, 0, 0)]
    docs, labels = labelled(spark, docs, labels)
    found = tx.score(docs, tx.fit(docs, labels)).collect()
    assert len(found) == len(rows) + 4 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    by = {r.doc_id: r for r in found}
    assert by[900].ratio == by[901].ratio == 0 and by[900].predicted == 0
    right = sum(by[i].predicted == x for i, (_, x) in enumerate(rows))
    assert right >= 0.95 * len(rows)
    only = labels.filter("toxic = 0")
    assert {r.score for r in tx.score(docs, tx.fit(docs, only)).collect()} == {0.0}
    assert tx.score(docs.limit(0), tx.fit(docs.limit(0), labels.limit(0))).count() == 0


def test_a_bounded_sample_is_picked_by_its_hash(spark):
    docs, labels = labelled(spark, [(i, f"w{i}", "", "") for i in range(4000)], [(i, i % 2, 0) for i in range(4000)])
    sample = tx.labelled_sample(docs, labels, rows=500)
    assert 380 < sample.count() < 620 and sample.select("toxic", "counted").distinct().count() == 4
    assert tx.labelled_sample(docs, labels).count() == labels.filter(tx.in_part(tx.F.col("doc_id"), [1, 2, 3, 4])).count()


def test_labels_of_documents_that_were_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = tx.op12_toxicity(spark, sf)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    cells = Counter((r.toxic, r.predicted) for r in found.join(labels, "doc_id").filter("held_out").collect())
    assert cells[1, 1] >= 0.85 * (cells[1, 1] + cells[1, 0])            # some labels are noise
    assert cells[0, 1] <= 0.05 * (cells[0, 0] + cells[0, 1])


def test_every_byte_of_a_word_counts(spark, monkeypatch):
    """Words that differ after their first twelve bytes, and a very long one."""
    stem, long = "abcdefghijklmnop", "x" * 100
    rows = [(f"{stem}toxic {long}bad", 1), (f"{stem}plain {long}good", 0)] * 20
    table = tx.steps(tx.spellings(spark.createDataFrame(rows, "text string, toxic int"))).toArrow()
    bad, good, short, worse, best = tx.Ratios(table).of([tx.spelt(w.encode()) for w in (stem + "toxic", stem + "plain", stem, long + "bad", long + "good")])
    assert bad > 0.2 and worse > 0.2 and good < -0.1 and best < -0.1 and good < short < bad
    want = tx.Ratios(table).of([b"abc ", tx.spelt((long + "bad").encode()), b"abcdefghijklmnoptoxic "])
    monkeypatch.setattr(tx, "CELLS", 1)
    assert list(tx.Ratios(table).of([b"abc ", tx.spelt((long + "bad").encode()), b"abcdefghijklmnoptoxic "])) == list(want)
