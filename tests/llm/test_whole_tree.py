"""The suffix tree over all words: against a brute-force model, with and without hot contexts, and its defined results."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from issuelens.llm import suffix_tree as st

DDL = "doc_id long, text string"


def brute(train, depth, least):
    """(log10 probability of a token after the words before it, words' counts, whether a string is retained) from the definition."""
    seqs = [[*st.tokens(None if t is None else t.encode()), None] for t in train]
    counts = Counter(w for s in seqs for w in s[:-1])
    n = defaultdict(Counter)
    for s in seqs:
        for i, x in enumerate(s):
            for d in range(min(i, depth) + 1):
                n[tuple(s[i - d : i])][x] += 1
    words, ends = sum(counts.values()), len(seqs)
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = min(once / (once + 2 * twice), st.MOST_DISCOUNT) if once else 0.5
    kept = set()

    def prob(context, x):
        while context and context not in kept:
            context = context[1:]
        if not context:
            if x is None:
                return (ends + 0.5) / (words + ends + 1)
            share = (words + 0.5) / (words + ends + 1)
            return share * (counts[x] - discount if x in counts else discount * len(counts)) / words
        c = n[context]
        return (c[x] + len(c) * prob(context[1:], x)) / (sum(c.values()) + len(c))

    for d in range(1, depth + 1):
        new = set()
        for context, c in [(k, v) for k, v in n.items() if len(k) == d]:
            total = sum(c.values())
            gain = sum(k * (math.log(k / total) - math.log(prob(context[1:], x))) for x, k in c.items())
            if total >= least and gain > 0.5 * math.log(total) * len(c):
                new.add(context)
        kept |= new
    return prob, counts, kept


BASE = "the cat sat on the mat and the dog sat on the log while the cat ran to the dog".split()
TRAIN = [" ".join(BASE[i % 7 :] + BASE[: i % 5] + [f"odd{i % 3}" if i % 2 else "even", f"once{i}", "the", "cat"]) for i in range(40)] \
    + [None, "", "The CAT", "rare words stand here once and rare words stand here again"]
DOCS = [*TRAIN[:6], "the unknown cat unknown", None, "sat on the mat rare words stand unseen", TRAIN[-1]]


def expected(docs, prob, counts, ends, depth):
    words = sum(counts.values())
    out = []
    for t in docs:
        s = [*st.tokens(None if t is None else t.encode()), None]
        base = sum(math.log10(((ends if x is None else counts[x]) + 1) / (words + ends + len(counts) + 2)) for x in s)
        out.append((len(s), sum(x in counts for x in s) + 1, base, sum(math.log10(prob(tuple(s[max(0, j - depth) : j]), x)) for j, x in enumerate(s))))
    return out


@pytest.mark.parametrize("hot_words, hot_context, part_bytes", [(1000, 10 ** 6, 10 ** 6), (3, 10 ** 6, 500), (6, 30, 500), (0, 1, 500)])
def test_scores_match_brute_force(spark, hot_words, hot_context, part_bytes):
    depth = 4
    prob, counts, kept = brute(TRAIN, depth, st.LEAST)
    assert {len(c) for c in kept} == {1, 2, 3, 4} and any(counts[w] < 3 for c in kept for w in c)
    train = spark.createDataFrame(list(enumerate(TRAIN)), DDL)
    model = st.fit(train, depth=depth, hot_words=hot_words, hot_context=hot_context)
    if hot_words == 6:      # hot contexts of several words
        assert len(model["held"]["hot_contexts"]) > 5
    apart = spark.createDataFrame(list(enumerate(DOCS)), DDL)
    together = train.withColumn("mine", F.lit(True)).unionByName(apart.withColumn("mine", F.lit(False)))
    for docs, trained, wanted in [(apart, None, DOCS), (together, F.col("mine"), [*TRAIN, *DOCS])]:
        found = st.score(docs, model, trained=trained, part_bytes=part_bytes).collect()
        key = lambda r: (r[0], r[1], round(r[2], 6), round(r[3], 6))
        got = sorted(key((r.n_tokens, r.n_known, r.base_score, r.score)) for r in found)
        want = sorted(map(key, expected(wanted, prob, counts, len(TRAIN), depth)))
        assert [g[:2] for g in got] == [w[:2] for w in want] and got == [pytest.approx(w, abs=3e-6) for w in want]


def test_words_of_any_frequency_are_told_apart_by_their_contexts(spark):
    """Words beyond the 1,000 most frequent ones were one symbol: any of them was as likely after any other."""
    pairs = [f"left{i} right{i}" for i in range(1500)]
    docs = spark.createDataFrame([(i, f"{p} {p}") for i, p in enumerate(pairs)], DDL)
    model = st.fit(docs)
    asked = spark.createDataFrame([(0, "left7 right7"), (1, "left7 right8"), (2, "left1444 right1444"), (3, "left1444 right8")], DDL)
    found = {r.doc_id: r.score for r in st.score(asked, model).collect()}
    assert found[0] > found[1] + 2 and found[2] > found[3] + 2


def test_copies_score_above_texts_that_stand_once(spark):
    """A text that training shows twice is known word by word, whatever its words."""
    texts = [" ".join(f"w{(i * 7919 + j * j * 31 + j * i) % 4000}" for j in range(60)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate([*texts, *texts[:20]])), DDL)
    found = {}
    for r in st.score(docs, st.fit(docs), trained=F.lit(True)).collect():
        found.setdefault(r.doc_id % 200, []).append(r.score)
    assert min(min(found[i]) for i in range(20)) > max(max(found[i]) for i in range(20, 200))


def test_defined_results(spark):
    empty = spark.createDataFrame([], DDL)
    docs = spark.createDataFrame([(1, None), (1, None), (None, "a " * 200_000), (2, "")], DDL)
    for rows in (docs, docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")):
        got = st.score(rows, st.fit(empty)).collect()
        assert sorted((int(r.doc_id or 0), r.n_tokens, r.n_known, r.base_score) for r in got) == [(0, 200_001, 0, 0.0), (1, 1, 0, 0.0), (1, 1, 0, 0.0), (2, 1, 0, 0.0)]
        assert all(math.isfinite(r.score) for r in got)
    assert st.score(empty, st.fit(docs), trained=F.lit(True)).count() == 0
    only_ends = spark.createDataFrame([(1, None), (2, "")], DDL)
    assert all(math.isfinite(r.score) for r in st.score(docs, st.fit(only_ends)).collect())
