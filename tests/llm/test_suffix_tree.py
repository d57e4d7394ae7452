"""Suffix tree scores: against a brute-force model, normalisation, and the defined results."""

import math
from collections import Counter, defaultdict

import pytest

from conftest import SF_SMALL
from issuelens.llm import suffix_tree as st

DDL = "doc_id long, text string, score string"


def brute(train, docs, symbols, depth, p_min):
    """The same model from its definition, with plain dictionaries."""
    texts = [st.tokens(None if t is None else t.encode()) for t in train]
    counts = Counter(w for t in texts for w in t)
    hot = sorted(counts, key=lambda w: (-counts[w], w))
    alphabet = {w: i for i, w in enumerate(hot[:symbols])}
    rare, end = len(alphabet), len(alphabet) + 1
    sym = lambda t: [alphabet.get(w, rare) for w in t] + [end]
    seqs = [sym(t) for t in texts]
    n = defaultdict(Counter)
    for s in seqs:
        for i, x in enumerate(s):
            for d in range(min(i, depth) + 1):
                n[tuple(s[i - d : i])][x] += 1
    total = sum(n[()].values())
    size = len(alphabet) + 2
    kept = set()

    def prob(context, x):
        while context and context not in kept:
            context = context[1:]
        if not context:
            return (n[()][x] + 1 / size) / (total + 1)
        c, m = n[context], len(n[context])
        return (c[x] + m * prob(context[1:], x)) / (sum(c.values()) + m)

    least, candidates = max(1, p_min * total), {()}
    for d in range(1, depth + 1):
        candidates = {c for c in n if len(c) == d and c[:-1] in candidates and n[c[:-1]][c[-1]] >= least}
        new = set()
        for context in candidates:
            c, t = n[context], sum(n[context].values())
            gain = sum(k * (math.log(k / t) - math.log(prob(context[1:], x))) for x, k in c.items())
            if c and gain > 0.5 * math.log(t) * len(c):
                new.add(context)
        kept |= new
    return counts, alphabet, rare, sym, prob


def test_scores_match_brute_force(spark):
    base = "the cat sat on the mat and the dog sat on the log while the cat ran to the dog".split()
    train = [" ".join(base[i % 7 :] + base[: i % 5] + [f"odd{i % 3}" if i % 2 else "even"]) for i in range(80)] + [None, "", "The CAT"]
    docs = train[:6] + ["the unknown cat", None, "sat on the mat"]
    model = st.fit(spark.createDataFrame([(i, t, "") for i, t in enumerate(train)], DDL), symbols=8, depth=2, p_min=1e-3)
    counts, alphabet, rare, sym, prob = brute(train, docs, 8, 2, 1e-3)
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    assert (model["tokens"], model["known"]) == (n, v)
    assert any(len(level[0]) for level in model["tree"].levels)
    n_rare = sum(c for w, c in counts.items() if w not in alphabet)
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = once / (once + 2 * twice) if once else 0.5
    found = {r.doc_id: r for r in st.score(spark.createDataFrame([(i, t, "") for i, t in enumerate(docs)], DDL), model).collect()}
    for i, t in enumerate(docs):
        words = st.tokens(None if t is None else t.encode())
        s, want = sym(words), 0.0
        for j, x in enumerate(s):
            want += math.log10(prob(tuple(s[max(0, j - 2) : j]), x))
            if x == rare:
                c = counts[words[j]]
                want += math.log10((c - discount if c else discount * (v - 1 - len(alphabet))) / n_rare)
        base_want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((len(train) + 1) / (n + v + 1))
        assert found[i].score == pytest.approx(want) and found[i].base_score == pytest.approx(base_want)
        assert (found[i].n_tokens, found[i].n_known) == (len(words) + 1, sum(w in counts for w in words) + 1)


def test_next_symbol_distributions_sum_to_one(spark):
    import numpy as np
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tree = st.fit(docs, symbols=50, p_min=1e-4)["tree"]
    every = np.arange(tree.size)
    assert abs((10 ** tree.root).sum() - 1) < 1e-9
    for d, level in enumerate(tree.levels, 1):
        assert len(level[0])
        for context in level[0][:20]:
            codes = [np.full(tree.size, context % tree.size ** k) for k in range(d + 1)]
            assert abs((10 ** tree.log_probs(codes, every, d)).sum() - 1) < 1e-9


def test_held_out_scores_beat_the_base(spark):
    found = st.op4_suffix_tree_score(spark, SF_SMALL).toPandas()
    held = found[found.held_out]
    assert len(found) == 200 and held.score.sum() > held.base_score.sum()


def test_defined_results(spark):
    empty = spark.createDataFrame([], DDL)
    model = st.fit(empty)
    docs = spark.createDataFrame([(1, None, ""), (1, None, ""), (None, "a " * 200_000, ""), (2, "", "")], DDL)
    found = sorted(((r.doc_id or 0), r.n_tokens, r.n_known) for r in st.score(docs, model).collect())
    assert found == [(0, 200_001, 0), (1, 1, 0), (1, 1, 0), (2, 1, 0)]
    assert st.score(empty, st.fit(docs)).count() == 0


def test_words_seen_once_keep_a_probability_where_no_word_was_seen_twice(spark):
    docs = spark.createDataFrame([(1, "a b c d e " * 3 + " ".join(f"w{i}" for i in range(45)), "")], DDL)
    found = [st.score(docs, st.fit(docs, symbols=5, hot_words=n)).first().score for n in (10, 1000)]
    assert math.isfinite(found[0]) and found[0] == pytest.approx(found[1])
    # 45 of the words are rare, each with what is left of one occurrence
    assert found[0] < 45 * math.log10((1 - st.MOST_DISCOUNT) / 45)
