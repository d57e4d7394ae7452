"""N-gram Jaccard join against brute force: random near copies, chains, thresholds, defined results."""

import random

import pytest

from conftest import SF_SMALL
from issuelens.llm import jaccard
from llm_brute import brute


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, component_id string")
    assert sorted((tuple(r) for r in jaccard.joined(docs).collect()), key=str) == brute(rows)
    return docs


def test_near_copies_of_all_degrees(spark):
    rng = random.Random(21)
    docs = []
    passage = [f"p{i}" for i in range(40)]
    for _ in range(12):
        body = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(3, 160))]
        for _ in range(rng.randrange(1, 14)):
            copy = list(body)
            for _ in range(rng.randrange(0, 5)):
                k = rng.randrange(len(copy))
                copy[k : k + rng.randrange(0, 2)] = [f"n{rng.randrange(10**6)}"]
            if rng.random() < 0.3:
                copy = passage + copy
            docs.append(copy)
            if rng.random() < 0.4:
                body = copy          # chains: a copy of a copy
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    check(spark, [(i, " ".join(d)) for i, d in zip(ids, docs)])


def test_exactly_at_the_threshold(spark):
    base = [f"a{i}" for i in range(103)]                    # 100 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:-15])), (3, " ".join(base[:-16])), (4, " ".join(base[16:]))]
    rows += [(10 + i, " ".join(base[i:] + [f"z{i}_{k}" for k in range(i)])) for i in range(12)]
    check(spark, rows)


def test_one_large_group_and_a_common_passage(spark):
    rng = random.Random(22)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(0, 5)):
            copy[rng.randrange(200)] = f"c{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(base[:60] + [f"d{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))])) for i in range(100)]
    check(spark, rows)


def test_copies_with_longer_variants(spark):
    """New words come first in a variant's index, the words of the many copies behind it."""
    rng = random.Random(23)
    rows = []
    for k, size in enumerate((100, 100, 200, 60, 140)):
        base = [f"e{k}_{i}" for i in range(size + 3)]
        rows += [(100 * k + i, " ".join(base)) for i in range(30)]
        for i, percent in enumerate((12, 13, 14, 15, 16, 17, 17.6, 18)):
            new = [f"f{k}_{i}_{x}" for x in range(int(size * percent / 100))]
            at = rng.choice((0, len(base)))
            rows += [(100 * k + 50 + 2 * i, " ".join(base[:at] + new + base[at:]))]
            if k > 2:          # a group of near copies of the variant
                rows += [(100 * k + 51 + 2 * i, " ".join(base[:at] + new[1:] + base[at:]))]
    check(spark, rows)


def test_copies_around_one_text_are_not_paired_with_each_other(spark, monkeypatch):
    """Every copy has changes of its own: most link to the text they were made from, few to each other.

    The pairs that are looked at grow with the copies, not with their square."""
    made = []

    def counted(df, name="llm"):
        out = written(df, name)
        if name in ("open", "pairs"):
            made.append(out.count())
        return out

    written = jaccard.written
    monkeypatch.setattr(jaccard, "written", counted)

    def most(copies):
        rng = random.Random(25)
        base = [f"i{i}" for i in range(150)]
        rows = [(copies // 2, " ".join(base))]
        for i in range(copies):
            copy = list(base)
            for at in rng.sample(range(150), rng.choice((2, 2, 2, 3, 3))):
                copy[at] = f"j{rng.randrange(10**9)}"
            rows.append((1000 + i, " ".join(copy)))
        made.clear()
        check(spark, rows)
        return max(made)

    assert most(300) <= 4 * 300 and most(600) <= 4 * 600


def test_stage_takes_five_words_and_80_percent(spark):
    """Three single words changed in 150: 131 of 161 shingles of five words, 135 of 159 of four."""
    rng = random.Random(24)
    rows = []
    for k in range(6):
        base = [f"g{k}_{i}" for i in range(150)]
        rows.append((10 * k, " ".join(base)))
        for i, places in enumerate([(30, 70, 110), (20, 60, 120), (25, 50, 75, 100)], 1):
            copy = list(base)
            for at in places:
                copy[at] = f"h{rng.randrange(10**9)}"
            rows.append((10 * k + i, " ".join(copy)))

    def by_hand(gram, percent):
        sets = {i: {tuple(w[x : x + gram]) for x in range(len(w) - gram + 1)} for i, t in rows for w in [t.split()]}
        parent = {i: i for i in sets}
        for a in sorted(sets):
            for b in sorted(sets):
                both = len(sets[a] & sets[b])
                if a < b and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((parent[a], parent[b]))
                    parent = {x: low if p == high else p for x, p in parent.items()}
        return parent

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for gram, percent in ((4, 85), (5, 80), (3, 60)):
        got = {r.doc_id: r.component_id for r in jaccard.joined(docs, gram=gram, percent=percent).collect()}
        assert got == by_hand(gram, percent)
    kept = {r.doc_id for r in jaccard.keep_one(spark, docs, "").collect()}
    assert kept == {i for i, low in by_hand(5, 80).items() if i == low} != {i for i, low in by_hand(4, 85).items() if i == low}


def test_defined_results(spark):
    rows = [(5, "a b"), (3, "A  B"), (4, "b a"), (6, None), (7, ""), (8, " \n"), (None, "a b"), (9, "x " * 40_000), (2, "x x x x x"),
            (10, "one two three four"), (10, "one two three four"), (11, "other text under this id"), (11, "one two three four five")]
    docs = check(spark, rows)
    assert jaccard.joined(docs.limit(0)).count() == 0
    kept = jaccard.keep_one(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 4, 6, 7, 8, 10, 11, 11]


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (5, 4), (9, 3)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)]])
def test_components(spark, edges):
    got = {r.node: r.label for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in jaccard.op9_ngram_jaccard(spark, SF_SMALL).collect()), key=str) == brute(rows)
