"""Containment search: planted items, thresholds, defined results, no Python in the plan."""

import random

from conftest import SF_SMALL
from issuelens.llm.decontaminate import contained, drop_contaminated, item_shingles, op8_benchmark_hits, sketches


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_planted_items_at_the_threshold(spark):
    rng = random.Random(3)
    items, docs, want = [], [], set()
    for i in range(40):
        item = words(rng, rng.choice([5, 6, 9, 14, 24, 54, 104]))
        items.append((i, " ".join(item)))
        n = len(item) - 4
        for missing in range(0, min(n, 40)):        # cut words off the end: each takes one shingle away
            body = words(rng, 300) + item[: len(item) - missing] + words(rng, 200)
            docs.append((len(docs), " ".join(body).upper()))
            if n - missing >= 0.8 * n:
                want.add((docs[-1][0], i))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = contained(d, b)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_sketch_is_long_enough_for_its_class(spark):
    b = spark.createDataFrame([(n, " ".join(f"x{n}_{i}" for i in range(n + 4))) for n in range(1, 70)], "item_id long, text string")
    sizes = {r.item_id: r["count"] for r in sketches(item_shingles(b)).groupBy("item_id").count().collect()}
    for n in range(1, 70):
        assert sizes[n] >= min(n, n - -(-8 * n // 10) + 1)


def test_defined_results(spark):
    items = [(1, "one two three four five six"), (1, "one two three four five six"), (2, "too short item"), (3, None), (4, ""),
             (None, "no id here at all friends")]
    docs = [(1, "x ONE, two; three four five six!", "a"), (1, "x ONE, two; three four five six!", "a"), (1, "something else", "b"),
            (2, None, None), (3, "", None), (None, "one two three four five six", "c"), (4, "filler " * 50000 + "one two three four five six", "d")]
    d = spark.createDataFrame(docs, "doc_id long, text string, n_item string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(tuple(r) for r in contained(d, b).collect()) == [(1, 1, 2, 2, 1.0), (4, 1, 2, 2, 1.0)]
    assert contained(d.limit(0), b).count() == 0 and contained(d, b.limit(0)).count() == 0


def test_stage_drops_only_hits(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    hit = {r.doc_id for r in op8_benchmark_hits(spark, SF_SMALL).collect()}
    kept = drop_contaminated(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert hit and ids == {r.doc_id for r in docs.collect()} - hit


def test_plan_has_no_python_and_no_cross_join(spark):
    plan = op8_benchmark_hits(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
