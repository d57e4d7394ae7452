"""License scan: against brute force, band probability, defined results."""

import random

import pytest

from conftest import SF_SMALL
from issuelens.llm import licenses as li


def brute(text):
    """Templates of which a stretch of the text holds the least share, in any place."""
    words = li.words_of(text)
    return {name for name, t in li.TEMPLATES.items()
            if len(li.shingles(li.words_of(t)) & li.shingles(words)) >= li.LEAST * len(li.shingles(li.words_of(t)))}


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = {(r.doc_id, n) for r in docs for n in brute(r.text)}
    got = {(r.doc_id, r.license) for r in li.op5_license_scan(spark, SF_SMALL).collect()}
    assert want and got == want


def test_every_template_at_any_place_and_slightly_changed(spark):
    rng = random.Random(4)
    rows, want = [], set()
    for name, t in li.TEMPLATES.items():
        for k in range(25):
            body = [f"w{rng.randrange(10**5)}" for _ in range(rng.randrange(0, 400))]
            words = t.split()
            if k % 3 == 2 and len(li.shingles(li.words_of(t))) >= 25:
                words[rng.randrange(len(words))] = "changed"          # at most five shingles go
            at = rng.randrange(len(body) + 1)
            rows.append((len(rows), " ".join(body[:at] + words + body[at:])))
            want.add((len(rows) - 1, name))
    got = {(r.doc_id, r.license) for r in li.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert want <= got
    assert got == {(i, n) for i, t in rows for n in brute(t)}


def test_bands_reach_the_probability():
    for group in li.grouped(li.TEMPLATES):
        for s in map(len, group.sets.values()):
            common = -(-8 * s // 10)
            j = common / (3 * group.block + s - common)
            assert 1 - (1 - j) ** group.bands >= li.PROBABILITY


def test_defined_results(spark):
    mit = "Released under the MIT License."
    rows = [(1, None, "a"), (2, "", "a"), (3, "MIT license", "a"), (4, mit, "a"), (4, mit, "a"), (None, "x " + mit.upper(), "a"),
            (5, "filler words " * 100_000 + mit, "a"), (6, "not Released under the BSD License.", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = sorted((r.doc_id or 0, r.license, r.containment) for r in li.scanned(docs).collect())
    assert got == [(0, "mit", 1.0), (4, "mit", 1.0), (4, "mit", 1.0), (5, "mit", 1.0)]
    assert li.scanned(docs.limit(0)).count() == 0


def test_templates_under_five_words(spark):
    short = {"arr": "All rights reserved.", "pd": "Public domain", "one": "Unlicense", "cc0": "CC0 1.0 Universal", "mit": li.TEMPLATES["mit"]}
    rng = random.Random(5)
    rows = [(0, "All rights"), (1, "ALL RIGHTS\nRESERVED"), (2, "all rights were reserved"), (3, "unlicense"), (4, None), (5, "public"), (6, "domain public")]
    for name, t in short.items():
        for _ in range(25):
            body = [f"w{rng.randrange(10**5)}" for _ in range(rng.randrange(0, 300))]
            at = rng.randrange(len(body) + 1)
            rows.append((len(rows), " ".join(body[:at] + [t] + body[at:])))
    plain = lambda t: " " + " ".join(li.words_of(t)) + " "
    want = {(i, n) for i, t in rows for n, x in short.items() if plain(x) in plain(t)}
    got = {(r.doc_id, r.license) for r in li.scanned(spark.createDataFrame(rows, "doc_id long, text string"), short).collect()}
    assert got == want and {n for _, n in got} == set(short)
    with pytest.raises(ValueError, match="bare"):
        li.scanned(spark.createDataFrame(rows, "doc_id long, text string"), {"bare": " ... "})


def test_many_templates_and_bands_without_a_ceiling(spark):
    import numpy as np
    rng = random.Random(9)
    made = {f"t{k}": " ".join(f"x{rng.randrange(400)}" for _ in range(rng.randrange(8, 60))) for k in range(150)}
    made["same as t3"] = made["t3"]
    texts = [(i, " ".join(f"w{rng.randrange(10**5)}" for _ in range(120)) + " " + t + " tail of the text") for i, t in enumerate(made.values())]
    got = {(r.doc_id, r.license) for r in li.scanned(spark.createDataFrame(texts, "doc_id long, text string"), templates=made).collect()}
    share = lambda t, text: len(li.shingles(li.words_of(t)) & li.shingles(li.words_of(text))) / len(li.shingles(li.words_of(t)))
    assert got == {(i, n) for i, text in texts for n, t in made.items() if share(t, text) >= li.LEAST}
    assert (3, "t3") in got and (3, "same as t3") in got
    assert (li.multipliers(6000)[:50] == li.multipliers(50)).all() and len(np.unique(li.multipliers(6000))) > 5990
