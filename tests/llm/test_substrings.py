"""Substring dedup against brute force: copies, near copies, shared passages, hot passages, defined results."""

import hashlib
import random

from conftest import SF_SMALL
from issuelens.llm import substrings


def brute(rows, window=50):
    first = {}
    for i, t in rows:
        if i is not None:
            w = (t or "").encode().split()
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, copy string, first int")
    got = sorted((tuple(r) for r in substrings.measured_cuts(docs).collect()), key=str)
    assert got == brute(rows)
    return docs


def test_random_mixtures(spark):
    rng = random.Random(11)
    word = lambda: rng.choice(["a", "b", "the", f"w{rng.randrange(3000)}"])
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 75, 120, 200)]
    docs = []
    for i in range(120):
        kind, body = rng.randrange(6), [word() for _ in range(rng.randrange(0, 200))]
        if kind == 0 and docs:
            body = list(rng.choice(docs))
        elif kind == 1 and docs:
            body = list(rng.choice(docs))
            for _ in range(rng.randrange(1, 4)):
                if body:
                    body[rng.randrange(len(body))] = word()
        elif kind < 5:
            for _ in range(rng.randrange(1, 4)):
                p, at = rng.choice(passages), rng.randrange(len(body) + 1)
                k = rng.randrange(0, 12)
                body = body[:at] + p[k:] + body[at:]
        docs.append(body)
    order = list(range(120))
    rng.shuffle(order)
    check(spark, [(order[i], " \n"[i % 2].join(b)) for i, b in enumerate(docs)])


def test_one_passage_in_every_document_and_periodic_texts(spark):
    rng = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(30)) + " " + passage + " " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(30)))
            for i in range(150)]
    rows += [(1000 + i, "na " * n) for i, n in enumerate((49, 50, 51, 100, 3000))] + [(2000, "ab cd " * 40), (2001, "cd ab " * 40)]
    check(spark, rows)


def test_defined_results(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long), (1, long), (2, None), (3, ""), (None, " ".join(f"w{i}" for i in range(80))), (4, "short text"), (4, "short text"),
            (5, " ".join(f"w{i}" for i in range(500, 600)) + " tail"), (6, "é " * 60), (7, "É " * 60)]
    docs = check(spark, rows)
    assert substrings.measured_cuts(docs.limit(0)).count() == 0
    kept = {r.doc_id: r.text for r in substrings.cut_texts(docs).collect()}
    assert kept[5].strip() == "tail" and kept[2] is None and kept[3] == "" and kept[1] == long and kept[4] == "short text"
    assert substrings.cut_texts(docs).columns == docs.columns


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in substrings.op6_substring_dedup(spark, SF_SMALL).collect()), key=str)
    assert got == brute(rows)
