"""The pipeline's rows against the same stages by brute force."""

from conftest import SF_SMALL

import corpus_pipeline
from issuelens.llm import sentencepiece as sp
from issuelens.llm.decontaminate import LEAST
from issuelens.llm.langid import op7_language_id
from llm_brute import brute as jaccard_brute


def gram_set(text, n):
    import re
    words = re.findall(r"[^\W_]+", text.lower())
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def cut_words(rows, window=50):
    first = {}
    for i, t in rows:
        w = t.encode().split()
        for k in range(len(w) - window + 1):
            first[tuple(w[k : k + window])] = min(first.get(tuple(w[k : k + window]), i), i)
    for i, t in rows:
        w = t.encode().split()
        gone = {p for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for p in range(k, k + window)}
        if len(gone) < len(w) or not gone:
            yield i, [x.decode() for k, x in enumerate(w) if k not in gone], bool(gone)


def test_pipeline_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    known = {r.doc_id for r in op7_language_id(spark, SF_SMALL).filter("lang_pred <> 'und' and score >= 0.5").collect()}
    rows = sorted((i, t) for i, t in docs.items() if i in known)
    kept = {i for i, _, c in jaccard_brute(rows) if i == c}
    rows = [(i, t) for i, t in rows if i in kept]
    cut = {i: (w, gone) for i, w, gone in cut_words(rows)}
    items = [gram_set(r.text, 5) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = {i: w for i, (w, _) in cut.items()
            if not any(len(x & gram_set(" ".join(w), 5)) >= LEAST * len(x) for x in items if x)}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(found) == set(want)
    pieces = sp.Pieces(sp.load_model(sp.PIECE_MODEL))
    for i, r in found.items():
        assert r.text.encode().split() == [w.encode() for w in want[i]]
        if not cut[i][1]:
            assert r.text == docs[i]
        assert pieces.decode(r.token_ids) == r.text and r.n_tokens == len(r.token_ids) and r.n_chars == len(r.text)
        assert r.lang is not None and r.source is not None


def test_stages_keep_the_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "substring_dedup", "decontamination", "sentencepiece"]
    empty = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, SF_SMALL)
        assert out.dtypes == empty.dtypes and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF_SMALL).count() == 0
