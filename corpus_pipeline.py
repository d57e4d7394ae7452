"""Corpus pipeline over ``documents``: each stage is one of the operators of ``issuelens.llm``.

Language ID (unrecognised documents go), n-gram Jaccard join (one document of each group
stays), substring deduplication (repeated passages are cut), benchmark decontamination
(documents that contain a benchmark item go), SentencePiece encoding (token ids are added).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from issuelens.llm.decontaminate import drop_contaminated
from issuelens.llm.jaccard import keep_one
from issuelens.llm.langid import keep_identified
from issuelens.llm.sentencepiece import to_tokens
from issuelens.llm.substrings import drop_repeats
from issuelens.llm.text import read_table, written

STAGES = [
    ("language_id", keep_identified),
    ("jaccard_join", keep_one),
    ("substring_dedup", drop_repeats),
    ("decontamination", drop_contaminated),
    ("sentencepiece", to_tokens),
]

# SQL cannot express the first stage (a learned forward algorithm) nor the last (Viterbi paths).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what each keeps is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
