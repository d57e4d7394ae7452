"""One query per operator over the provided tables, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from issuelens.llm.decontaminate import OP8_SQL, op8_benchmark_hits
from issuelens.llm.jaccard import op9_ngram_jaccard
from issuelens.llm.langid import op7_language_id
from issuelens.llm.licenses import op5_license_scan
from issuelens.llm.merkle import OP11_SQL, op11_merkle_manifest
from issuelens.llm.preferences import OP10_SQL, op10_preferences
from issuelens.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from issuelens.llm.quality import OP2_SQL, op2_quality_lines
from issuelens.llm.sentencepiece import op1_sentencepiece
from issuelens.llm.substrings import op6_substring_dedup
from issuelens.llm.suffix_tree import op4_suffix_tree_score
from issuelens.llm.toxicity import op12_toxicity
from issuelens.llm.warc import op3_warc_derivatives

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_lines": op2_quality_lines,
    "op3_warc_derivatives": op3_warc_derivatives,
    "op4_suffix_tree_score": op4_suffix_tree_score,
    "op5_license_scan": op5_license_scan,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language_id": op7_language_id,
    "op8_benchmark_hits": op8_benchmark_hits,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_preferences": op10_preferences,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_toxicity": op12_toxicity,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op2_quality_lines": OP2_SQL,
    "op8_benchmark_hits": OP8_SQL,
    "op10_preferences": OP10_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
