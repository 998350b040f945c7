"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from epistar.llm.decontaminate import op5_benchmark_decontamination
from epistar.llm.fingerprint import op12_document_fingerprints
from epistar.llm.html_text import op6_html_extraction
from epistar.llm.language_id import op9_language_id
from epistar.llm.merkle import op11_merkle_manifest
from epistar.llm.mixing import op8_mix_to_weights
from epistar.llm.ngram_join import op1_ngram_jaccard_join
from epistar.llm.ns_bounds import op13_centroid_clustering
from epistar.llm.oracle_sql import ORACLE_SQL
from epistar.llm.pii import op2_pii
from epistar.llm.quality_model import op7_quality_classifier
from epistar.llm.quality_rules import op10_quality_rules
from epistar.llm.secrets import op3_secret_scan
from epistar.llm.substring_dedup import op4_substring_dedup

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_pii": op2_pii,
    "op3_secret_scan": op3_secret_scan,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_html_extraction": op6_html_extraction,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_mix_to_weights": op8_mix_to_weights,
    "op9_language_id": op9_language_id,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_centroid_clustering": op13_centroid_clustering,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
