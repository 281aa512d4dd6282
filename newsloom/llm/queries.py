"""Queries and SQL of the corpus operators."""

from __future__ import annotations

from newsloom.llm.balls import op12_ball_kmeans, op12_sql
from newsloom.llm.chaining import op6_substring_chaining
from newsloom.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from newsloom.llm.fingerprints import op3_document_fingerprints
from newsloom.llm.jaccard import op8_ngram_jaccard_join
from newsloom.llm.language import op11_language_id
from newsloom.llm.lexical import OP13_SQL, op13_ranked_search
from newsloom.llm.licenses import op4_license_scans, op4_sql
from newsloom.llm.mixing import op1_mix_sources
from newsloom.llm.packing import op9_best_fit_packing
from newsloom.llm.quality import op7_quality_classifier
from newsloom.llm.secrets import op10_secret_scans
from newsloom.llm.suffix_dedup import op2_suffix_array_dedup


def queries() -> dict:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_suffix_array_dedup": op2_suffix_array_dedup,
        "op3_document_fingerprints": op3_document_fingerprints,
        "op4_license_scans": op4_license_scans,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_substring_chaining": op6_substring_chaining,
        "op7_quality_classifier": op7_quality_classifier,
        "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_secret_scans": op10_secret_scans,
        "op11_language_id": op11_language_id,
        "op12_ball_kmeans": op12_ball_kmeans,
        "op13_ranked_search": op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_license_scans": op4_sql(), "op5_exact_dedup": OP5_SQL, "op12_ball_kmeans": op12_sql(), "op13_ranked_search": OP13_SQL}
