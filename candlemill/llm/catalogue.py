"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from candlemill.llm import (
    centroids, decontaminate, exact_dedup, filter_audit, html_text, jaccard_join, packing, ppm, quality, simhash, toxicity, urls, warc,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_html_text": html_text.op2_html_text,
    "op3_quality": quality.op3_quality,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_packing": packing.op6_packing,
    "op7_url_filter": urls.op7_url_filter,
    "op8_lm_score": ppm.op8_lm_score,
    "op9_warc": warc.op9_warc,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_centroids": centroids.op12_centroids,
    "op13_simhash": simhash.op13_simhash,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_centroids": centroids.ORACLE,
}
