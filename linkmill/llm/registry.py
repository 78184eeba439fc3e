"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from linkmill.llm import (
    decontaminate,
    exact_dups,
    filter_audit,
    licenses,
    main_text,
    mixture,
    near_dups,
    quality,
    sanitise,
    target_sample,
    tokens,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_main_text": main_text.op4_main_text,
    "op5_simhash": near_dups.op5_simhash,
    "op6_quality": quality.op6_quality,
    "op7_exact_dedup": exact_dups.op7_exact_dedup,
    "op8_token_counts": tokens.op8_token_counts,
    "op9_mixture": mixture.op9_mixture,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_sanitise": sanitise.op12_sanitise,
    "op13_target_sample": target_sample.op13_target_sample,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_url_filter": url_filter.ORACLE,
    "op3_license_scan": licenses.ORACLE,
    "op7_exact_dedup": exact_dups.ORACLE,
    "op9_mixture": mixture.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op13_target_sample": target_sample.ORACLE,
}
