"""The registered queries of this subpackage: ``QUERIES`` and, where SQL can say the same, ``ORACLE``."""

from __future__ import annotations

from pricelake.llm.bagminhash import op5_minhash_near_dedup
from pricelake.llm.bpe import op4_bpe_round_trip
from pricelake.llm.decontaminate import op1_template_decontamination
from pricelake.llm.html import op8_html_text
from pricelake.llm.merkle import ORACLE as MERKLE_SQL
from pricelake.llm.merkle import op12_merkle_manifest
from pricelake.llm.pii import op3_pii
from pricelake.llm.separators import op6_token_counts
from pricelake.llm.simple8b import op11_simple8b_ids
from pricelake.llm.spelling import ORACLE as SPELLING_SQL
from pricelake.llm.spelling import op13_spelling_variants
from pricelake.llm.substrings import op2_substring_dedup
from pricelake.llm.topk import ORACLE as TOP_K_SQL
from pricelake.llm.topk import op10_exact_top_k
from pricelake.llm.toxicity import op7_toxicity
from pricelake.llm.warc import ORACLE as WARC_SQL
from pricelake.llm.warc import op9_warc

QUERIES = {
    "op1_template_decontamination": op1_template_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_pii": op3_pii,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_html_text": op8_html_text,
    "op9_warc": op9_warc,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_simple8b_ids": op11_simple8b_ids,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op9_warc": WARC_SQL,
    "op10_exact_top_k": TOP_K_SQL,
    "op12_merkle_manifest": MERKLE_SQL,
    "op13_spelling_variants": SPELLING_SQL,
}
