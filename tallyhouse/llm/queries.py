"""Queries of this package and their SQL, by name."""

from __future__ import annotations

from tallyhouse.llm.conversations import op13_conversation_repair
from tallyhouse.llm.decontaminate import OP1_SQL, op1_decontaminate
from tallyhouse.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from tallyhouse.llm.licenses import op9_license_scan
from tallyhouse.llm.line_dedup import OP2_SQL, op2_line_dedup
from tallyhouse.llm.lm_score import op10_lm_score
from tallyhouse.llm.pii import op6_pii
from tallyhouse.llm.resample import op12_importance_resample
from tallyhouse.llm.secrets import op4_secret_scan
from tallyhouse.llm.simhash import op8_simhash_near_dedup
from tallyhouse.llm.source_mix import op7_source_mix
from tallyhouse.llm.token_store import op11_token_ids
from tallyhouse.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_secret_scan": op4_secret_scan,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_pii": op6_pii,
    "op7_source_mix": op7_source_mix,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_lm_score": op10_lm_score,
    "op11_token_ids": op11_token_ids,
    "op12_importance_resample": op12_importance_resample,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {
    "op1_decontaminate": OP1_SQL,
    "op2_line_dedup": OP2_SQL,
    "op5_exact_dedup": OP5_SQL,
}
