"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from landfall.llm import bytebpe, chat, decontam, fim, jaccard, langid, lm, nearvec, packing, quality, suffix, toxicity, whitening
from landfall.llm.common import shipped

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_quality": quality.op2_quality,
    "op3_near_embeddings": nearvec.op3_near_embeddings,
    "op4_lm_scoring": lm.op4_lm_scoring,
    "op5_token_ids": packing.op5_token_ids,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_suffix_dedup": suffix.op7_suffix_dedup,
    "op8_decontamination": decontam.op8_decontamination,
    "op9_byte_bpe": bytebpe.op9_byte_bpe,
    "op10_language_id": langid.op10_language_id,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_fill_in_middle": fim.op13_fill_in_middle,
}
QUERIES = {name: shipped(query) for name, query in QUERIES.items()}
ORACLES = {"op1_chat_format": chat.SQL, "op8_decontamination": decontam.SQL, "op13_fill_in_middle": fim.SQL}
