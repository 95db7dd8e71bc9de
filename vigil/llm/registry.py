"""The queries of this subpackage, by name, with their SQL where SQL can express them."""

from __future__ import annotations

from vigil.llm import chat, fingerprints, langid, lm, mixing, neardup, packing, search, sharding, urls

QUERIES = {
    "op1_chat_formatting": chat.op1,
    "op2_kd_sharding": sharding.op2,
    "op3_harmonic_packing": packing.op3,
    "op4_source_mixing": mixing.op4,
    "op5_backoff_scoring": lm.op5,
    "op6_language_id": langid.op6,
    "op7_spotsigs": fingerprints.op7,
    "op8_bottom_k_dedup": neardup.op8,
    "op9_block_max_search": search.op9,
    "op10_url_cascade": urls.op10,
}
ORACLES = {"op1_chat_formatting": chat.SQL, "op4_source_mixing": mixing.SQL, "op5_backoff_scoring": lm.SQL, "op7_spotsigs": fingerprints.SQL, "op8_bottom_k_dedup": neardup.SQL, "op9_block_max_search": search.SQL, "op10_url_cascade": urls.SQL}
