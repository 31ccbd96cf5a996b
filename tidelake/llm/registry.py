"""The queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from tidelake.llm import alignment, chat, exact_dedup, language_id, likelihood, merkle, mixing, near_dedup, packing, passages, quality, telephony, warc

QUERIES = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_packing": packing.query,
    "op3_near_dedup": near_dedup.query,
    "op4_passages": passages.query,
    "op5_likelihood": likelihood.query,
    "op6_telephony": telephony.query,
    "op7_chat": chat.query,
    "op8_quality": quality.query,
    "op9_warc": warc.query,
    "op10_mixing": mixing.query,
    "op11_language_id": language_id.query,
    "op12_merkle": merkle.query,
    "op13_alignment": alignment.query,
}
SQL = {"op1_exact_dedup": exact_dedup.SQL, "op7_chat": chat.SQL, "op9_warc": warc.SQL, "op12_merkle": merkle.SQL}
