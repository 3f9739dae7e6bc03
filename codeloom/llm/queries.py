"""The registered queries of this package and their SQL."""

from __future__ import annotations

from codeloom.llm import (
    chat,
    decontaminate,
    linededup,
    lm,
    packing,
    pseudonyms,
    quality,
    repair,
    simhash,
    tokencount,
    tokenfile,
    toxicity,
    vectorcodes,
)

QUERIES = {
    "op1_simhash_near_dedup": simhash.op1,
    "op2_chat_formatting": chat.op2,
    "op3_quality_rules": quality.op3,
    "op4_token_ids": tokenfile.op4,
    "op5_packing": packing.op5,
    "op6_token_counts": tokencount.op6,
    "op7_lm_scores": lm.op7,
    "op8_pseudonyms": pseudonyms.op8,
    "op9_benchmark_decontamination": decontaminate.op9,
    "op10_toxicity": toxicity.op10,
    "op11_vector_codes": vectorcodes.op11,
    "op12_line_dedup": linededup.op12,
    "op13_structure_repair": repair.op13,
}

ORACLES: dict[str, str] = {
    "op2_chat_formatting": chat.OP2_SQL,
    "op11_vector_codes": vectorcodes.OP11_SQL,
    "op12_line_dedup": linededup.OP12_SQL,
    "op13_structure_repair": repair.OP13_SQL,
}
