"""The registered queries of this package and their SQL statements."""

from __future__ import annotations

from tarmac.llm import chat, collocations, exact, fingerprints, infilling, jaccard, minhash, mixing, packing, pii, quality, secretscan, tokens

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_token_counts": tokens.op2_token_counts,
    "op3_exact_dedup": exact.op3_exact_dedup,
    "op4_secrets": secretscan.op4_secrets,
    "op5_pii": pii.op5_pii,
    "op6_quality": quality.op6_quality,
    "op7_packing": packing.op7_packing,
    "op8_jaccard": jaccard.op8_jaccard,
    "op9_fingerprints": fingerprints.op9_fingerprints,
    "op10_chat_format": chat.op10_chat_format,
    "op11_minhash": minhash.op11_minhash,
    "op12_fill_in_middle": infilling.op12_fill_in_middle,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": exact.OP3_SQL,
    "op10_chat_format": chat.OP10_SQL,
    "op12_fill_in_middle": infilling.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
