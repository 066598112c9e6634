"""The registered queries of this subpackage and their DuckDB texts."""

from tessera.llm import ann, chat, exact_dedup, mixing, near_dup, pieces, pii, sharding, token_files, toxicity

QUERIES = {
    "op1_sharding": sharding.query,
    "op2_toxicity": toxicity.query,
    "op3_ann": ann.query,
    "op4_pii": pii.query,
    "op5_chat_format": chat.query,
    "op6_sentencepiece": pieces.query,
    "op7_token_files": token_files.query,
    "op8_near_dedup": near_dup.query,
    "op9_mixing": mixing.query,
    "op10_exact_dedup": exact_dedup.query,
}

ORACLES = {
    "op1_sharding": sharding.SQL,
    "op5_chat_format": chat.SQL,
    "op9_mixing": mixing.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
}
