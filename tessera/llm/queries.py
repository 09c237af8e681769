"""One query per operator of this subpackage, over its whole tables, and SQL where it can say it."""

from __future__ import annotations

from tessera.llm import conversations, embedding_dedup, jaccard_join, language_id, line_dedup, mixing, sentencepiece_nbest, spelling, substring, suffix_array, token_counts, token_shards, topk_nra

QUERIES = {
    "op4_sentencepiece": sentencepiece_nbest.op4_sentencepiece,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op2_topk": topk_nra.op2_topk,
    "op3_embedding_dedup": embedding_dedup.op3_embedding_dedup,
    "op7_suffix_dedup": suffix_array.op7_suffix_dedup,
    "op1_substring_dedup": substring.op1_substring_dedup,
    "op10_mix": mixing.op10_mix,
    "op5_language_id": language_id.op5_language_id,
    "op9_token_shards": token_shards.op9_token_shards,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_token_counts": token_counts.op13_token_counts,
}
#: SQL that says the same; the others learn, tokenize or draw blocks by a seed.
ORACLES: dict[str, str] = {
    "op1_substring_dedup": substring.OP1_SQL,
    "op2_topk": topk_nra.OP2_SQL,
    "op3_embedding_dedup": embedding_dedup.OP3_SQL,
    "op7_suffix_dedup": suffix_array.OP7_SQL,
    "op8_jaccard_join": jaccard_join.OP8_SQL,
    "op11_spelling_variants": spelling.OP11_SQL,
    "op12_conversation_repair": conversations.OP12_SQL,
}
