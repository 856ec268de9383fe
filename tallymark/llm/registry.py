"""Named queries of this package and their DuckDB text."""

from __future__ import annotations

from tallymark.llm.conversations import op11_conversation_repair
from tallymark.llm.decontamination import op10_decontamination
from tallymark.llm.language import op3_language
from tallymark.llm.minhash import op9_minhash
from tallymark.llm.mixing import op5_mixing
from tallymark.llm.oracle import OP9_MINHASH, OP10_DECONTAMINATION, OP11_CONVERSATION_REPAIR, OP12_PREFIX_TRIE, OP13_WARC
from tallymark.llm.pages import op4_main_text
from tallymark.llm.prefix_trie import op12_prefix_trie
from tallymark.llm.secrets import op1_secrets
from tallymark.llm.suffix_repeats import op8_suffix_repeats
from tallymark.llm.tokens import op2_token_counts, op6_packed_ids
from tallymark.llm.vectors import op7_near_vectors
from tallymark.llm.warc import op13_warc

QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_token_counts": op2_token_counts,
    "op3_language": op3_language,
    "op4_main_text": op4_main_text,
    "op5_mixing": op5_mixing,
    "op6_packed_ids": op6_packed_ids,
    "op7_near_vectors": op7_near_vectors,
    "op8_suffix_repeats": op8_suffix_repeats,
    "op9_minhash": op9_minhash,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_warc": op13_warc,
}

ORACLE: dict[str, str] = {
    "op9_minhash": OP9_MINHASH,
    "op10_decontamination": OP10_DECONTAMINATION,
    "op11_conversation_repair": OP11_CONVERSATION_REPAIR,
    "op12_prefix_trie": OP12_PREFIX_TRIE,
    "op13_warc": OP13_WARC,
}
