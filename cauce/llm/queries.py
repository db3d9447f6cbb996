"""Queries of this folder and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from cauce.llm.bpe import op5_bpe
from cauce.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from cauce.llm.lexical import OP11_SQL, op11_ranked_search
from cauce.llm.licenses import OP8_SQL, op8_licenses
from cauce.llm.merge_replay import op12_merge_replay
from cauce.llm.packing import op1_packing
from cauce.llm.pii import op7_pii
from cauce.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from cauce.llm.quality import op9_quality
from cauce.llm.simhash import op6_simhash
from cauce.llm.substrings import OP10_SQL, op10_substrings
from cauce.llm.token_files import op4_token_files
from cauce.llm.url_rules import OP3_SQL, op3_url_rules

QUERIES = {
    "op1_packing": op1_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_url_rules": op3_url_rules,
    "op4_token_files": op4_token_files,
    "op5_bpe": op5_bpe,
    "op6_simhash": op6_simhash,
    "op7_pii": op7_pii,
    "op8_licenses": op8_licenses,
    "op9_quality": op9_quality,
    "op10_substrings": op10_substrings,
    "op11_ranked_search": op11_ranked_search,
    "op12_merge_replay": op12_merge_replay,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op3_url_rules": OP3_SQL,
    "op8_licenses": OP8_SQL,
    "op10_substrings": OP10_SQL,
    "op11_ranked_search": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
