"""The registered queries of the package and their SQL twins, where SQL can say them."""

from __future__ import annotations

from tabwarden.llm import (
    chat_trees,
    filter_audit,
    huffman,
    language,
    mixing,
    pairwise_quality,
    quality_rules,
    secrets,
    simhash_trie,
    spelling,
    superkmer,
    templates,
    url_cascade,
)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_url_cascade": url_cascade.query,
    "op3_token_blocks": huffman.query,
    "op4_chat_trees": chat_trees.query,
    "op5_language_network": language.query,
    "op6_simhash_trie": simhash_trie.query,
    "op7_pairwise_quality": pairwise_quality.query,
    "op8_mix_sources": mixing.query,
    "op9_template_leaks": templates.query,
    "op10_superkmer_dedup": superkmer.query,
    "op11_secret_novelty": secrets.query,
    "op12_filter_audit": filter_audit.query,
    "op13_spelling_variants": spelling.query,
}
ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op2_url_cascade": url_cascade.ORACLE,
    "op4_chat_trees": chat_trees.ORACLE,
    "op8_mix_sources": mixing.ORACLE,
    "op10_superkmer_dedup": superkmer.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
}
