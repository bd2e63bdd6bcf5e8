"""The queries of this package and their SQL."""

from __future__ import annotations

import corpus_pipeline
from clickwell.llm import bpe, chat, exact_dedup, fingerprints, language, licenses, lm, near_dedup, packing, prefix_trie, secrets, spelling, toxicity
from clickwell.llm.common import Query

QUERIES: dict[str, Query] = {run.__name__: run for run in (
    secrets.op1_secrets, lm.op2_lm, exact_dedup.op3_exact_dedup, licenses.op4_licenses,
    packing.op5_packing, fingerprints.op6_fingerprints, bpe.op7_bpe, toxicity.op8_toxicity,
    near_dedup.op9_near_dedup, chat.op10_chat, prefix_trie.op11_prefix_trie, spelling.op12_spelling,
    language.op13_language,
)} | {"pipeline": corpus_pipeline.run}

ORACLE: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op10_chat": chat.OP10_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_spelling": spelling.OP12_SQL,
}
