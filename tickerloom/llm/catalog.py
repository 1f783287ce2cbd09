"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from tickerloom.llm import (
    bpe, crf, fingerprints, gam, minhash, packing, passages, prefix_trie, quality_rules,
    sharding, tokens, topk, whitening,
)

_MODULES = (quality_rules, tokens, packing, sharding, crf, topk, gam, bpe, minhash,
            passages, whitening, fingerprints, prefix_trie)


def all_queries() -> dict:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
