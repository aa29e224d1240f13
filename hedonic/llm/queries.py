"""Loads every operator module, which register their queries."""

from hedonic.llm import (
    byte_bpe, decontaminate, extract, fingerprints, language, licenses, line_dedup, ngram_join, packing, periodic_runs, prefix_trie,
    sharding, token_files,
)
from hedonic.llm.common import QUERIES, SQL

__all__ = [
    "QUERIES", "SQL", "byte_bpe", "decontaminate", "extract", "fingerprints", "language", "licenses", "line_dedup", "ngram_join",
    "packing", "periodic_runs", "prefix_trie", "sharding", "token_files",
]
