"""Operators for training-data corpora, and their registered queries.

``CASES`` maps a query's name to (run, sql), as in the other suites; sql is
None where SQL cannot say it. Nothing else in the library imports this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

from lakeloom.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    line_dedup,
    ngram_join,
    piece,
    pii,
    prefix_trie,
    quality,
    repair,
    sharding,
    substring_dedup,
    toxicity,
)

# Tasks carry the code of this package with them, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CASES = {
    "op1_bpe": (bpe.op1_bpe, None),
    "op2_pii": (pii.op2_pii, None),
    "op3_toxicity": (toxicity.op3_toxicity, None),
    "op4_exact_dedup": (exact_dedup.op4_exact_dedup, exact_dedup.SQL),
    "op5_line_dedup": (line_dedup.op5_line_dedup, None),
    "op6_sharding": (sharding.op6_sharding, None),
    "op7_quality": (quality.op7_quality, None),
    "op8_ngram_join": (ngram_join.op8_ngram_join, None),
    "op9_decontaminate": (decontaminate.op9_decontaminate, None),
    "op10_substring_dedup": (substring_dedup.op10_substring_dedup, None),
    "op11_repair": (repair.op11_repair, None),
    "op12_prefix_trie": (prefix_trie.op12_prefix_trie, None),
    "op13_sentencepiece": (piece.op13_sentencepiece, None),
}
