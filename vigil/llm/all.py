"""Every query of this subpackage; importing the modules registers them."""

from vigil.llm import (  # noqa: F401
    op1_token_counts, op2_bpe, op3_token_files, op4_quality, op5_forest_search, op6_lattice_lm,
    op7_packing, op8_jaccard_join, op9_superkmer_dedup, op10_suffix_dedup,
    op11_licence_scan, op12_prefix_trie, op13_merkle_manifest,
)
from vigil.llm.registry import ORACLE, QUERIES  # noqa: F401
