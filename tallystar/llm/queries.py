"""Registered training-data queries: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import corpus_pipeline
from tallystar.llm import (op01_automaton, op02_mcd, op03_prefix_ranks, op04_rendezvous,
                           op05_lineblock, op06_gear_chunks, op07_gumbel_pieces, op08_weak_pii,
                           op09_partenum, op10_nbsvm, op11_whitening, op12_phrases, op13_segment_trees)

QUERIES = {
    "op1_suffix_automaton": op01_automaton.query,
    "op2_mcd_outliers": op02_mcd.query,
    "op3_prefix_ranks": op03_prefix_ranks.query,
    "op4_rendezvous": op04_rendezvous.query,
    "op5_line_blocks": op05_lineblock.query,
    "op6_gear_chunks": op06_gear_chunks.query,
    "op7_gumbel_pieces": op07_gumbel_pieces.query,
    "op8_weak_pii": op08_weak_pii.query,
    "op9_partenum": op09_partenum.query,
    "op10_nbsvm": op10_nbsvm.query,
    "op11_whitening": op11_whitening.query,
    "op12_phrases": op12_phrases.query,
    "op13_segment_trees": op13_segment_trees.query,
    "pipeline": corpus_pipeline.run,
}

# The others have no form in SQL that runs on whole tables; each is tested
# against a brute-force version in tests/llm.
ORACLE_SQL: dict[str, str] = {"op13_segment_trees": op13_segment_trees.SQL}
