"""The queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline

from . import (
    op1_bpe, op2_quality, op3_rules, op4_ngram_join, op5_preferences, op6_toxicity, op7_pii, op8_token_files, op9_lm_score, op10_decontaminate, op11_fill_middle, op12_reshard,
    op13_merkle,
)

QUERIES: dict[str, Callable] = {
    "op1_bpe": op1_bpe.op1_bpe,
    "op2_quality": op2_quality.op2_quality,
    "op3_rules": op3_rules.op3_rules,
    "op4_ngram_join": op4_ngram_join.op4_ngram_join,
    "op5_preferences": op5_preferences.op5_preferences,
    "op6_toxicity": op6_toxicity.op6_toxicity,
    "op7_pii": op7_pii.op7_pii,
    "op8_token_files": op8_token_files.op8_token_files,
    "op9_lm_score": op9_lm_score.op9_lm_score,
    "op10_decontaminate": op10_decontaminate.op10_decontaminate,
    "op11_fill_middle": op11_fill_middle.op11_fill_middle,
    "op12_reshard": op12_reshard.op12_reshard,
    "op13_merkle": op13_merkle.op13_merkle,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = {"op5_preferences": op5_preferences.OP5_SQL, "op11_fill_middle": op11_fill_middle.OP11_SQL, "op13_merkle": op13_merkle.OP13_SQL}
