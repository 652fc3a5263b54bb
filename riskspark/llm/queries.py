"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from . import (alignment, bpe, divergence, htmltext, maxscore, ngram_join, packing, recompression, resampling, secrets,
               threshold, toxicity, vectors)
from .oracles import ORACLES  # noqa: F401

QUERIES = {
    "op1_best_fit_packing": packing.op1_pack,
    "op2_toxicity_svm": toxicity.op2_toxicity,
    "op3_byte_bpe_codec": bpe.op3_codec,
    "op9_ngram_join": ngram_join.op9_join,
    "op8_substring_dedup": recompression.op8_dedup,
    "op7_template_removal": htmltext.op7_extract,
    "op4_secret_forest": secrets.op4_scan,
    "op5_importance_resampling": resampling.op5_resample,
    "op10_learned_partitions": vectors.op10_nearest,
    "op6_distribution_rules": divergence.op6_rules,
    "op11_pair_maxscore": maxscore.op11_search,
    "op12_token_alignment": alignment.op12_align,
    "op13_uniform_threshold": threshold.op13_topk,
}
