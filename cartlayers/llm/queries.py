"""Registered queries of this package and the SQL that must agree, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cartlayers.llm.bpe import op8_bpe
from cartlayers.llm.contamination import op10_decontamination
from cartlayers.llm.hard_negatives import HARD_NEGATIVES_SQL, op13_hard_negatives
from cartlayers.llm.jaccard_join import op5_jaccard_join
from cartlayers.llm.language_id import op1_language_id
from cartlayers.llm.license_scan import op3_license_scan
from cartlayers.llm.lm_scoring import op9_lm_scoring
from cartlayers.llm.merkle import MERKLE_SQL, op12_merkle
from cartlayers.llm.nearest import op2_nearest
from cartlayers.llm.personal_data import op7_personal_data
from cartlayers.llm.token_files import op11_token_files
from cartlayers.llm.token_counts import TOKEN_COUNTS_SQL, op6_token_counts
from cartlayers.llm.warc import WARC_SQL, op4_warc_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_nearest": op2_nearest,
    "op3_license_scan": op3_license_scan,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_token_counts": op6_token_counts,
    "op7_personal_data": op7_personal_data,
    "op8_bpe": op8_bpe,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_decontamination": op10_decontamination,
    "op11_token_files": op11_token_files,
    "op12_merkle": op12_merkle,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

#: The others are tested against brute force: SQL cannot express them, or not on whole tables.
ORACLES: dict[str, str] = {
    "op4_warc_revisits": WARC_SQL,
    "op6_token_counts": TOKEN_COUNTS_SQL,
    "op12_merkle": MERKLE_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
