"""The queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from corpusmill.llm import (
    decontamination,
    jaccard,
    line_dedup,
    lm_scoring,
    media,
    mixing,
    periodic_runs,
    quality,
    secrets,
    sharding,
    suffix_dedup,
    token_alignment,
    warc,
)

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_sharding": sharding.op2_sharding,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_secrets": secrets.op4_secrets,
    "op5_lm_scoring": lm_scoring.op5_lm_scoring,
    "op6_media": media.op6_media,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_mixing": mixing.op8_mixing,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_warc": warc.op10_warc,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

SQL = {
    "op2_sharding": sharding.OP2_SQL,
    "op3_suffix_dedup": suffix_dedup.OP3_SQL,
    "op7_jaccard_join": jaccard.OP7_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op9_decontamination": decontamination.OP9_SQL,
    "op10_warc": warc.OP10_SQL,
    "op11_line_dedup": line_dedup.OP11_SQL,
}
