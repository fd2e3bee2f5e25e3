"""The queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from hirelake.llm import (
    bpe,
    collocations,
    decontaminate,
    kn_quality,
    line_dedup,
    parity_join,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
    warc,
    whitening,
)

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_quality": kn_quality.op3_quality,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_sharding": sharding.op5_sharding,
    "op6_warc": warc.op6_warc,
    "op7_simhash": simhash.op7_simhash,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_collocations": collocations.op11_collocations,
    "op12_whitening": whitening.op12_whitening,
    "op13_parity_join": parity_join.op13_parity_join,
}
ORACLES = {
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op5_sharding": sharding.op5_sql(),
    "op6_warc": warc.OP6_SQL,
    "op11_collocations": collocations.OP11_SQL,
}
