"""Registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from . import (
    language,
    licenses,
    mixing,
    negatives,
    packing,
    quality,
    rules,
    sharding,
    simhash,
    spotsigs,
    toxicity,
    variants,
    warc,
)

REGISTRY = {f.__name__: f for f in (
    language.op1_language_id,
    simhash.op2_simhash_near_dedup,
    licenses.op3_license_scans,
    quality.op4_quality_classifier,
    spotsigs.op5_document_fingerprints,
    toxicity.op6_toxicity,
    packing.op7_packing,
    rules.op8_quality_rules,
    sharding.op9_sharding,
    mixing.op10_mixing,
    warc.op11_warc,
    variants.op12_spelling_variants,
    negatives.op13_hard_negatives,
)}

ORACLE = {"op10_mixing": mixing.ORACLE, "op11_warc": warc.ORACLE, "op13_hard_negatives": negatives.ORACLE}
