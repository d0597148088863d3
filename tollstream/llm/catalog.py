"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (codes, decontaminate, extract, fingerprints, lexical, minhash, packing, pii, quality, sharding, simhash, tokenfiles,
               toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tag_path_ratios": extract.query,
    "op2_minhash_fingerprints": fingerprints.query,
    "op3_best_fit_packing": packing.query,
    "op4_toxicity": toxicity.query,
    "op5_pii_surrogates": pii.query,
    "op6_quality_discriminant": quality.query,
    "op7_simhash_near_dedup": simhash.query,
    "op8_rendezvous_sharding": sharding.query,
    "op9_repair_token_files": tokenfiles.query,
    "op10_template_decontamination": decontaminate.query,
    "op11_vector_codes": codes.query,
    "op12_ranked_search": lexical.query,
    "op13_minhash_near_dedup": minhash.query,
}

SQL: dict[str, str] = {
    "op8_rendezvous_sharding": sharding.SQL,
    "op11_vector_codes": codes.SQL,
    "op12_ranked_search": lexical.SQL,
}
