"""The registered queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import bpe, codes, decontaminate, divergence, jaccard, langmodel, licenses, mixing, neighbours, quality, secrets, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_warc": warc.op3_warc,
    "op4_neighbours": neighbours.op4_neighbours,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_secrets": secrets.op8_secrets,
    "op9_language_model": langmodel.op9_language_model,
    "op10_quality": quality.op10_quality,
    "op11_bpe": bpe.op11_bpe,
    "op12_divergence": divergence.op12_divergence,
    "op13_vector_codes": codes.op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": licenses.oracle(),
    "op3_warc": warc.ORACLE,
    "op6_mix_sources": mixing.oracle(),
    "op8_secrets": secrets.oracle(),
    "op12_divergence": divergence.ORACLE,
    "op13_vector_codes": codes.oracle(),
}
