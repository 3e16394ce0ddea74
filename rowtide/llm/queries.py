"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import bpe, infill, jaccard, licenses, merkle, mixing, neardup, pii, quality, routed, secrets, sketch, substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard": jaccard.op1_jaccard,
    "op2_pii": pii.op2_pii,
    "op3_neardup": neardup.op3_neardup,
    "op4_sketch": sketch.op4_sketch,
    "op5_substrings": substrings.op5_substrings,
    "op6_quality": quality.op6_quality,
    "op7_secrets": secrets.op7_secrets,
    "op8_bpe": bpe.op8_bpe,
    "op9_licenses": licenses.op9_licenses,
    "op10_mixing": mixing.op10_mixing,
    "op11_infill": infill.op11_infill,
    "op12_routed": routed.op12_routed,
    "op13_merkle": merkle.op13_merkle,
}
ORACLE: dict[str, str] = {
    "op1_jaccard": jaccard.OP1_SQL,
    "op3_neardup": neardup.OP3_SQL,
    "op5_substrings": substrings.OP5_SQL,
    "op9_licenses": licenses.OP9_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_infill": infill.OP11_SQL,
    "op13_merkle": merkle.OP13_SQL,
}
