"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltframe.llm import (
    bpe,
    fill_in_middle,
    fingerprints,
    language_id,
    language_model,
    licenses,
    minhash,
    multi_index,
    packing,
    periodic_runs,
    quality,
    secrets,
    token_files,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": language_id.op1_language_id,
        "op2_secrets": secrets.op2_secrets,
        "op3_licenses": licenses.op3_licenses,
        "op4_token_files": token_files.op4_token_files,
        "op5_language_model": language_model.op5_language_model,
        "op6_bpe": bpe.op6_bpe,
        "op7_minhash": minhash.op7_minhash,
        "op8_multi_index": multi_index.op8_multi_index,
        "op9_packing": packing.op9_packing,
        "op10_quality": quality.op10_quality,
        "op11_periodic_runs": periodic_runs.op11_periodic_runs,
        "op12_fingerprints": fingerprints.op12_fingerprints,
        "op13_fill_in_middle": fill_in_middle.op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_licenses": licenses.ORACLE_SQL,
        "op10_quality": quality.ORACLE_SQL,
        "op13_fill_in_middle": fill_in_middle.ORACLE_SQL,
    }
