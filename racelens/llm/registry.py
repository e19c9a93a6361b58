"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from racelens.llm import bpe, collocations, importance, licences, line_dedup, minhash, multi_index, packing, pq_dedup, records, secrets, toxicity, wrappers


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": licences.op1_license_scan,
        "op2_main_text": wrappers.op2_main_text,
        "op3_near_duplicates": minhash.op3_near_duplicates,
        "op4_nearest_neighbours": multi_index.op4_nearest_neighbours,
        "op5_bpe": bpe.op5_bpe,
        "op6_line_dedup": line_dedup.op6_line_dedup,
        "op7_pack": packing.op7_pack,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_embedding_near_duplicates": pq_dedup.op9_embedding_near_duplicates,
        "op10_token_records": records.op10_token_records,
        "op11_collocations": collocations.op11_collocations,
        "op12_importance_resample": importance.op12_importance_resample,
        "op13_secret_scan": secrets.op13_secret_scan,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    found = {"op1_license_scan": licences.ORACLE_SQL, "op11_collocations": collocations.ORACLE_SQL, "op13_secret_scan": secrets.ORACLE_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {k: v for k, v in found.items() if v}
