"""The queries and SQL of this subpackage's operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, lines, media, packing, pseudonyms, quality, secrets, sharding, simhash, substrings


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": secrets.op1_secret_scan,
        "op2_quality_classifier": quality.op2_quality_classifier,
        "op3_line_dedup": lines.op3_line_dedup,
        "op4_pseudonyms": pseudonyms.op4_pseudonyms,
        "op5_substrings": substrings.op5_substrings,
        "op6_hilbert_shards": sharding.op6_hilbert_shards,
        "op7_decontamination": decontaminate.op7_decontamination,
        "op8_best_fit_packing": packing.op8_best_fit_packing,
        "op9_simhash": simhash.op9_simhash,
        "op10_media_columns": media.op10_media_columns,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": secrets.OP1_SQL, "op7_decontamination": decontaminate.OP7_SQL}
