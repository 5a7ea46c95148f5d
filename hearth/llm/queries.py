"""Registered queries of this package and their DuckDB SQL.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearth.llm import bpe, chat, decontaminate, langid, licenses, near_dup, packing, quality, resample, sharding, toxicity, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dup": near_dup.op1,
    "op2_decontaminate": decontaminate.op2,
    "op3_warc": warc.op3,
    "op4_string_kernel": langid.op4,
    "op5_shard_bins": sharding.op5,
    "op6_pack_differencing": packing.op6,
    "op7_toxicity_cnn": toxicity.op7,
    "op8_license_digest": licenses.op8,
    "op9_divergence_rules": quality.op9,
    "op10_chat_format": chat.op10,
    "op11_bpe_words": bpe.op11,
    "op12_importance_resampling": resample.op12,
    "op13_whitening": whitening.op13,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE_SQL,
    "op3_warc": warc.ORACLE_SQL,
    "op8_license_digest": licenses.oracle_sql(),
    "op9_divergence_rules": quality.oracle_sql(),
    "op10_chat_format": chat.ORACLE_SQL,
    "op12_importance_resampling": resample.ORACLE_SQL,
}
