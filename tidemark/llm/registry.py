"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    chat,
    decontaminate,
    htmltext,
    mixing,
    pii,
    piece,
    quality,
    repair,
    runs,
    secrets,
    simhash,
    toxicity,
    urlrules,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_url_filter": urlrules.op2_url_filter,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_simhash_neardup": simhash.op5_simhash_neardup,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_chat_format": chat.op8_chat_format,
    "op9_mixing": mixing.op9_mixing,
    "op10_html_text": htmltext.op10_html_text,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_periodic_runs": runs.op12_periodic_runs,
    "op13_sentencepiece": piece.op13_sentencepiece,
}

ORACLE_SQL: dict[str, str] = {
    "op7_quality_rules": quality.OP7_SQL,
    "op9_mixing": mixing.OP9_SQL,
}
