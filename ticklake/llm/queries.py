"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticklake.llm import conversation_repair, decision_list, decontaminate, html_text, langid, line_templates, merkle, mixing, repeats, revisits, simhash, surrogates, unigram


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_revisits": revisits.op1_revisits,
        "op2_surrogates": surrogates.op2_surrogates,
        "op3_html_text": html_text.op3_html_text,
        "op4_unigram": unigram.op4_unigram,
        "op5_decontamination": decontaminate.op5_decontamination,
        "op6_decision_list": decision_list.op6_decision_list,
        "op7_repeats": repeats.op7_repeats,
        "op8_language_id": langid.op8_language_id,
        "op9_line_templates": line_templates.op9_line_templates,
        "op10_simhash": simhash.op10_simhash,
        "op11_conversation_repair": conversation_repair.op11_conversation_repair,
        "op12_merkle": merkle.op12_merkle,
        "op13_mixing": mixing.op13_mixing,
    }


def all_sql() -> dict[str, str]:
    return {**revisits.SQL, **decontaminate.SQL, **line_templates.SQL, **conversation_repair.SQL, **merkle.SQL}
