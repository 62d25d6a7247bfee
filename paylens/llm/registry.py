"""Registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from paylens.llm import (
    chat_format,
    decontamination,
    exact_dedup,
    license_scan,
    line_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    quality,
    secret_scan,
    suffix_dedup,
    token_alignment,
    turn_repair,
)


def queries() -> dict:
    return {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_license_scan": license_scan.op2_license_scan,
        "op3_secret_scan": secret_scan.op3_secret_scan,
        "op4_exact_dedup": exact_dedup.op4_exact_dedup,
        "op5_line_dedup": line_dedup.op5_line_dedup,
        "op6_quality": quality.op6_quality,
        "op7_lm_scoring": lm_scoring.op7_lm_scoring,
        "op8_decontamination": decontamination.op8_decontamination,
        "op9_mixing": mixing.op9_mixing,
        "op10_near_dedup": near_dedup.op10_near_dedup,
        "op11_chat_format": chat_format.op11_chat_format,
        "op12_turn_repair": turn_repair.op12_turn_repair,
        "op13_token_alignment": token_alignment.op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    """The other operators draw, train, tokenize or follow rules that SQL cannot express; see their tests."""
    return {
        "op1_suffix_dedup": suffix_dedup.ORACLE,
        "op4_exact_dedup": exact_dedup.ORACLE,
        "op5_line_dedup": line_dedup.ORACLE,
        "op10_near_dedup": near_dedup.ORACLE,
    }
