"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = {
    "op1_chat_formatting": "op1_chat",
    "op2_decontamination": "op2_decontaminate",
    "op3_quality_classifier": "op3_perplexity",
    "op4_token_counts": "op4_tokens",
    "op5_line_dedup": "op5_lines",
    "op6_source_mixing": "op6_mixing",
    "op7_quality_rules": "op7_quality",
    "op8_license_scan": "op8_license",
    "op9_substring_dedup": "op9_substring",
    "op10_minhash_near_dedup": "op10_near",
}


def queries() -> dict:
    """Name to (spark, sf_dir) -> DataFrame."""
    return {name: import_module(f".{module}", __package__).query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL, for the queries that SQL can express."""
    found = {name: getattr(import_module(f".{module}", __package__), "SQL", None) for name, module in _MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
