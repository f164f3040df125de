"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

#: Query name -> module of this subpackage that holds it; a module's SQL, if it has any, is its constant SQL.
MODULES = {
    "op1_decontamination": "decontam",
    "op2_simhash_dedup": "simhash",
    "op3_warc": "warc",
    "op4_line_dedup": "linededup",
    "op5_toxicity": "toxicity",
    "op6_quality_rules": "quality",
    "op7_chat_format": "chat",
    "op8_packing": "packing",
    "op9_substring_dedup": "substrings",
    "op10_language_id": "langid",
    "op1_near_matches": "decontam",
    "op9_whole_passages": "substrings",
}
#: Queries whose module's SQL is that of another query.
WITHOUT_SQL = {"op1_near_matches", "op9_whole_passages"}


def queries() -> dict:
    return {name: getattr(import_module(f".{module}", __package__), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f".{module}", __package__), "SQL", None) for name, module in MODULES.items() if name not in WITHOUT_SQL}
    return {name: sql for name, sql in found.items() if sql}
