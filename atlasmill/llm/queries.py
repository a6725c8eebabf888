"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

#: Query -> module of this package that has a function of its name.
MODULES = {
    "op1_toxicity": "toxicity",
    "op2_jaccard_join": "jaccard_join",
    "op3_token_counts": "token_counts",
    "op4_secret_scans": "secrets",
    "op5_chat_formatting": "chat",
    "op6_html_extraction": "html_text",
    "op7_substring_dedup": "substring_dedup",
    "op8_packing": "packing",
    "op9_fingerprints": "imatch",
    "op10_decontamination": "decontaminate",
}


def queries() -> dict:
    import corpus_pipeline

    return {name: getattr(import_module(f"atlasmill.llm.{module}"), name) for name, module in MODULES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline
    from atlasmill.llm import chat

    sql = {"op5_chat_formatting": chat.SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: text for name, text in sql.items() if text}
