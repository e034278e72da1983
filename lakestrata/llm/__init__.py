"""Training-data operators. Each module holds one operator, its registered query in ``QUERIES`` and,
where SQL can express it, the DuckDB text in ``ORACLES``."""

from importlib import import_module

MODULES = ("token_output", "mix_sources", "license_scan", "url_templates", "substring_dedup", "decontaminate", "importance", "near_dedup",
           "line_quality", "chat_rotation", "embedding_dedup", "prefix_trie", "phrases")


def registered() -> tuple[dict, dict]:
    queries, oracles = {}, {}
    for name in MODULES:
        module = import_module(f"lakestrata.llm.{name}")
        queries.update(module.QUERIES)
        oracles.update(module.ORACLES)
    return queries, oracles
