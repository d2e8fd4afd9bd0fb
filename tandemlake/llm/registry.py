"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

import importlib

MODULES = ["quality", "langid", "tokenfile", "substring", "packing", "licenses", "neardup", "mixing", "pii", "media", "importance", "balltree", "maxent"]


def queries() -> dict:
    import corpus_pipeline

    found = {"pipeline": corpus_pipeline.run}
    for name in MODULES:
        found |= importlib.import_module(f"tandemlake.llm.{name}").QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    for name in MODULES:
        found |= importlib.import_module(f"tandemlake.llm.{name}").ORACLES
    return found
