"""The entry point with and without its optional part."""

from __future__ import annotations

import importlib
import importlib.util


def test_entry_without_the_optional_folder(monkeypatch):
    import __spark_entry__ as entry
    real = importlib.util.find_spec

    def without(name, *args):
        if name.startswith("ledgermatch.llm"):
            raise ModuleNotFoundError(name)
        return None if name == "corpus_pipeline" else real(name, *args)

    monkeypatch.setattr(importlib.util, "find_spec", without)
    try:
        importlib.reload(entry)
        names = set(entry.queries())
        assert not entry.HAS_LLM and not entry.HAS_PIPELINE
        assert "pipeline_e2e" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
        assert names <= set(entry.oracle_sql())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


def test_sql_only_for_registered_queries():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
