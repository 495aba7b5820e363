"""The entry module with and without the training-data operators."""

import builtins
import importlib
import sys

import pytest

import __spark_entry__ as entry_module


@pytest.mark.parametrize("absent", ["mailweave.llm", "public_tokenizers", "xxhash", "corpus_pipeline"])
def test_mail_queries_do_not_need_what_others_need(monkeypatch, absent):
    """With a module that cannot be imported, only the queries that need it are missing."""
    for name in [n for n in sys.modules if n.startswith(("mailweave.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    real = builtins.__import__

    def without(name, globals=None, locals=None, fromlist=(), level=0):
        if name == absent or name.startswith(absent + ".") or f"{name}.{(fromlist or ['', ])[0]}" == absent:
            raise ImportError(absent)
        return real(name, globals, locals, fromlist, level)

    monkeypatch.setattr(builtins, "__import__", without)
    package = importlib.import_module("mailweave")
    monkeypatch.delattr(package, "llm", raising=False)
    mail = entry_module._mail_queries()
    found = entry_module.queries()
    assert set(mail) <= set(found) and "pipeline" not in found
    if absent != "corpus_pipeline":
        assert set(found) == set(mail)
    assert set(mail) <= set(entry_module.oracle_sql())
