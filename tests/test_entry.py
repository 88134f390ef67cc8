"""The driver's entry without the training-data subpackage."""

import importlib.abc
import sys

import __spark_entry__ as driver
from fieldloom.plans import catalog


class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "fieldloom.llm" or name.startswith("fieldloom.llm."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


def test_queries_without_the_subpackage(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("fieldloom.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Hidden(), *sys.meta_path])
    assert driver.queries() == catalog.QUERIES and driver.oracle_sql() == catalog.ORACLE


def test_every_statement_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
