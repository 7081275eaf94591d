import importlib
import sys

import __spark_entry__ as driver
from checks.queries import QUERIES


def test_the_other_queries_stand_without_the_corpus_operators(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("ledgermill.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ledgermill.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        bare = importlib.reload(driver)
        assert set(bare.queries()) == set(QUERIES) == set(bare.oracle_sql())
    finally:
        monkeypatch.undo()
        importlib.reload(driver)
