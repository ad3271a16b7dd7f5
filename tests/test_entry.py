import sys

import pytest

import __spark_entry__ as contract
from threadtone.workload.oracles import ORACLES
from threadtone.workload.queries import registered


@pytest.mark.parametrize("name", ["threadtone.llm.queries", "corpus_pipeline", "xxhash", "public_tokenizers"])
def test_the_rest_stands_without_a_module(monkeypatch, caplog, name):
    for known in list(sys.modules):
        if known.startswith(("threadtone.llm", "corpus_pipeline")):
            monkeypatch.delitem(sys.modules, known)
    real = __import__

    def absent(wanted, *args, **kwargs):
        if wanted == name:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(wanted, *args, **kwargs)

    monkeypatch.setattr("builtins.__import__", absent)
    assert set(contract.queries()) == set(registered()) and contract.oracle_sql() == ORACLES
    assert "no training-data operators" in caplog.text
