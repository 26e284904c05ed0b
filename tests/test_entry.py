"""The entry module, with and without the optional training-data operators."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
WITHOUT = """
import importlib.abc, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("liftwork.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 80 and set(e.oracle_sql()) <= set(e.queries())
assert not any(k.startswith("op1_") or k == "pipeline" for k in e.queries())
"""


def test_flagship_query(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_optional_part():
    subprocess.run([sys.executable, "-c", WITHOUT], check=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": str(ROOT)})
