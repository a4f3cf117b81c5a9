"""The placement queries do not depend on the text operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["xxhash", "numpy", "tokenizers_that_never_were", "gridplace.llm", "corpus_pipeline"])
def test_entry_without_a_module(missing):
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as e
names = set(e.queries())
assert set(e.oracle_sql()) <= names and {{"rse_weight", "queues_metrics", "job_shares"}} <= names
print(len([n for n in names if not n.startswith("op") and n != "pipeline"]), len(names))
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    placement, every = map(int, run.stdout.split())
    assert placement >= 28
    if missing != "tokenizers_that_never_were":
        assert every == placement and "left out" in run.stderr
