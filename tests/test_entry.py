"""The entry stands without the training-data modules or what they import."""

import os
import subprocess
import sys

import pytest

from edgeframe.plans.registry import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCKED = """
import sys
for name in {names!r}:
    sys.modules[name] = None            # importing it raises ImportError
import warnings
warnings.simplefilter("ignore")
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


@pytest.mark.parametrize("names", [["ahocorasick"], ["public_tokenizers"], ["corpus_pipeline", "edgeframe.llm"], ["regex"]])
def test_queries_without(names):
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(names=names)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], out.stderr[-500:]
