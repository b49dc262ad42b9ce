"""The entry module offers the library's queries whatever is missing of the training-data part."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["corpus_pipeline", "calloom.llm", "xxhash", "public_tokenizers", "regex"])
def test_queries_survive_a_missing_module(missing):
    code = f"import sys; sys.modules[{missing!r}] = None\nimport __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.split()[-2:] == ["107", "107"]
