"""A missing subpackage is left out."""

import subprocess
import sys
from pathlib import Path

import pytest


@pytest.mark.parametrize("name", ["pagesift.llm", "corpus_pipeline"])
def test_missing_module(name):
    code = f"""
import sys

class Missing:
    def find_spec(name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Missing)
import __spark_entry__ as e
print('pipeline' in e.queries())
"""
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], capture_output=True, text=True)
    assert said.returncode == 0 and said.stdout.strip() == "False"
