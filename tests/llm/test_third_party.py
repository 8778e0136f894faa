"""A missing third-party module is told, not taken for a missing subpackage."""

import subprocess
import sys
from pathlib import Path

import pytest


@pytest.mark.parametrize("name", ["zstandard", "public_tokenizers"])
def test_missing_module(name):
    code = f"""
import sys

class Missing:
    def find_spec(name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Missing)
import __spark_entry__
"""
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True)
    assert said.returncode != 0 and name in said.stderr
