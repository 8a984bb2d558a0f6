"""The driver contract without the optional subpackage and pipeline."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

BLOCKED = """
import sys
gone = sys.argv[1:]
class Gone:
    def find_spec(self, name, path=None, target=None):
        if any(name == g or name.startswith(g + ".") for g in gone):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = set(e.queries())
assert "icb_scorecard" in names and not [n for n in names if n.startswith("op")] and "pipeline" not in names
assert set(e.oracle_sql()) <= names
"""


def import_without(*modules):
    env = {**os.environ, "PYTHONDONTWRITEBYTECODE": "1"}
    return subprocess.run([sys.executable, "-c", BLOCKED, *modules], cwd=ROOT, env=env, capture_output=True, text=True)


@pytest.mark.parametrize("modules", [("corpus_pipeline", "muster.llm"), ("corpus_pipeline",), ("muster.llm",)])
def test_entry_without_the_subpackage(modules):
    run = import_without(*modules)
    assert run.returncode == 0, run.stderr


def test_entry_without_a_package_that_only_the_subpackage_needs():
    run = import_without("public_tokenizers")
    assert run.returncode == 0 and "no module named 'public_tokenizers'" in run.stderr, run.stderr


def test_a_missing_part_of_the_library_is_an_error():
    assert "ModuleNotFoundError" in import_without("muster.plans.staging").stderr


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("muster/**/*.py"), *ROOT.glob("oracle/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts and path.name != "test_entry.py":
            assert "llm" not in path.read_text(), path
