"""The entry stands without the optional subpackage, and hides no other import error."""
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import importlib.abc, sys
class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
print(len(e.queries()), "pipeline" in e.queries())
"""


def _run(*names):
    return subprocess.run([sys.executable, "-c", HIDE.format(names=names)], cwd=ROOT, capture_output=True, text=True)


def test_without_the_subpackage():
    for names in (("recordlog.llm",), ("corpus_pipeline",), ("recordlog.llm", "corpus_pipeline")):
        out = _run(*names)
        assert out.returncode == 0 and out.stdout.split()[-1] == "False" and int(out.stdout.split()[-2]) >= 88


def test_other_import_errors_show():
    assert _run("recordlog.plans.flagship").returncode != 0
