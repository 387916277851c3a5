"""The suite itself: every module can be collected next to any other."""

import os
import re

from shared_fixtures import ROOT


def _modules():
    for folder, _, files in os.walk(os.path.join(ROOT, "tests")):
        for f in files:
            if f.endswith(".py"):
                yield os.path.join(folder, f)


def test_no_module_imports_from_conftest():
    pattern = re.compile(r"^\s*(from\s+conftest\s+import|import\s+conftest)", re.M)
    assert [p for p in _modules() if pattern.search(open(p).read())] == []


def test_test_modules_have_names_of_their_own():
    names = [os.path.basename(p) for p in _modules() if os.path.basename(p) not in ("conftest.py", "__init__.py")]
    assert len(names) == len(set(names))
