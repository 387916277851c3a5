"""Paths and helpers that test modules import by this name (never from ``conftest``,
a name that every test folder has)."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def write_text(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path
